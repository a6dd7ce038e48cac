"""Queries that write tables and read them back."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics import schemas
from camlytics.operators import catalog, joins, reshape
from camlytics.plans import views
from camlytics.plans.parsing import FLAT, FLAT_SQL, _answers
from camlytics.plans.views import DET, sql
from camlytics.session import scratch_path
from camlytics.sinks import tables
from camlytics.sources import files, topics

START, END, CAMERAS = datetime.date(2024, 1, 5), datetime.date(2024, 1, 20), [1, 2, 5]


def _flattened_table(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "detections_flattened")
    tables.write_partitioned(reshape.flattened_rows(_answers(views.frm(spark, sf))), path)
    return path


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("camera_id").cast("int").alias("camera_id"), "frame_id", *FLAT,
        *[F.col(p).cast("int").alias(p) for p in ("year", "month", "day")],
    )


def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(files.scan_detections(spark, _flattened_table(spark, sf)))


def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen days of three cameras out of the partitioned table."""
    path = _flattened_table(spark, sf)
    return _flat(files.scan_detections(spark, path, start=START, end=END, cameras=CAMERAS))


def nested_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "detections")
    tables.write_partitioned(reshape.nested_rows(_answers(views.frm(spark, sf))), path)
    return files.scan_detections(spark, path).select(
        F.col("camera_id").cast("int").alias("camera_id"), "frame_id", "total_detections", "class_counts",
        F.size("detections").alias("stored_detections"), F.col("month").cast("int").alias("month"), "hour",
    )


def append_to_day(spark: SparkSession, sf: str) -> DataFrame:
    """All detections filed under one camera and day, next to an earlier file."""
    path = scratch_path(spark, "appended")
    rows = views.det(spark, sf).select("event_id", "frame_id", "class_name")
    tables.append_to_day(rows.where(F.col("class_name") == "person"), path, 4, "2024-09-07")
    tables.append_to_day(rows.where(F.col("class_name") != "person"), path, 4, "2024-09-07")
    read = spark.read.parquet(path)
    return read.select("event_id", "frame_id", "class_name", *[F.col(p).cast("int").alias(p) for p in tables.PARTITIONS])


def converted_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of answers converted to a flat Parquet table."""
    source, target = scratch_path(spark, "json"), scratch_path(spark, "parquet")
    answers = _answers(views.frm(spark, sf)).select("camera_id", "frame_id", "class_counts", "detections")
    answers.select(F.struct("camera_id", "frame_id").alias("metadata"), "class_counts", "detections").write.json(source)
    ddl = f"metadata struct<camera_id int, frame_id int>, class_counts string, detections array<{schemas.DETECTION}>"
    documents = spark.read.schema(ddl).json(source)
    reshape.normalize_nested(documents, "_").write.parquet(target)
    return spark.read.parquet(target).withColumn("detections", F.size("detections"))


def _topic_tables(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "topics")
    rows = views.det(spark, sf).drop("value").withColumn("topic", F.concat(F.lit("camera-"), "camera_id", F.lit("-frames")))
    rows.write.partitionBy("topic").parquet(path)
    return path


def topic_union(spark: SparkSession, sf: str) -> DataFrame:
    """One table per camera topic, united again; each is read once."""
    path = _topic_tables(spark, sf)
    names = topics.FRAME_TOPICS.split(",")
    parts = [
        spark.read.option("basePath", path).parquet(f"{path}/topic={name}") for name in names
    ]
    return joins.union_topics(*parts)


def single_camera(spark: SparkSession, sf: str) -> DataFrame:
    path = _topic_tables(spark, sf)
    topic = f"camera-{topics.checked_camera(3)}-frames"
    return spark.read.parquet(path).where(F.col("topic") == topic).drop("topic")


def _datasets(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "base")
    answers = _answers(views.frm(spark, sf))
    tables.write_partitioned(reshape.nested_rows(answers), f"{base}/detections")
    tables.write_partitioned(reshape.flattened_rows(answers), f"{base}/detections_flattened")
    return base


def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per dataset whether every partition has its files; how many and how large they are is Spark's choice."""
    base = _datasets(spark, sf)
    folders = catalog.dataset_listing(spark, base).where("partition <> ''").groupBy("dataset").agg(F.count(F.lit(1)).alias("partitions"))
    return catalog.dataset_stats(spark, base).join(folders, "dataset").select(
        "dataset", "partitions", (F.col("parquet_files") >= F.col("partitions")).alias("covered"), (F.col("bytes") > 0).alias("stored"),
    )


def dataset_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The partition folders of each dataset, and whether they hold anything."""
    found = catalog.dataset_listing(spark, _datasets(spark, sf)).where("partition <> ''")
    return found.select("dataset", "partition", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


def dataset_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Which partitions each dataset has."""
    found = catalog.dataset_listing(spark, _datasets(spark, sf))
    return found.where(F.col("files") > 0).select("dataset", "partition")


def recent_files(spark: SparkSession, sf: str) -> DataFrame:
    """Where the last file by path lies."""
    return catalog.recent_files(spark, f"{_datasets(spark, sf)}/", 1).select("dataset", "partition")


# The operators' own numbers and paths, which Spark chooses; tests compare them with a walk over the folder.


def dataset_files(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet files and bytes of each dataset."""
    return catalog.dataset_stats(spark, _datasets(spark, sf))


def partition_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files and bytes of each partition folder of each dataset."""
    return catalog.dataset_listing(spark, _datasets(spark, sf))


def last_ten_files(spark: SparkSession, sf: str) -> DataFrame:
    """The last ten Parquet files by path, of all datasets."""
    return catalog.recent_files(spark, _datasets(spark, sf)).select("dataset", "partition", "path", "length")


QUERIES = {
    f.__name__: f
    for f in (
        partitioned_roundtrip, pruned_scan, nested_roundtrip, append_to_day, converted_documents, topic_union,
        single_camera, dataset_stats, dataset_listing, dataset_partitions, recent_files,
        dataset_files, partition_files, last_ten_files,
    )
}

_DATED = """
dated as (select *, min(ts) over (partition by camera_id, frame_id) as t from det)"""
_DATE_PARTS = "cast(year(t) as int) as year, cast(month(t) as int) as month, cast(day(t) as int) as day"
_COLUMNS = "event_id, ts, camera_id, frame_id, class_id, class_name, confidence, x, y, w, h"

_FOLDERS = """
folders as (
  select distinct d.dataset, 'year=' || year(t) || '/month=' || month(t) || '/day=' || day(t) || '/camera_id=' || camera_id
    as partition
  from (select camera_id, min(ts) as t from det group by camera_id, frame_id),
    (select unnest(['detections', 'detections_flattened']) as dataset) d)"""

ORACLE = {
    "partitioned_roundtrip": sql(DET, _DATED, body=f"""
select camera_id, frame_id, {FLAT_SQL}, {_DATE_PARTS} from dated"""),
    "pruned_scan": sql(DET, _DATED, body=f"""
select camera_id, frame_id, {FLAT_SQL}, {_DATE_PARTS} from dated
where cast(t as date) between date '{START}' and date '{END}' and camera_id in (1, 2, 5)"""),
    "nested_roundtrip": sql(DET, views.first_seen_classes("det"), body="""
select camera_id, frame_id, cast(n as int) as total_detections, class_counts, cast(n as int) as stored_detections,
  cast(month(t) as int) as month, cast(hour(t) as int) as hour
from classes_by_frame join (select camera_id, frame_id, min(ts) as t, count(*) as n from det group by all)
  using (camera_id, frame_id)"""),
    "append_to_day": sql(DET, body="""
select event_id, frame_id, class_name, cast(2024 as int) as year, cast(9 as int) as month, cast(7 as int) as day,
  cast(4 as int) as camera_id from det"""),
    "converted_documents": sql(DET, views.first_seen_classes("det"), body="""
select camera_id as metadata_camera_id, frame_id as metadata_frame_id, class_counts, cast(n as int) as detections
from classes_by_frame join (select camera_id, frame_id, count(*) as n from det group by all) using (camera_id, frame_id)"""),
    "topic_union": sql(DET, body=f"select {_COLUMNS}, 'camera-' || camera_id || '-frames' as topic from det"),
    "single_camera": sql(DET, body=f"select {_COLUMNS} from det where camera_id = 3"),
    "dataset_partitions": sql(DET, _FOLDERS, body="select dataset, partition from folders"),
    "dataset_listing": sql(DET, _FOLDERS, body="select *, true as has_files, true as has_bytes from folders"),
    "dataset_stats": sql(DET, _FOLDERS, body="""
select dataset, count(*) as partitions, true as covered, true as stored from folders group by dataset"""),
    "recent_files": sql(DET, _FOLDERS, body="""
select dataset, partition from folders order by dataset || '/' || partition || '/' desc limit 1"""),
}
