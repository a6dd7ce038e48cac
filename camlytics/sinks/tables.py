"""Batch writes of detections, tracks and converted documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics import schemas
from camlytics.operators import reshape
from camlytics.sources import files

# The partition columns of every detections table.
PARTITIONS = ("year", "month", "day", "camera_id")
#: Bytes of a row group of a tracks table: its first and last frame tell whether a lookup reads it.
LOOKUP_BYTES = 1 << 20


def gathered(rows: DataFrame, partitions: tuple[str, ...] = PARTITIONS) -> DataFrame:
    """Rows of one table partition together, for few files per partition.

    REBALANCE splits a large partition over several tasks, so a busy camera does
    not end in one writer. It works for batches and for streams without state.
    """
    return rows.hint("rebalance", *partitions)


def write_partitioned(rows: DataFrame, path: str, mode: str = "append",
                      partitions: tuple[str, ...] = PARTITIONS) -> None:
    """Parquet by date and camera."""
    gathered(rows, partitions).write.mode(mode).partitionBy(*partitions).parquet(path)


def append_to_day(rows: DataFrame, path: str, camera: int, day: str) -> None:
    """Append rows to the partition of one camera and one ``YYYY-MM-DD`` day."""
    year, month, number = (int(part) for part in day.split("-"))
    placed = rows.drop(*PARTITIONS).withColumns(
        {"year": F.lit(year), "month": F.lit(month), "day": F.lit(number), "camera_id": F.lit(int(camera))}
    )
    placed.write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def json_to_parquet(spark: SparkSession, source: str, target: str, ddl: str, mode: str = "append") -> None:
    """JSON documents to Parquet with nested objects as dotted columns."""
    reshape.normalize_nested(files.json_documents(spark, source, ddl)).write.mode(mode).parquet(target)


def write_tracks(tracks: DataFrame, path: str, mode: str = "append") -> None:
    """Tracks by date and camera, sorted for lookups by frame."""
    placed = tracks.withColumns(
        {"year": F.year("timestamp"), "month": F.month("timestamp"), "day": F.dayofmonth("timestamp")}
    )
    writer = gathered(placed).sortWithinPartitions(*PARTITIONS, "frame_id").write.mode(mode)
    writer.option("parquet.block.size", LOOKUP_BYTES).partitionBy(*PARTITIONS).parquet(path)


def find_tracks(spark: SparkSession, path: str, *, camera: int | None = None, frame: int | None = None,
                start=None, end=None) -> DataFrame:
    """Tracks of one camera frame, or within a time span."""
    rows = spark.read.parquet(path)
    if camera is not None:
        rows = rows.where(F.col("camera_id") == camera)
    if frame is not None:
        rows = rows.where(F.col("frame_id") == frame)
    day = F.make_date("year", "month", "day")
    if start is not None:
        at = F.lit(start).cast("timestamp")
        rows = rows.where((day >= F.to_date(at)) & (F.col("timestamp") >= at))
    if end is not None:
        at = F.lit(end).cast("timestamp")
        rows = rows.where((day <= F.to_date(at)) & (F.col("timestamp") < at))
    return rows


class TracksOnce:
    """A ``foreachBatch`` function that writes each batch of a stream of tracks exactly once.

    A batch has a folder of its own under its number and is written there as a
    whole; afterwards its number goes to the table of committed batches. A batch
    that comes again after a crash replaces what it had written, or, if it had
    been committed, is left out. Readers see committed batches only. ``query``
    names the stream: several may write to one path.
    """

    def __init__(self, path: str, query: str = "tracks"):
        self.path, self.query = path, query

    def _committed(self, spark: SparkSession) -> DataFrame:
        folder = f"{self.path}/_committed"
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        schema = "query string, batch bigint, rows bigint"
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return spark.createDataFrame([], schema)
        # A commit that was repeated counts once.
        return spark.read.schema(schema).parquet(f"{folder}/query=*/batch=*").distinct()

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = f"query={self.query}/batch={int(number)}"
        if not self._committed(spark).where((F.col("query") == self.query) & (F.col("batch") == int(number))).isEmpty():
            return
        write_tracks(batch, f"{self.path}/data/{mine}", "overwrite")
        held = spark.read.schema("id bigint").parquet(f"{self.path}/data/{mine}")
        record = held.agg(F.lit(self.query).alias("query"), F.lit(int(number)).cast("bigint").alias("batch"), F.count(F.lit(1)).alias("rows"))
        record.write.mode("overwrite").parquet(f"{self.path}/_committed/{mine}")

    def read(self, spark: SparkSession, ddl: str = schemas.TRACKS) -> DataFrame:
        """Tracks of all committed batches."""
        schema = schemas.struct_of(ddl)
        placed = T.StructType([
            *schema, *[T.StructField(p, T.IntegerType()) for p in ("year", "month", "day")],
            T.StructField("query", T.StringType()), T.StructField("batch", T.LongType()),
        ])
        rows = spark.read.schema(placed).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data")
        # One row per batch.
        return rows.join(F.broadcast(self._committed(spark).select("query", "batch")), ["query", "batch"]).select([f.name for f in schema])


def write_tracks_jdbc(tracks: DataFrame, url: str, table: str = "tracks", **properties: str) -> None:
    """One batch insert of all tracks instead of one per row."""
    tracks.write.jdbc(url, table, mode="append", properties=properties)
