"""Queries that run a stream over the events table to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics import fixtures, schemas
from camlytics.fixtures import table
from camlytics.functions import boxes, text
from camlytics.operators import messages, reshape
from camlytics.plans import objects, parsing, views
from camlytics.plans.views import DET, sql
from camlytics.schemas import ENGINE
from camlytics.session import scratch_path
from camlytics.streaming import app, sinks, state

ONCE = {"availableNow": True}
DAY = 86400


def _events(spark: SparkSession, sf: str, **options) -> DataFrame:
    """The events table as a stream of detections; a pattern serves both a file and a folder."""
    schema = table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).options(**options)
    return fixtures.as_detections(reader.parquet(f"{sf}/events.parquet*"))


def _answers(detections: DataFrame) -> DataFrame:
    """Each detection as a one-detection answer, which needs no grouping in the stream."""
    return detections.select(
        "camera_id", "frame_id", "event_id", text.iso_text("ts").alias("timestamp"),
        text.iso_text("ts").alias("detection_timestamp"),
        F.lit(1).alias("total_detections"),
        F.lit(views.THRESHOLD).alias("confidence_threshold"),
        F.lit(ENGINE).alias("processing_engine"),
        F.array(fixtures.record()).alias("detections"),
    )


def _finish(query) -> None:
    query.awaitTermination()


def stream_flatten(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    answers = _answers(_events(spark, sf))
    _finish(sinks.start(answers, "parquet-flattened", path=path, checkpoint=checkpoint, trigger=ONCE, keep=("event_id",)))
    rows = spark.read.parquet(f"{path}_flattened")
    return rows.select(
        "event_id", F.col("camera_id").cast("int").alias("camera_id"), "frame_id", "class_name", "confidence",
        "bbox_center_x", *[F.col(p).cast("int").alias(p) for p in ("year", "month", "day", "hour")],
    )


def stream_json_files(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    _finish(sinks.start(_answers(_events(spark, sf)), "files", path=path, checkpoint=checkpoint, trigger=ONCE))
    rows = spark.read.schema("camera_id int, frame_id int, timestamp string, detections array<struct<class_name string>>").json(path)
    return rows.select("camera_id", "frame_id", "timestamp", F.col("detections")[0]["class_name"].alias("class_name"))


def stream_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rates of all days, the last one as far as it has come: each batch replaces the windows it changed."""
    path, checkpoint = scratch_path(spark, "rates"), scratch_path(spark, "checkpoint")
    frames = _events(spark, sf).select(
        "camera_id", F.col("ts").cast("timestamp").alias("ts"),
        boxes.above("confidence").cast("bigint").alias("total_detections"),
    )
    rates = state.rates(frames, DAY, delay="1 hour")

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    writer = rates.writeStream.outputMode("update").foreachBatch(put)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    written = spark.read.parquet(path)
    newest = written.groupBy("window_start", "camera_id").agg(F.max("batch").alias("batch"))
    rows = written.join(newest, ["window_start", "camera_id", "batch"]).drop("batch")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_running_totals(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "totals"), scratch_path(spark, "checkpoint")
    totals = state.class_totals(_events(spark, sf))

    def replace(batch: DataFrame, _number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = totals.writeStream.outputMode("complete").foreachBatch(replace)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    return spark.read.parquet(path)


def stream_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """The tracker as a stream; a batch is bounded by the size of its files, and frames may go on in the next one."""
    return _stream_tracks(spark, fixtures.as_lanes(_events(spark, sf, maxBytesPerTrigger=str(256 << 20))))


def stream_tracks_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """``stream_tracks`` on all detections with their own boxes."""
    return _stream_tracks(spark, _events(spark, sf, maxBytesPerTrigger=str(256 << 20)))


def _stream_tracks(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path, checkpoint = scratch_path(spark, "tracks"), scratch_path(spark, "checkpoint")
    writer = state.track_objects(rows).writeStream.outputMode("append").format("parquet").option("path", path)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    return spark.read.parquet(path)


# The job: frame messages through the detector into a sink ------------------

JOB_THRESHOLD = 0.6


def _job(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Frame messages, written as a topic's rows, as a stream of detector answers.

    Every eleventh frame number comes without a camera; a frame with an event
    id divisible by 29 makes the detector fail.
    """
    line = F.concat_ws(
        " ", F.when(F.col("event_id") % 29 == 0, "fail").otherwise("ok"), "event_id", "class_id", "class_name",
        "confidence", "x", "y", "w", "h",
    )
    grouped = reshape.regroup_to_frames(views.det(spark, sf), order=["event_id"], record=line, ts=F.min("ts"))
    frames = grouped.select(
        F.when(F.col("frame_id") % 11 != 0, F.col("camera_id")).alias("camera_id"), "frame_id",
        text.iso_text("ts").alias("timestamp"), F.array(F.lit(1080), F.lit(1920), F.lit(3)).alias("frame_shape"),
        F.concat_ws("\n", "detections").cast("binary").alias("image"),
    )
    path = scratch_path(spark, "messages")
    sent = messages.frame_messages(frames).select(F.col("value").cast("binary").alias("value"), "topic")
    sent.write.parquet(path)
    stream = spark.readStream.schema(sent.schema).parquet(path)
    return app.answers(stream, parsing.stub_detector, JOB_THRESHOLD, **options)


def stream_detect(spark: SparkSession, sf: str) -> DataFrame:
    """The flattened table as the job writes it, all columns but the times of writing."""
    path, checkpoint = scratch_path(spark, "detected"), scratch_path(spark, "checkpoint")
    _finish(sinks.start(_job(spark, sf), "parquet-flattened", path=path, checkpoint=checkpoint, trigger=ONCE))
    rows = spark.read.parquet(f"{path}_flattened").drop("ingestion_timestamp")
    return rows.withColumns({c: F.col(c).cast("int") for c in ("camera_id", "year", "month", "day", "hour")})


def stream_detect_nested(spark: SparkSession, sf: str) -> DataFrame:
    """The nested table with the raw frames: sizes, errors and length of the image text of each frame."""
    path, checkpoint = scratch_path(spark, "detected"), scratch_path(spark, "checkpoint")
    rows = _job(spark, sf, keep_frame=True)
    _finish(sinks.start(rows, "parquet", path=path, checkpoint=checkpoint, trigger=ONCE))
    return spark.read.parquet(path).select(
        F.col("camera_id").cast("int").alias("camera_id"), "frame_id", "timestamp", "total_detections", "error",
        F.size("detections").alias("stored"), F.length(F.unbase64("frame_data").cast("string")).alias("image_chars"),
        F.col("month").cast("int").alias("month"),
    )


def _published(spark: SparkSession, sf: str) -> str:
    """The job's messages as the rows of a topic, kept in files."""
    path, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    rows = sinks.topic_rows(_job(spark, sf, frame_metadata=True))
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    return path


def stream_publish(spark: SparkSession, sf: str) -> DataFrame:
    """What the messages say: thresholds and errors are the answers' own, no row is without a topic."""
    value = F.from_json("value", schemas.DETECTION_ANSWER)
    rows = spark.read.parquet(_published(spark, sf)).select("topic", "key", value.alias("v"))
    meta = F.col("v.metadata")
    return rows.select(
        "topic", "key", meta["frame_id"].alias("frame_id"), meta["total_detections"].alias("total_detections"),
        meta["confidence_threshold"].alias("confidence_threshold"), meta["nms_threshold"].alias("nms_threshold"),
        meta["error"].alias("error"), meta["detection_timestamp"].alias("detection_timestamp"),
        meta["original_frame_metadata"]["frameId"].alias("meta_frame"),
        meta["original_frame_metadata"]["timestamp"].alias("meta_timestamp"),
    )


def stream_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """Published messages read back as a stream into the state of each camera."""
    source, path, checkpoint = _published(spark, sf), scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    stream = spark.readStream.schema("topic string, key string, value string").parquet(source)
    flat = app.published_detections(stream)
    totals = flat.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("total_detections").alias("detections"),
        F.count("error").alias("failed"), F.max("timestamp").alias("last_message"),
    )

    def replace(batch: DataFrame, _number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = totals.writeStream.outputMode("complete").foreachBatch(replace)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    return spark.read.parquet(path)


_JOB = f"""
job as (
  select case when frame_id % 11 <> 0 then camera_id end as cam, camera_id, frame_id, min(ts) as t,
    strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') as timestamp, bool_or(event_id % 29 = 0) as failed,
    count(*) filter (where confidence > {JOB_THRESHOLD}) as n
  from det group by camera_id, frame_id
)"""

QUERIES = {
    f.__name__: f
    for f in (stream_detect, stream_detect_nested, stream_publish, stream_read_back, stream_flatten, stream_json_files, stream_rates, stream_running_totals, stream_tracks, stream_tracks_boxes)
}

ORACLE = {
    "stream_detect": sql(DET, _JOB, body=f"""
select cam as camera_id, frame_id, timestamp, timestamp as detection_timestamp, cast(n as int) as total_detections_in_frame,
  cast({JOB_THRESHOLD} as double) as confidence_threshold, 'spark-yolo' as processing_engine, class_id, class_name,
  confidence, x as bbox_x, y as bbox_y, w as bbox_width, h as bbox_height,
  cast(trunc((x + x + w) / 2.0) as int) as bbox_center_x, cast(trunc((y + y + h) / 2.0) as int) as bbox_center_y,
  cast(year(t) as int) as year, cast(month(t) as int) as month, cast(day(t) as int) as day, cast(hour(t) as int) as hour
from det join job using (camera_id, frame_id) where not failed and confidence > {JOB_THRESHOLD}"""),
    "stream_detect_nested": sql(DET, _JOB, body="""
select cam as camera_id, frame_id, timestamp, cast(case when failed then 0 else n end as int) as total_detections,
  case when failed then 'detector failed' end as error, cast(case when failed then 0 else n end as int) as stored,
  cast(image_chars as int) as image_chars, cast(case when not failed then month(t) end as int) as month
from job join (
  select camera_id, frame_id, count(*) - 1 + sum(length(
    (case when event_id % 29 = 0 then 'fail ' else 'ok ' end) || event_id || ' ' || class_id || ' ' || class_name || ' '
    || confidence || ' ' || x || ' ' || y || ' ' || w || ' ' || h)) as image_chars
  from det group by camera_id, frame_id) using (camera_id, frame_id)"""),
    "stream_publish": sql(DET, _JOB, body=f"""
select coalesce('camera-' || cam || '-detections', 'camera-unknown-detections') as topic,
  'cam' || cam || '_frame' || frame_id || '_detections_spark' as key, frame_id,
  cast(case when failed then 0 else n end as int) as total_detections,
  case when not failed then cast({JOB_THRESHOLD} as double) end as confidence_threshold,
  case when not failed then cast(0.4 as double) end as nms_threshold,
  case when failed then 'detector failed' end as error, case when not failed then timestamp end as detection_timestamp,
  frame_id as meta_frame, timestamp as meta_timestamp
from job"""),
    "stream_read_back": sql(DET, _JOB, body="""
select cam as camera_id, count(*) as messages, cast(sum(case when failed then 0 else n end) as bigint) as detections,
  count(*) filter (where failed) as failed, max(timestamp) as last_message from job group by cam"""),
    "stream_flatten": sql(DET, body="""
select event_id, camera_id, frame_id, class_name, confidence, cast(x + floor(w / 2.0) as int) as bbox_center_x,
  cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day,
  cast(hour(ts) as int) as hour from det"""),
    "stream_json_files": sql(DET, body="""
select camera_id, frame_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, class_name from det"""),
    "stream_rates": sql(DET, body="""
select window_start, camera_id, frames, detections, frames / 86400.0::double as fps,
  detections / 86400.0::double as detection_rate
from (select date_trunc('day', ts) as window_start, camera_id, count(*) as frames,
        count(*) filter (where confidence > 0.4) as detections from det group by 1, 2)"""),
    "stream_tracks": objects.tracks_sql("select *, false as late from tracked"),
    "stream_running_totals": sql(DET, body="""
select camera_id, class_name, count(*) as detections from det group by all"""),
}
