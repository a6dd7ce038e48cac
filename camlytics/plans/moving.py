"""Queries of statistics that move with a stream, run to the end of what is stored.

The ones in event-time order tell what the watermark has passed: rows up to the
newest time less ``DELAY``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics.functions import boxes
from camlytics.operators import alerts, messages
from camlytics.plans import statistics, views
from camlytics.plans.streams import ONCE, _events, _finish
from camlytics.plans.views import DET, SEEN, sql
from camlytics.session import scratch_path
from camlytics.streaming import timers

HOUR = 3600
DELAY = "1 hour"
DAY = 24 * HOUR


def _run(spark: SparkSession, rows: DataFrame, mode: str = "append") -> DataFrame:
    """All that the stream has put out, batch after batch."""
    path, checkpoint = scratch_path(spark, "moving"), scratch_path(spark, "checkpoint")

    def put(batch: DataFrame, _number: int) -> None:
        batch.write.mode("append").parquet(path)

    writer = rows.writeStream.outputMode(mode).foreachBatch(put)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(**ONCE).start())
    return spark.read.schema(rows.schema).parquet(path)


def _as_stream(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Stored rows as a stream."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def stream_liveness(spark: SparkSession, sf: str) -> DataFrame:
    """When each camera became active and inactive, an hour being the limit."""
    return _run(spark, timers.liveness(_events(spark, sf).select("camera_id", "ts"), HOUR, DELAY))


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts raised and expired; each is up for a day."""
    frames = _as_stream(spark, views.visible(spark, sf), "frames")
    return _run(spark, timers.alert_events(alerts.alert_feed(frames), DAY, DELAY))


def stream_window_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly rates of all cameras, silent hours included."""
    frames = _events(spark, sf).select("camera_id", "ts", boxes.above("confidence").cast("bigint").alias("total_detections"))
    return _run(spark, timers.rates(frames, HOUR, DELAY)).drop("frames", "detections")


def stream_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of each camera at every tenth message."""
    frames = views.seen_counts(spark, sf).select("camera_id", "frame_id", "ts", "total_detections")
    return _run(spark, timers.snapshots(_as_stream(spark, frames, "frames"), 10, DELAY))


def stream_last_n(spark: SparkSession, sf: str) -> DataFrame:
    """The last 50 detections of each camera."""
    rows = _events(spark, sf).drop("value")
    held = timers.newest(_run(spark, timers.last_n(rows, 50, ["event_id"]), "update"))
    return held.select(timers.unpacked("row", rows.schema).alias("r")).select("r.*")


def stream_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """The latest frame of each camera with its latest detections, from two streams."""
    frames = views.frame_counts(spark, sf).select("camera_id", "frame_id", "ts")
    answers = views.visible(spark, sf, 0.95).where(F.size("detections") > 0).select(
        "camera_id", "frame_id", "ts", F.size("detections").alias("detections"),
        F.array_join(messages.classes_in_order(), ",").alias("classes"),
    )
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    left, right = (
        _as_stream(spark, rows.withColumn("at", at), name) for rows, name in ((frames, "frames"), (answers, "answers"))
    )
    held = timers.newest(_run(spark, timers.overlay(left, right, ["at"]), "update"))
    f, d = timers.unpacked("frame", left.schema), timers.unpacked("answer", right.schema)
    return held.select("camera_id", f.alias("f"), d.alias("d")).select(
        "camera_id", "f.frame_id", "f.ts", F.col("d.frame_id").alias("detection_frame_id"), "d.detections", "d.classes"
    )


QUERIES = {
    f.__name__: f
    for f in (stream_liveness, stream_alerts, stream_window_rates, stream_snapshots, stream_last_n, stream_overlay)
}


def _upto(rows: str) -> str:
    """The last watermark over these rows."""
    return f"upto as (select date_trunc('milliseconds', max(ts)) - interval {DELAY} as w from {rows})"


ORACLE = {
    "stream_liveness": sql(DET, _upto("det"), """
near as (
  select camera_id, ts, lag(ts) over (partition by camera_id order by ts) as earlier,
    lead(ts) over (partition by camera_id order by ts) as later
  from det where ts <= (select w from upto)
)""", body="""
select camera_id, 'active' as status, ts from near where earlier is null or ts > earlier + interval 1 hour
union all
select camera_id, 'inactive', ts + interval 1 hour from near
where later > ts + interval 1 hour or (later is null and ts + interval 1 hour <= (select w from upto))"""),
    "stream_alerts": sql(DET, statistics._alerts(), _upto("feed"), body="""
select camera_id, 'raised' as event, ts as at, cast(frame_id as bigint) as frame_id, alert, count, message
from feed where ts <= (select w from upto)
union all
select camera_id, 'expired', ts + interval 1 day, cast(frame_id as bigint), alert, count, message
from feed where ts + interval 1 day <= (select w from upto)"""),
    "stream_window_rates": sql(DET, _upto("det"), body="""
select window_start, camera_id, coalesce(n, 0) / 3600.0::double as fps, coalesce(d, 0) / 3600.0::double as detection_rate
from (select unnest(range(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) + interval 1 hour, interval 1 hour))
        as window_start from det)
cross join (select cast(unnest(range(1, 8)) as int) as camera_id)
left join (select date_trunc('hour', ts) as window_start, camera_id, count(*) as n,
             count(*) filter (where confidence > 0.4) as d from det group by all) using (window_start, camera_id)
where window_start + interval 1 hour <= (select w from upto)"""),
    "stream_snapshots": sql(DET, SEEN, _upto("seen"), body="""
select camera_id, cast(frame_id as bigint) as frame_id, ts, total_detections, messages, detections_so_far from (
  select *, count(*) over w as messages, cast(sum(total_detections) over w as bigint) as detections_so_far
  from seen where ts <= (select w from upto)
  window w as (partition by camera_id order by ts, frame_id rows unbounded preceding))
where messages % 10 = 0"""),
    "stream_last_n": statistics.ORACLE["last_n_per_camera"],
    "stream_overlay": statistics.ORACLE["overlay_join"],
}
