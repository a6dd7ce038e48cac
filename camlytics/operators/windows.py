"""Rates, running state, snapshots and uptime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.functions import text
from camlytics.operators import ordered
from camlytics.schemas import CAMERA_IDS
from camlytics.session import spread


def window_grid(span: DataFrame, width: int, cameras=CAMERA_IDS) -> DataFrame:
    """Every window start between ``first`` and ``last`` of a one-row table, per camera.

    The row is widened to one row per 4096 windows, spread over the cluster and
    widened again there, so a long span is not built by one task.
    """
    coarse = F.expr(f"interval {width * 4096} seconds")
    fine = F.expr(f"interval {width} seconds")
    lows = F.explode(F.sequence("first", "last", coarse)).alias("lo")
    blocks = spread(span.where("first is not null").select("last", lows), "lo")
    upper = F.least(F.col("last"), F.col("lo") + F.expr(f"interval {width * 4095} seconds"))
    starts = blocks.select(F.explode(F.sequence("lo", upper, fine)).alias("window_start"))
    ids = F.array(*[F.lit(int(c)) for c in cameras])
    return starts.select("window_start", F.explode(ids).alias("camera_id"))


def window_counts(frames: DataFrame, width: int, ts: str = "ts") -> DataFrame:
    """Frames and detections by camera and window; static or streaming."""
    return (
        frames.groupBy(F.window(ts, f"{width} seconds").alias("w"), "camera_id")
        .agg(F.count(F.lit(1)).alias("frames"), F.sum("total_detections").alias("detections"))
        .select(F.col("w.start").alias("window_start"), "camera_id", "frames", "detections")
    )


def _rates(width: int) -> list[Column]:
    return [
        (F.col("frames") / F.lit(float(width))).alias("fps"),
        (F.col("detections") / F.lit(float(width))).alias("detection_rate"),
    ]


def tumbling_rates(frames: DataFrame, width: int = 5, *, ts: str = "ts", cameras=CAMERA_IDS,
                   zero_fill: bool = True, start=None, end=None) -> DataFrame:
    """Frames and detections per second for each window of ``width`` seconds.

    With ``zero_fill`` every known camera appears in every window of the span:
    from the first frame to the last, or from ``start`` to before ``end`` where
    these are given. Give them where clocks may be wrong, since one wrong time
    stretches the span of the data; frames outside are not counted then.
    """
    at = F.col(ts)
    kind = frames.schema[ts].dataType
    if start is not None:
        frames = frames.where(at >= F.lit(start).cast(kind))
    if end is not None:
        frames = frames.where(at < F.lit(end).cast(kind))
    counts = window_counts(frames, width, ts)
    if zero_fill:
        opens = lambda c: F.window(c, f"{width} seconds")["start"]
        before = F.expr("interval 1 microsecond")
        span = frames.agg(
            (F.min(ts) if start is None else F.lit(start).cast(kind)).alias("a"),
            (F.max(ts) if end is None else F.lit(end).cast(kind) - before).alias("b"),
        ).select(opens(F.col("a")).alias("first"), "b").select("first", opens(F.col("b")).alias("last"))
        zeros = window_grid(span, width, cameras).withColumns(
            {"frames": F.lit(0).cast("bigint"), "detections": F.lit(0).cast("bigint")}
        )
        counts = (
            zeros.unionByName(counts)
            .groupBy("window_start", "camera_id")
            .agg(F.sum("frames").alias("frames"), F.sum("detections").alias("detections"))
        )
    return counts.select("window_start", "camera_id", *_rates(width))


def global_rate(rates: DataFrame) -> DataFrame:
    """Detection rate of all cameras together, per window."""
    return rates.groupBy("window_start").agg(
        F.sum("detection_rate").alias("detection_rate"),
        F.round(F.sum("detection_rate"), 1).alias("shown"),
    )


def rate_limited(frames: DataFrame, every: str = "100 milliseconds", *, ts: str = "ts",
                 tie: str = "frame_id") -> DataFrame:
    """The newest frame of each camera in each polling interval."""
    polled = frames.withColumn("poll", F.window(ts, every)["start"])
    return ordered.latest(polled, ["camera_id", "poll"], [ts, tie])


def running_totals(detections: DataFrame, order: list[str],
                   rows_per_block: int = ordered.ROWS_PER_BLOCK) -> DataFrame:
    """Totals so far, per camera and per camera and class, at each detection."""
    one = F.lit(1).cast("bigint")
    return ordered.running_sums_by(
        detections,
        {
            "camera_total": (["camera_id"], one),
            "class_total": (["camera_id", "class_name"], one),
        },
        order,
        rows_per_block,
    )


def frame_totals(frames: DataFrame, order: list[str], keys: list[str] | None = None,
                 rows_per_block: int = ordered.ROWS_PER_BLOCK) -> DataFrame:
    """Message count and detections so far at each frame."""
    sums = {
        "messages": F.lit(1).cast("bigint"),
        "detections_so_far": F.col("total_detections").cast("bigint"),
    }
    return ordered.running_sums(frames, keys or [], order, sums, rows_per_block)


def snapshots(frames: DataFrame, order: list[str], every: int = 10, keys: list[str] | None = None,
              rows_per_block: int = ordered.ROWS_PER_BLOCK) -> DataFrame:
    """The running totals at each ``every``-th message."""
    totals = frame_totals(frames, order, keys, rows_per_block)
    return totals.where(F.col("messages") % every == 0)


def frame_sequence(frames: DataFrame, order: list[str], name: str = "frame_id",
                   rows_per_block: int = ordered.ROWS_PER_BLOCK) -> DataFrame:
    """Frame ids from 0 within each camera."""
    return ordered.numbered(frames, ["camera_id"], order, name, 0, rows_per_block)


def with_defaults(messages: DataFrame, order: list[str], now: Column, camera: str = "camera_id",
                  frame: str = "frame_id", timestamp: str = "timestamp",
                  rows_per_block: int = ordered.ROWS_PER_BLOCK) -> DataFrame:
    """Missing camera, frame id and time filled in.

    The camera reads ``unknown``, the frame id is the number of messages before
    this one, the time is ``now``.
    """
    counted = ordered.numbered(messages, [], order, "_position", 0, rows_per_block)
    return counted.withColumns(
        {
            camera: F.coalesce(F.col(camera).cast("string"), F.lit("unknown")),
            frame: F.coalesce(F.col(frame).cast("bigint"), F.col("_position")),
            timestamp: F.coalesce(F.col(timestamp), now),
        }
    ).drop("_position")


def uptime(frames: DataFrame, ts: str = "ts", keys=()) -> DataFrame:
    """Seconds between first and last frame, also as HH:MM:SS."""
    at = text.micros(frames, ts)
    return frames.groupBy(*keys).agg(
        ((F.max(at) - F.min(at)) / F.lit(1e6)).alias("uptime_seconds")
    ).withColumn("uptime", text.clock_text("uptime_seconds"))
