"""Totals, averages and per-camera state over frames and detections.

``frames`` has one row per frame message with ``camera_id``, ``ts`` and
``total_detections``; ``detections`` has one row per detection. Every aggregate
is combined before its shuffle, so a busy camera costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.functions import text
from camlytics.functions.boxes import above
from camlytics.operators.parse import class_or_unknown
from camlytics.schemas import CAMERA_IDS, camera_dimension


def frame_counts(detections: DataFrame, keys=("camera_id", "frame_id"), ts: str = "ts") -> DataFrame:
    """Frames with their number of detections, straight from detection rows."""
    return detections.groupBy(*keys).agg(
        F.min(ts).alias("ts"), F.count(F.lit(1)).alias("total_detections")
    )


def class_counts_per_frame(detections: DataFrame, keys=("camera_id", "frame_id")) -> DataFrame:
    return detections.groupBy(*keys, class_or_unknown().alias("class_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _detections(column: str = "total_detections") -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def global_totals(frames: DataFrame, published: Column | None = None) -> DataFrame:
    """Frames, detections and published messages (all frames unless told)."""
    was_published = F.lit(True) if published is None else published
    return frames.agg(
        F.count(F.lit(1)).alias("total_frames"),
        _detections().alias("total_detections"),
        F.count_if(was_published).alias("total_published"),
    )


def average_detections(frames: DataFrame) -> DataFrame:
    """Detections per frame over all frames, quiet ones included; NULL without frames."""
    return frames.agg(
        F.try_divide(_detections(), F.count(F.lit(1))).alias("avg_detections")
    )


def throughput(frames: DataFrame, ts: str = "ts") -> DataFrame:
    """Frames per elapsed second between the first and last frame, 0 when none elapsed."""
    at = text.micros(frames, ts)
    elapsed = (F.max(at) - F.min(at)) / F.lit(1e6)
    n = F.count(F.lit(1))
    return frames.agg(
        n.alias("total_frames"),
        F.coalesce(elapsed, F.lit(0.0)).alias("elapsed_seconds"),
        F.when(elapsed > 0, n / elapsed).otherwise(F.lit(0.0)).alias("frames_per_second"),
    )


def detections_by_camera(frames: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Detections of each camera that sent a frame, zero included."""
    out = frames.groupBy("camera_id").agg(_detections().alias("detections"))
    return out.orderBy("camera_id") if ordered else out


def detections_by_class(detections: DataFrame, *, ordered: bool = False) -> DataFrame:
    out = detections.groupBy(class_or_unknown().alias("class_name")).agg(
        F.count(F.lit(1)).alias("detections")
    )
    return out.orderBy("class_name") if ordered else out


def camera_class_counts(detections: DataFrame, *, pivot: list[str] | None = None) -> DataFrame:
    """Detections by camera and class; ``pivot`` turns the named classes into columns."""
    rows = detections.withColumn("class_name", class_or_unknown())
    if pivot is not None:
        return rows.groupBy("camera_id").pivot("class_name", pivot).count().na.fill(0)
    return rows.groupBy("camera_id", "class_name").agg(F.count(F.lit(1)).alias("detections"))


def last_seen(frames: DataFrame, detection_messages: DataFrame | None = None, ts: str = "ts",
              has_message: Column | None = None) -> DataFrame:
    """Last frame time and last detection message time of each camera.

    Any detection message moves the second, also one without detections. Where
    the frames themselves tell which have a message, ``has_message`` says so and
    one pass over them does.
    """
    if detection_messages is None:
        both = frames.select("camera_id", F.col(ts).alias("f"), F.when(has_message, F.col(ts)).alias("d"))
    else:
        both = frames.select("camera_id", F.col(ts).alias("f"), F.lit(None).alias("d")).unionByName(
            detection_messages.select("camera_id", F.lit(None).alias("f"), F.col(ts).alias("d"))
        )
    return both.groupBy("camera_id").agg(
        F.max("f").alias("last_frame_time"), F.max("d").alias("last_detection_time")
    )


def cameras_seen(frames: DataFrame) -> DataFrame:
    """How many cameras ever sent a frame."""
    return frames.agg(F.countDistinct("camera_id").alias("active_cameras"))


def camera_list(frames: DataFrame, cameras=CAMERA_IDS) -> DataFrame:
    """All known cameras and whether each was ever seen."""
    seen = frames.select("camera_id").distinct().withColumn("seen", F.lit(True))
    return (
        camera_dimension(frames.sparkSession, cameras)
        .join(seen, "camera_id", "left")
        .withColumn("seen", F.coalesce("seen", F.lit(False)))
    )


def zero_filled(per_camera: DataFrame, cameras=CAMERA_IDS) -> DataFrame:
    """Every known camera, with 0 where a count is missing."""
    counts = [f.name for f in per_camera.schema if f.dataType.typeName() in ("long", "integer", "double")
              and f.name != "camera_id"]
    dimension = camera_dimension(per_camera.sparkSession, cameras)
    return dimension.join(per_camera, "camera_id", "left").na.fill(0, counts)


def alive(last: str, as_of: Column, seconds: int) -> Column:
    """'active' when ``last`` is strictly less than ``seconds`` before ``as_of``."""
    recent = F.col(last) > as_of - F.expr(f"interval {int(seconds)} seconds")
    return F.when(recent, "active").otherwise("inactive")


def camera_status(frames: DataFrame, detection_messages: DataFrame | None, as_of: Column, *,
                  cameras=CAMERA_IDS, frame_seconds: int = 10, detection_seconds: int = 30,
                  ts: str = "ts") -> DataFrame:
    """Totals and liveness of every known camera at the time ``as_of``.

    Without ``detection_messages`` every frame is one: one pass counts both.
    """
    counted = [F.count(F.lit(1)).alias("total_frames"), F.max(ts).alias("last_frame_time")]
    found = [_detections().alias("total_detections"), F.max(ts).alias("last_detection_time")]
    if detection_messages is None:
        totals = frames.groupBy("camera_id").agg(*counted, *found)
    else:
        detected = detection_messages.groupBy("camera_id").agg(*found)
        totals = frames.groupBy("camera_id").agg(*counted).join(detected, "camera_id", "full")
    status = zero_filled(totals, cameras)
    return status.select(
        "camera_id",
        "total_frames",
        "total_detections",
        "last_frame_time",
        "last_detection_time",
        alive("last_frame_time", as_of, frame_seconds).alias("status"),
        alive("last_detection_time", as_of, detection_seconds).alias("detection_status"),
    )


def any_camera_detecting(status: DataFrame) -> DataFrame:
    active = F.col("detection_status") == "active"
    return status.agg(F.coalesce(F.bool_or(active), F.lit(False)).alias("detecting"))


def mean_processing_time(frames: DataFrame, ms: str = "processing_time_ms", keys=()) -> DataFrame:
    return frames.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"), F.avg(ms).alias("avg_processing_time_ms")
    )


def frame_service_counts(detections: DataFrame, threshold: float = 0.5, inclusive: bool = True) -> DataFrame:
    """Per frame: detections past the threshold and confirmed tracks among them.

    ``detections`` holds tracked rows with ``confidence`` and ``is_confirmed``.
    """
    passed = above("confidence", threshold, inclusive)
    return detections.groupBy("camera_id", "frame_id").agg(
        F.count_if(passed).alias("detections_count"),
        F.count_if(passed & F.coalesce("is_confirmed", F.lit(False))).alias("tracks_count"),
    )


def service_counters(per_frame: DataFrame) -> DataFrame:
    """Totals over ``frame_service_counts``; tracks are observations, not distinct objects."""
    return per_frame.agg(
        F.count(F.lit(1)).alias("total_frames_processed"),
        F.coalesce(F.sum("detections_count"), F.lit(0)).alias("total_detections"),
        F.coalesce(F.sum("tracks_count"), F.lit(0)).alias("total_tracks_created"),
    )


def distinct_tracks(tracked: DataFrame) -> DataFrame:
    """Confirmed objects of each camera, each counted once."""
    ids = tracked.where("is_confirmed").select("camera_id", "track_id").distinct()
    return ids.groupBy("camera_id").agg(F.count(F.lit(1)).alias("tracks"))


def batch_outcome(results: DataFrame, error: str = "error", keys=()) -> DataFrame:
    """Frames in, frames without an error."""
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_frames"),
        F.count_if(F.col(error).isNull()).alias("successful_frames"),
    )
