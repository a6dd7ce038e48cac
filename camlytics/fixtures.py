"""The test tables re-read as detections.

Eight consecutive events are one frame of one camera; the ids, classes and
boxes follow from the event's own columns, so the views grow with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics.operators import reshape

# Event type -> (class id, class name).
EVENT_CLASSES = {
    "signup": (0, "person"),
    "purchase": (2, "car"),
    "click": (3, "motorcycle"),
    "view": (5, "bus"),
}
OTHER_CLASS = (7, "truck")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_event_type(index: int) -> Column:
    chosen = None
    for event_type, pair in EVENT_CLASSES.items():
        test = F.col("event_type") == event_type
        chosen = F.when(test, pair[index]) if chosen is None else chosen.when(test, pair[index])
    return chosen.otherwise(OTHER_CLASS[index])


def as_detections(events: DataFrame) -> DataFrame:
    """``det``: one row per detection. Works on a static or a streaming input."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        "ts",
        F.expr("cast((event_id div 8) % 7 + 1 as int)").alias("camera_id"),
        F.expr("cast(event_id div 56 as int)").alias("frame_id"),
        _by_event_type(0).cast("int").alias("class_id"),
        _by_event_type(1).alias("class_name"),
        (k.cast("double") / F.lit(100)).alias("confidence"),
        F.floor("value").cast("int").alias("x"),
        k.alias("y"),
        (F.lit(20) + F.col("user_id") % 50).cast("int").alias("w"),
        (F.lit(20) + F.col("user_id") % 90).cast("int").alias("h"),
        "value",
    )


def det(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_detections(table(spark, sf_dir, "events"))


def as_lanes(detections: DataFrame) -> DataFrame:
    """Detections moved to eight lanes that never meet, so that true tracks follow from lane and time.

    Sixth to eighth of the columns are new boxes; half of the detections are
    left out, and the last lane is empty for forty frames at a time.
    """
    lane = F.col("event_id") % 8
    seen = (F.col("confidence") >= 0.5) & ((lane != 7) | (F.expr("frame_id div 40") % 2 == 0))
    return detections.where(seen).withColumns({
        "x": (lane * 1000 + F.col("y") % 5).cast("int"), "y": lane.cast("int"),
        "w": F.lit(100), "h": F.lit(100),
    }).drop("value")


def frm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``det`` grouped to frames: ts, proc_ms and the detections in id order."""
    return frames_of(det(spark, sf_dir))


def frames_of(detections: DataFrame) -> DataFrame:
    return reshape.regroup_to_frames(
        detections,
        order=["event_id"],
        record=record(),
        ts=F.min("ts"),
        proc_ms=F.sum("value"),
    )


def record() -> Column:
    """A det row as a detection record."""
    from camlytics.functions import boxes

    return F.struct(
        "class_id",
        "class_name",
        "confidence",
        boxes.size_box("x", "y", "w", "h").alias("bbox"),
    )
