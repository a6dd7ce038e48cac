"""Joins between frames, detections and expected objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camlytics.operators import ordered


def overlay(frames: DataFrame, detection_messages: DataFrame, *, frame_columns: list[str],
            detection_columns: list[str], frame_order: list[str], detection_order: list[str]) -> DataFrame:
    """Latest frame of each camera with that camera's latest detections, if any.

    The two are matched on the camera alone, so they may belong to different frames.
    """
    newest_frame = ordered.latest(frames, ["camera_id"], frame_order, frame_columns)
    newest_answer = ordered.latest(
        detection_messages, ["camera_id"], detection_order, detection_columns
    )
    clash = set(frame_columns) & set(detection_columns)
    for name in clash:
        newest_answer = newest_answer.withColumnRenamed(name, f"detection_{name}")
    return newest_frame.join(newest_answer, "camera_id", "left")


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows with no counterpart.

    The present keys are made distinct before the shuffle, so a key that fills
    a third of the table arrives as one row per task.
    """
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")


def is_complete(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Found and expected counts, and whether nothing is missing."""
    wanted = expected.select(*keys).distinct()
    here = present.select(*keys).distinct().withColumn("_here", F.lit(1))
    return wanted.join(here, keys, "left").agg(
        F.count("_here").alias("found"),
        F.count(F.lit(1)).alias("expected"),
        (F.count("_here") == F.count(F.lit(1))).alias("complete"),
    )


def to_load(source: DataFrame, target: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Source rows to append: those not in the target yet, or all when forced."""
    return source if force else missing(source, target, keys)


def union_topics(*streams: DataFrame) -> DataFrame:
    """One relation out of per-camera ones."""
    return reduce(lambda a, b: a.unionByName(b), streams)
