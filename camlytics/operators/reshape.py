"""Changing the shape of detection tables: expand, flatten, explode, regroup."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.functions import text


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct as columns; refuses names that are already taken."""
    fields = [f.name for f in df.schema[column].dataType.fields]
    rest = [c for c in df.columns if c != column]
    clash = sorted(set(fields) & set(rest))
    if clash:
        raise ValueError(f"columns already present: {clash}")
    return df.select(*rest, *[F.col(column)[f].alias(f) for f in fields])


def flatten_answers(df: DataFrame, column: str = "detection_results", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per frame with the answer's metadata as top-level columns."""
    meta = F.col(column)["metadata"]
    return df.select(
        meta["camera_id"].alias("camera_id"),
        meta["frame_id"].alias("frame_id"),
        meta["timestamp"].alias("timestamp"),
        meta["detection_timestamp"].alias("detection_timestamp"),
        meta["total_detections"].alias("total_detections"),
        meta["detection_classes"].alias("detection_classes"),
        meta["class_counts"].alias("class_counts"),
        meta["confidence_threshold"].alias("confidence_threshold"),
        meta["nms_threshold"].alias("nms_threshold"),
        meta["processing_engine"].alias("processing_engine"),
        meta["error"].alias("error"),
        F.col(column)["detections"].alias("detections"),
        *keep,
    )


def explode_detections(frames: DataFrame, *, keep_empty: bool = False,
                       detections: str = "detections") -> DataFrame:
    """One row per detection with flat ``bbox_*`` columns.

    Frames without detections vanish unless ``keep_empty``. They are dropped
    after the explode: a plain ``explode`` adds a filter on the array below it,
    which would parse or detect every frame twice.
    """
    rest = [c for c in frames.columns if c != detections]
    d = F.col("_d")
    rows = frames.select(*rest, F.posexplode_outer(F.col(detections)).alias("_p", "_d"))
    if not keep_empty:
        rows = rows.where(F.col("_p").isNotNull())
    return rows.select(
        *rest,
        d["class_id"].alias("class_id"),
        d["class_name"].alias("class_name"),
        d["confidence"].alias("confidence"),
        *[
            d["bbox"][f].alias(f"bbox_{f}")
            for f in ("x", "y", "width", "height", "center_x", "center_y")
        ],
    )


# The columns that a flattened detection has from its frame.
FRAME_COLUMNS = (
    "camera_id", "frame_id", "timestamp", "detection_timestamp", "total_detections_in_frame", "confidence_threshold",
    "processing_engine",
)


def flattened_rows(frames: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The flattened detections table: one row per detection, ingestion time and date parts.

    Columns are those of the table, and ``keep``; other columns of the answers
    are left out.
    """
    renamed = frames.withColumnRenamed("total_detections", "total_detections_in_frame")
    rows = explode_detections(renamed.select(*FRAME_COLUMNS, *keep, "detections"))
    return text.with_date_parts(
        rows.withColumn("ingestion_timestamp", F.current_timestamp()), "detection_timestamp"
    )


def nested_rows(frames: DataFrame, partition_time: str = "event") -> DataFrame:
    """The nested detections table: one row per frame, ingestion time and date parts.

    ``partition_time`` picks event time (the detection time) or processing time.
    """
    if partition_time not in ("event", "processing"):
        raise ValueError("partition_time is 'event' or 'processing'")
    stamped = frames.withColumn("ingestion_timestamp", F.current_timestamp())
    source = "detection_timestamp" if partition_time == "event" else "ingestion_timestamp"
    return text.with_date_parts(stamped, source)


def normalize_nested(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as ``a.b`` columns; arrays and maps stay as they are."""
    return df.select(*_leaves(df.schema.fields, [], separator))


def _leaves(fields: Iterable[T.StructField], path: list[str], separator: str) -> list[Column]:
    out: list[Column] = []
    for field in fields:
        here = [*path, field.name]
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType.fields, here, separator)
        else:
            out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
    return out


def regroup_to_frames(detections: DataFrame, *, record: Column, order: list[str],
                      keys: tuple[str, ...] = ("camera_id", "frame_id"), **aggregates: Column) -> DataFrame:
    """Detections back to one row per frame, records in the given order.

    The key is one camera frame, whose size the detector bounds; the shuffle
    hashes on the pair, so a busy camera spreads over all partitions. Rows that
    name no camera or frame belong to no common frame: each stays a frame of its
    own instead of all of them meeting in one group.
    """
    entry = F.struct(*[F.col(c) for c in order], record.alias("_record"))
    unknown = reduce(or_, [F.col(k).isNull() for k in keys])
    grouped = detections.groupBy(
        *keys, F.when(unknown, F.struct(*order)).alias("_alone")
    ).agg(
        F.array_sort(F.collect_list(entry)).alias("_entries"),
        *[expr.alias(name) for name, expr in aggregates.items()],
    )
    return grouped.select(
        *keys,
        *aggregates.keys(),
        F.transform("_entries", lambda e: e["_record"]).alias("detections"),
    )
