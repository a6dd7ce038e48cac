"""Building frame and detection messages: the rows that sinks publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.functions import text
from camlytics.schemas import ENGINE


def classes_in_order(detections: str | Column = "detections") -> Column:
    """Distinct class names, first seen first."""
    d = F.col(detections) if isinstance(detections, str) else detections
    return F.array_distinct(F.transform(d, lambda r: r["class_name"]))


def class_counts(detections: str | Column = "detections") -> Column:
    """Class name to count, for one frame."""
    d = F.col(detections) if isinstance(detections, str) else detections
    names = F.transform(d, lambda r: F.coalesce(r["class_name"], F.lit("unknown")))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(names),
            lambda n: F.struct(n, F.size(F.filter(names, lambda m: m == n))),
        )
    )


def with_summary(frames: DataFrame) -> DataFrame:
    """Total, classes and class counts of each frame's detections."""
    counted = frames.withColumn("detections", F.coalesce("detections", F.array()))
    return counted.withColumns(
        {
            "total_detections": F.size("detections"),
            "detection_classes": classes_in_order(),
            "class_counts": class_counts(),
        }
    )


def detection_answer(frames: DataFrame, *, confidence_threshold: float = 0.4, nms_threshold: float = 0.4,
                     processing_engine: str | None = ENGINE, timestamp: str = "timestamp",
                     frame_metadata: str | None = None) -> Column:
    """One frame's detection message as JSON text.

    ``frame_metadata`` names a struct column that is passed through unchanged.
    """
    fields = [
        F.col("camera_id"),
        F.col("frame_id"),
        F.col(timestamp).alias("timestamp"),
        F.col(timestamp).alias("detection_timestamp"),
        F.size("detections").alias("total_detections"),
        classes_in_order().alias("detection_classes"),
        class_counts().alias("class_counts"),
        F.lit(float(confidence_threshold)).alias("confidence_threshold"),
        F.lit(float(nms_threshold)).alias("nms_threshold"),
    ]
    if processing_engine is not None:
        fields.append(F.lit(processing_engine).alias("processing_engine"))
    if frame_metadata is not None:
        fields.append(F.col(frame_metadata).alias("original_frame_metadata"))
    return F.to_json(F.struct(F.struct(*fields).alias("metadata"), "detections"))


def detection_messages(frames: DataFrame, *, spark_suffix: bool = True, **options) -> DataFrame:
    """Topic, key and value of each frame's detection message."""
    return frames.select(
        text.detection_topic("camera_id").alias("topic"),
        text.detection_key("camera_id", "frame_id", spark_suffix).alias("key"),
        detection_answer(frames, **options).alias("value"),
    )


#: Where messages of frames without a camera go; a writer to topics takes no row without one.
UNKNOWN_TOPIC = "camera-unknown-detections"


def answer_messages(answers: DataFrame, *, spark_suffix: bool = True, frame_metadata: str | None = None,
                    unknown_topic: str = UNKNOWN_TOPIC) -> DataFrame:
    """Topic, key and value of each detector answer, from the answer's own columns.

    A failed frame keeps its error and has neither detection time nor
    thresholds. ``frame_metadata`` names a struct column that is passed through
    as ``original_frame_metadata``.
    """
    fields = [
        *[F.col(c) for c in ("camera_id", "frame_id", "timestamp", "detection_timestamp", "total_detections", "detection_classes")],
        F.from_json("class_counts", "map<string, int>").alias("class_counts"),
        *[F.col(c) for c in ("confidence_threshold", "nms_threshold", "processing_engine", "error")],
    ]
    if frame_metadata is not None:
        fields.append(F.col(frame_metadata).alias("original_frame_metadata"))
    return answers.select(
        F.coalesce(text.detection_topic("camera_id"), F.lit(unknown_topic)).alias("topic"),
        text.detection_key("camera_id", "frame_id", spark_suffix).alias("key"),
        F.to_json(F.struct(F.struct(*fields).alias("metadata"), "detections")).alias("value"),
    )


def frame_messages(frames: DataFrame, *, source: str | None = None) -> DataFrame:
    """Topic, key and value of each frame message.

    Wants camera_id, frame_id, timestamp (text), frame_shape and ``image``
    (bytes). Frames whose image is NULL could not be encoded: they are left
    out, and their frame id stays used.
    """
    fields = [
        F.col("camera_id").alias("camId"),
        F.col("frame_id").alias("frameId"),
        F.col("timestamp"),
        F.col("frame_shape"),
        F.lit("base64_jpeg").alias("encoding"),
    ]
    if source is not None:
        fields.append(F.lit(source).alias("source"))
    envelope = F.struct(
        F.struct(*fields).alias("metadata"), text.encode_base64("image").alias("frame_data")
    )
    return frames.where(F.col("image").isNotNull()).select(
        text.frame_topic("camera_id").alias("topic"),
        text.frame_key("camera_id", "frame_id").alias("key"),
        F.to_json(envelope).alias("value"),
    )


def frame_updates(frames: DataFrame) -> DataFrame:
    """Camera, frame and time of each frame."""
    return frames.select("camera_id", "frame_id", "timestamp")


def detection_updates(frames: DataFrame, *carry: str) -> DataFrame:
    """Camera, number of detections and distinct classes of each message."""
    return frames.select(
        "camera_id",
        *carry,
        F.size("detections").alias("detection_count"),
        classes_in_order().alias("classes"),
    )
