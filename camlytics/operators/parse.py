"""Reading frame and detection messages.

Every function here is a narrow projection: no shuffle, no Python, and the same
for a static and a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics import schemas
from camlytics.functions import text


def decode_value(messages: DataFrame) -> DataFrame:
    """Kafka rows to JSON text plus topic."""
    return messages.select(F.col("value").cast("string").alias("json_value"), "topic")


def parse_frames(messages: DataFrame, *, pixels: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Frame envelope as columns.

    The camera is the one named in the payload, else the one in the topic; both
    are kept with a flag that tells when they differ. A malformed message gives
    a row of NULLs marked ``malformed``. ``pixels=False`` parses with a schema
    that has no image field.
    """
    ddl = schemas.FRAME_ENVELOPE if pixels else schemas.FRAME_ENVELOPE_LOG
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), ddl).alias("m"),
        text.camera_from_topic("topic").alias("topic_camera_id"),
        "topic",
        *keep,
    )
    meta = F.col("m.metadata")
    columns = [
        F.coalesce(meta["camId"], F.col("topic_camera_id")).alias("camera_id"),
        meta["camId"].alias("payload_camera_id"),
        "topic_camera_id",
        F.coalesce(meta["camId"] != F.col("topic_camera_id"), F.lit(False)).alias("camera_mismatch"),
        meta["frameId"].alias("frame_id"),
        meta["timestamp"].alias("timestamp"),
        meta["frame_shape"].alias("frame_shape"),
        meta["encoding"].alias("encoding"),
        meta.isNull().alias("malformed"),
        "topic",
    ]
    if pixels:
        columns.append(F.col("m.frame_data").alias("frame_data"))
    return parsed.select(*columns, *keep)


def frame_log(messages: DataFrame) -> DataFrame:
    """Topic, camera, frame and time of each message, without its pixels."""
    return parse_frames(messages, pixels=False).select(
        "topic", F.col("payload_camera_id").alias("camera_id"), "frame_id", "timestamp"
    )


def has_frame(column: str = "frame_data") -> Column:
    """True when the message carries an image."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def with_pixels_only(frames: DataFrame) -> DataFrame:
    """Drops messages without an image, as the consumers do."""
    return frames.where(has_frame())


def valid_cameras(df: DataFrame, camera: str = "camera_id") -> tuple[DataFrame, DataFrame]:
    """Rows of known cameras, and the rest with the reason."""
    ok = text.camera_in_range(camera)
    bad = df.where(~ok).withColumn(
        "error",
        F.concat(F.lit("camera out of range: "), F.coalesce(F.col(camera).cast("string"), F.lit("null"))),
    )
    return df.where(ok), bad


def parse_answers(df: DataFrame, column: str = "detection_results") -> DataFrame:
    """Detector answers (JSON text) as a typed struct; a bad field nulls only itself."""
    return df.withColumn(column, F.from_json(F.col(column), schemas.DETECTION_ANSWER))


def class_count_map(counts: str = "class_counts") -> Column:
    """The class-count text as a map."""
    return F.from_json(F.col(counts), "map<string,int>")


def class_or_unknown(name: str = "class_name") -> Column:
    return F.coalesce(F.col(name), F.lit("unknown"))
