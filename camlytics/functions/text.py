"""Topics, keys, names, encodings and date parts as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.schemas import CAMERA_IDS

# Topic and key patterns.
FRAME_TOPIC = r"camera-(\d+)-frames"
DETECTION_TOPIC = r"camera-(\d+)-detections"
FILE_CAMERA = r".*camera_([0-9]*)_.*"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def camera_from_topic(topic="topic", pattern: str = FRAME_TOPIC) -> Column:
    """Camera number in the topic name; NULL when the name does not match."""
    return F.regexp_extract(_c(topic), pattern, 1).try_cast("int")


def frame_topic(camera) -> Column:
    return F.concat(F.lit("camera-"), _c(camera).cast("string"), F.lit("-frames"))


def detection_topic(camera) -> Column:
    return F.concat(F.lit("camera-"), _c(camera).cast("string"), F.lit("-detections"))


def frame_key(camera, frame) -> Column:
    return F.concat(
        F.lit("cam"), _c(camera).cast("string"), F.lit("_frame"), _c(frame).cast("string")
    )


def detection_key(camera, frame, spark_suffix: bool = True) -> Column:
    suffix = "_detections_spark" if spark_suffix else "_detections"
    return F.concat(frame_key(camera, frame), F.lit(suffix))


def camera_in_range(camera="camera_id", cameras=CAMERA_IDS) -> Column:
    """True for a known camera number, false for any other and for NULL."""
    return F.coalesce(_c(camera).isin(*cameras), F.lit(False))


def camera_from_file(path) -> Column:
    return F.regexp_extract(_c(path), FILE_CAMERA, 1).try_cast("int")


def date_fields(day) -> list[Column]:
    """Year, month and day out of a ``YYYY-MM-DD`` text."""
    return [
        F.split_part(_c(day), F.lit("-"), F.lit(i + 1)).try_cast("int").alias(name)
        for i, name in enumerate(("year", "month", "day"))
    ]


def parsed_time(ts) -> Column:
    """ISO text (or a timestamp) as a timestamp; NULL for anything else."""
    return F.try_to_timestamp(_c(ts).cast("string"))


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time column.

    A TIMESTAMP_NTZ is taken apart instead of cast, since a cast goes through
    the session zone, where an hour may be missing.
    """
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    minutes = (F.unix_date(c.cast("date")).cast("bigint") * 24 + F.hour(c)) * 60 + F.minute(c)
    seconds = F.extract(F.lit("SECOND"), c)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def iso_text(ts) -> Column:
    return F.date_format(_c(ts), ISO_MICROS)


def with_date_parts(df: DataFrame, ts: Column | str) -> DataFrame:
    """Adds year, month, day and hour of ``ts``; unreadable times give NULLs."""
    typed = isinstance(ts, str) and isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType))
    t = F.col(ts) if typed else parsed_time(ts)
    return df.withColumns(
        {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}
    )


def encode_base64(binary) -> Column:
    """Base64 text on one line, whatever the session says about line breaks."""
    return F.replace(F.base64(_c(binary)), F.lit("\r\n"), F.lit(""))


def decode_base64(text) -> Column:
    """Decoded bytes; NULL when the text is not base64."""
    return F.try_to_binary(_c(text), F.lit("base64"))


def clock_text(seconds) -> Column:
    """Seconds as HH:MM:SS; hours keep growing past two digits."""
    s = F.floor(_c(seconds)).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("bigint"),
        F.floor((s % 3600) / 60).cast("bigint"),
        s % 60,
    )
