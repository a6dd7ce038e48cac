"""Detection tables, JSON documents and camera videos in files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics.schemas import CAMERA_IDS, camera_dimension, struct_of
from camlytics.session import spread

# Video file names.
VIDEO_GLOB = "cam*.mp4"
VIDEO_CAMERA = r"cam(\d+)\.mp4$"

FRAME_ROWS = "path string, camera_id int, frame_id int, frame_shape array<int>, image binary"

# One decoded frame: encoded image (None when it cannot be encoded), height, width, channels.
Decoder = Callable[[str], Iterable[tuple[bytes | None, int, int, int]]]


def scan_detections(spark: SparkSession, path: str, *, start: date | None = None, end: date | None = None,
                    cameras: list[int] | None = None, merge_schema: bool = False) -> DataFrame:
    """The partitioned detections table; both dates are included.

    The predicates are on the partition columns, so other partitions are never
    opened. A predicate on ``detection_timestamp`` alone would not do that.
    """
    rows = spark.read.option("mergeSchema", merge_schema).parquet(path)
    day = F.make_date("year", "month", "day")
    if start is not None:
        rows = rows.where(day >= F.lit(start))
    if end is not None:
        rows = rows.where(day <= F.lit(end))
    if cameras is not None:
        rows = rows.where(F.col("camera_id").isin(*cameras))
    return rows


def json_documents(spark: SparkSession, path: str, ddl: str, recursive: bool = False) -> DataFrame:
    """Multi-line JSON documents, each file a record or an array of records."""
    reader = spark.read.schema(struct_of(ddl)).option("multiLine", True)
    return reader.option("recursiveFileLookup", recursive).json(path)


def camera_videos(spark: SparkSession, path: str) -> DataFrame:
    """Camera, path, size and time of each video; the contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", VIDEO_GLOB).load(path)
    return files.select(
        F.regexp_extract("path", VIDEO_CAMERA, 1).try_cast("int").alias("camera_id"),
        "path",
        "length",
        "modificationTime",
    )


def missing_videos(spark: SparkSession, path: str, cameras=CAMERA_IDS) -> DataFrame:
    """Known cameras that have no video."""
    return camera_dimension(spark, cameras).join(camera_videos(spark, path), "camera_id", "left_anti")


def frames_from_videos(videos: DataFrame, decoder: Decoder, max_frames: int | None = None,
                       batch_rows: int = 64) -> DataFrame:
    """One row per frame of each video, numbered from 0, one task per file.

    The decoder is the caller's and reads a path frame by frame. Frames it could
    not encode keep their number and a NULL image; ``max_frames`` counts the
    others.
    """
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, camera in zip(batch["path"], batch["camera_id"]):
                rows, encoded = [], 0
                for number, (image, height, width, channels) in enumerate(decoder(path)):
                    if max_frames and encoded >= max_frames:
                        break
                    encoded += image is not None
                    rows.append((path, camera, number, [height, width, channels], image))
                    if len(rows) == batch_rows:
                        yield _frame_rows(rows)
                        rows = []
                if rows:
                    yield _frame_rows(rows)

    return spread(videos.select("path", "camera_id"), "path").mapInPandas(decode, FRAME_ROWS)


def _frame_rows(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["path", "camera_id", "frame_id", "frame_shape", "image"])
