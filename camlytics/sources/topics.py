"""Camera topics as streaming or batch tables.

The functions return option dictionaries and readers; the connector itself is
the cluster's ``spark-sql-kafka`` package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from camlytics.schemas import CAMERA_IDS

# Topic names.
FRAME_TOPICS = ",".join(f"camera-{c}-frames" for c in CAMERA_IDS)
DETECTION_PATTERN = "camera-.*-detections"


def checked_camera(camera: int) -> int:
    """The camera number, or an error when there is no such camera."""
    if camera not in CAMERA_IDS:
        raise ValueError(f"camera id must be between {min(CAMERA_IDS)} and {max(CAMERA_IDS)}: {camera}")
    return camera


def frame_options(servers: str, topics: str = FRAME_TOPICS, *, start: str = "latest",
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options for frame topics; lost offsets do not stop the stream."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": start,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def camera_options(servers: str, camera: int, **more) -> dict[str, str]:
    """Reader options for one camera."""
    return frame_options(servers, f"camera-{checked_camera(camera)}-frames", **more)


def detection_options(servers: str, *, start: str = "latest") -> dict[str, str]:
    """Reader options for all published detections."""
    options = frame_options(servers, start=start)
    del options["subscribe"]
    return options | {"subscribePattern": DETECTION_PATTERN}


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def replay(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Everything the topics hold, from the beginning, as a batch table."""
    whole = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    whole |= {"startingOffsets": "earliest", "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**whole).load()
