"""The streaming job: camera topics in, detections out.

``run`` is the whole job; its pieces are plain functions on DataFrames, so the
same code runs on a topic, a file stream or a table.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from camlytics import schemas
from camlytics.functions import text
from camlytics.operators import detect, parse, reshape
from camlytics.sources import topics
from camlytics.streaming import sinks


@dataclass(frozen=True)
class Config:
    """The variable names and the default threshold."""

    servers: str
    topics: str = topics.FRAME_TOPICS
    threshold: float = 0.4
    path: str | None = None
    checkpoint: str | None = None
    keep_frame: bool = False

    @classmethod
    def from_env(cls, env=os.environ) -> Config:
        return cls(
            servers=env["KAFKA_SERVERS"],
            topics=env.get("CAMERA_TOPICS", topics.FRAME_TOPICS),
            threshold=float(env.get("CONFIDENCE_THRESHOLD", "0.4")),
            path=env.get("HDFS_PATH"),
            checkpoint=env.get("HDFS_CHECKPOINT_PATH"),
        )


def answers(messages: DataFrame, factory: detect.ScorerFactory, threshold: float = 0.4,
            keep_frame: bool = False, frame_metadata: bool = False) -> DataFrame:
    """Frame messages (value, topic) to one detector answer per message.

    ``keep_frame`` keeps the image text, ``frame_metadata`` the message's own
    metadata as ``original_frame_metadata``.
    """
    parsed = parse.parse_frames(messages)
    columns = ["camera_id", "frame_id", "timestamp", "frame_data"]
    if frame_metadata:
        own = F.struct(F.col("payload_camera_id").alias("camId"), F.col("frame_id").alias("frameId"), "timestamp", "frame_shape", "encoding")
        parsed = parsed.withColumn("original_frame_metadata", own)
        columns.append("original_frame_metadata")
    return detect.detect(parsed.select(*columns), factory, confidence_threshold=threshold, keep_frame=keep_frame)


def published_detections(messages: DataFrame) -> DataFrame:
    """Detection messages (value, topic) as flat rows, one per frame."""
    rows = messages.select(
        F.col("value").cast("string").alias("detection_results"),
        text.camera_from_topic("topic", text.DETECTION_TOPIC).alias("topic_camera_id"),
    )
    parsed = rows.withColumn("detection_results", F.from_json("detection_results", schemas.DETECTION_ANSWER))
    flat = reshape.flatten_answers(parsed, keep=("topic_camera_id",))
    return flat.withColumn("camera_id", F.coalesce("camera_id", "topic_camera_id"))


def run(spark: SparkSession, factory: detect.ScorerFactory, mode: str, config: Config,
        **options) -> StreamingQuery:
    """Read the camera topics, detect, and write in the given output mode."""
    stream = topics.read_stream(spark, topics.frame_options(config.servers, config.topics))
    rows = answers(stream, factory, config.threshold, keep_frame=config.keep_frame, frame_metadata=mode == "kafka")
    if mode == "kafka":
        options = {"servers": config.servers, "checkpoint": config.checkpoint} | options
    elif mode != "console":
        options = {"path": config.path, "checkpoint": config.checkpoint} | options
    return sinks.start(rows, mode, **options)
