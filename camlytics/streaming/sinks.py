"""Starting the output streams.

Each function configures a writer for a streaming table of detector answers
(one row per frame, as ``operators.detect.detect`` returns it) and starts it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from camlytics.operators import messages, reshape
from camlytics.sinks.tables import PARTITIONS, gathered

# Fixed value: how often the table sinks write.
TABLE_TRIGGER = {"processingTime": "10 seconds"}


def _writer(rows: DataFrame, kind: str, checkpoint: str | None, trigger: dict | None) -> DataStreamWriter:
    writer = rows.writeStream.outputMode("append").format(kind)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def plain_rows(answers: DataFrame) -> DataFrame:
    """Camera, frame, time and detections."""
    return answers.select("camera_id", "frame_id", "timestamp", "detections")


def to_console(answers: DataFrame, *, trigger: dict | None = None) -> StreamingQuery:
    writer = _writer(plain_rows(answers), "console", None, trigger)
    return writer.option("truncate", False).option("numRows", 20).start()


def topic_rows(answers: DataFrame) -> DataFrame:
    """Topic, key and value of each answer, with the frame's own metadata where the answers carry it."""
    carried = "original_frame_metadata" if "original_frame_metadata" in answers.columns else None
    return messages.answer_messages(answers, frame_metadata=carried)


def to_topics(answers: DataFrame, *, servers: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = _writer(topic_rows(answers), "kafka", checkpoint, trigger)
    return writer.option("kafka.bootstrap.servers", servers).start()


def to_json_files(answers: DataFrame, *, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _writer(plain_rows(answers), "json", checkpoint, trigger).option("path", path).start()


def to_nested_table(answers: DataFrame, *, path: str, checkpoint: str, trigger: dict | None = TABLE_TRIGGER,
                    partition_time: str = "event") -> StreamingQuery:
    rows = gathered(reshape.nested_rows(answers, partition_time))
    return _writer(rows, "parquet", checkpoint, trigger).partitionBy(*PARTITIONS).option("path", path).start()


def to_flattened_table(answers: DataFrame, *, path: str, checkpoint: str, trigger: dict | None = TABLE_TRIGGER,
                       keep: tuple[str, ...] = ()) -> StreamingQuery:
    """As the nested table, one row per detection, under its own path and checkpoint."""
    rows = gathered(reshape.flattened_rows(answers, keep))
    writer = _writer(rows, "parquet", f"{checkpoint}_flattened", trigger)
    return writer.partitionBy(*PARTITIONS).option("path", f"{path}_flattened").start()


# Output mode names.
MODES: dict[str, Callable[..., StreamingQuery]] = {
    "console": to_console,
    "kafka": to_topics,
    "files": to_json_files,
    "hdfs": to_nested_table,
    "parquet": to_nested_table,
    "hdfs-flattened": to_flattened_table,
    "parquet-flattened": to_flattened_table,
}


def start(answers: DataFrame, mode: str = "console", **options) -> StreamingQuery:
    """Start the sink of an output mode; an unknown mode is an error."""
    if mode not in MODES:
        raise ValueError(f"unknown output mode {mode!r}, one of {sorted(MODES)}")
    return MODES[mode](answers, **options)


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; stop it on an interrupt."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def tracks_to(write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each batch of tracks in one go."""
    def each(batch: DataFrame, _number: int) -> None:
        write(batch)

    return each
