"""Applying a caller's detector or scorer to frames, as Arrow batches.

The model is the caller's: a factory that is called once per Python worker task
and returns a function over a pandas batch. Images are decoded to bytes and
answers are shaped by the JVM; Python only sees what the model needs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics import schemas
from camlytics.functions import boxes, text
from camlytics.operators import messages

Scorer = Callable[[pd.DataFrame], Sequence]
ScorerFactory = Callable[[], Scorer]

RAW_DETECTION = (
    "struct<class_id int, class_name string, confidence double, "
    "x1 double, y1 double, x2 double, y2 double>"
)


def score_batches(factory: ScorerFactory, inputs: dict[str, Column], result: str, *,
                  required: str, batch_rows: int = 32) -> Column:
    """A struct of ``result``, ``error`` and ``processing_time_ms`` for each row.

    The scorer gets batches with the ``inputs`` columns and answers one item per
    row. Rows whose ``required`` input is NULL are not scored and get an empty
    answer.
    """
    names = list(inputs)
    schema = f"result {result}, error string, processing_time_ms double"

    @F.pandas_udf(schema)
    def apply(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for series in batches:
            rows = pd.DataFrame(dict(zip(names, series)))
            yield _scored(scorer, rows, rows[required].notna().to_numpy().nonzero()[0], batch_rows)

    # Keeps the optimizer from scoring a row again in a filter on the answer.
    # Filters on other columns belong before the scoring.
    return apply.asNondeterministic()(*inputs.values())


def _scored(scorer: Scorer, rows: pd.DataFrame, todo, batch_rows: int) -> pd.DataFrame:
    """Answers for the rows at the positions ``todo``, NULLs for the others."""
    result, error, spent = ([None] * len(rows) for _ in range(3))
    for at in range(0, len(todo), batch_rows):
        part = todo[at : at + batch_rows]
        started = time.perf_counter()
        for position, answer, problem in _attempt(scorer, rows, part):
            result[position], error[position] = answer, problem
        each = (time.perf_counter() - started) * 1000 / len(part)
        for position in part:
            spent[position] = each
    return pd.DataFrame({"result": result, "error": error, "processing_time_ms": spent})


def _attempt(scorer: Scorer, rows: pd.DataFrame, part) -> Iterator[tuple]:
    """Position, answer and error of each row; a failing batch is halved until
    the error stays with the row that caused it."""
    try:
        answers = list(scorer(rows.iloc[part]))
        if len(answers) != len(part):
            raise ValueError(f"scorer gave {len(answers)} answers for {len(part)} rows")
    except Exception as problem:
        if len(part) == 1:
            yield part[0], None, str(problem)
            return
        middle = len(part) // 2
        yield from _attempt(scorer, rows, part[:middle])
        yield from _attempt(scorer, rows, part[middle:])
        return
    yield from ((position, answer, None) for position, answer in zip(part, answers))


def detect(frames: DataFrame, factory: ScorerFactory, *, confidence_threshold: float = 0.4,
           nms_threshold: float = 0.4, processing_engine: str = schemas.ENGINE,
           batch_rows: int = 32, keep_frame: bool = False) -> DataFrame:
    """Detections of each frame as typed columns.

    Wants camera_id, frame_id, timestamp and frame_data (base64 text). A frame
    without an image gets zero detections without calling the detector; an
    image that cannot be decoded, or on which the detector fails, gets a row
    with ``error``. Detections are kept when strictly above the threshold. The
    image itself is dropped unless ``keep_frame``.
    """
    given = F.coalesce(F.col("frame_data"), F.lit("")) != ""
    image = F.when(given, text.decode_base64("frame_data"))
    answer = score_batches(
        factory,
        {
            "image": F.col("_image"),
            "camera_id": F.col("camera_id"),
            "frame_id": F.col("frame_id"),
            "timestamp": F.col("timestamp"),
        },
        f"array<{RAW_DETECTION}>",
        required="image",
        batch_rows=batch_rows,
    )
    scored = (
        frames.withColumn("_image", image)
        .withColumn("_given", given)
        .withColumn("_answer", answer)
        .withColumn("_undecoded", F.col("_given") & F.col("_image").isNull())
        .drop("_image")
    )
    error = F.when(F.col("_undecoded"), F.lit("Failed to decode image")).otherwise(
        F.col("_answer.error")
    )
    raw = F.coalesce(F.col("_answer.result"), F.array())
    records = F.transform(
        F.filter(raw, lambda d: boxes.above(d["confidence"], confidence_threshold)),
        lambda d: F.struct(
            d["class_id"].alias("class_id"),
            d["class_name"].alias("class_name"),
            boxes.round_confidence(d["confidence"]).alias("confidence"),
            boxes.corner_box(d["x1"], d["y1"], d["x2"], d["y2"]).alias("bbox"),
        ),
    )
    shaped = scored.withColumns({"error": error, "detections": records})
    ok = F.col("error").isNull()
    keep = [c for c in frames.columns if keep_frame or c != "frame_data"]
    return shaped.select(
        *keep,
        F.when(ok & F.col("_given"), F.col("timestamp")).alias("detection_timestamp"),
        F.size("detections").alias("total_detections"),
        messages.classes_in_order().alias("detection_classes"),
        F.to_json(messages.class_counts()).alias("class_counts"),
        F.when(ok, F.lit(float(confidence_threshold))).alias("confidence_threshold"),
        F.when(ok, F.lit(float(nms_threshold))).alias("nms_threshold"),
        F.lit(processing_engine).alias("processing_engine"),
        "error",
        "detections",
        F.col("_answer.processing_time_ms").alias("processing_time_ms"),
    )


def score(frames: DataFrame, factory: ScorerFactory, *, batch_rows: int = 32) -> DataFrame:
    """Service-style scoring: one result row per frame, or an error row.

    The scorer gets frame_data, frame_id, timestamp, camera_id and answers dicts
    with the fields of ``schemas.SCORING_RESULT``.
    """
    answer = score_batches(
        factory,
        {c: F.col(c) for c in ("frame_data", "frame_id", "timestamp", "camera_id")},
        f"struct<{schemas.SCORING_RESULT}>",
        required="frame_data",
        batch_rows=batch_rows,
    )
    scored = frames.withColumn("_answer", answer)
    r = F.col("_answer.result")
    unscored = F.when(r.isNull(), F.lit("no frame data"))
    return scored.select(
        "camera_id",
        "frame_id",
        "timestamp",
        F.coalesce(r["processing_time_ms"], F.col("_answer.processing_time_ms")).alias("processing_time_ms"),
        r["detections_count"].alias("detections_count"),
        r["tracks_count"].alias("tracks_count"),
        r["tracks"].alias("tracks"),
        F.coalesce(F.col("_answer.error"), unscored).alias("error"),
    )


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that went well, and rows with an error."""
    return df.where(F.col(error).isNull()), df.where(F.col(error).isNotNull())
