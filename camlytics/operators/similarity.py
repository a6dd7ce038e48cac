"""Nearest stored vectors by cosine similarity.

A bounded set of probes is broadcast and every task keeps its own best k per
probe, so only k rows per probe and task are shuffled. A larger set is met
block by block: blocks of probes and blocks of stored vectors are paired by a
shuffle, and each pair again gives only its best k. Both are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROBE_BYTES = 32 * 1024 * 1024
# Scores that a task works on at a time, and bytes of stored vectors in a block.
WORK = 1 << 20
STORED_BYTES = 64 * 1024 * 1024
DIGITS = 9


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns, 0 when one of them has no length."""
    def total(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.coalesce(
        F.try_divide(total(a, b), F.sqrt(total(a, a)) * F.sqrt(total(b, b))), F.lit(0.0)
    )


def centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector of each label."""
    known = vectors.where(F.col(vector).isNotNull())
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    means = known.groupBy(label).agg(Summarizer.mean(dense).alias("_m"))
    return means.select(label, vector_to_array("_m").alias(vector))


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


def _matrix(column, width: int) -> np.ndarray:
    """List vectors as rows; a missing vector counts as all zeros."""
    out = np.zeros((len(column), width))
    for at, vector in enumerate(column):
        if vector is not None:
            out[at, :] = vector
    return out


def _best(similarity: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``similarity`` the k highest, ties to the lower id."""
    order = np.lexsort((np.broadcast_to(ids, similarity.shape), -similarity), axis=1)[:, :k]
    return np.take_along_axis(similarity, order, 1), np.broadcast_to(ids, similarity.shape)[
        np.arange(len(similarity))[:, None], order
    ]


class _Keeper:
    """The best k of each probe over the batches seen so far."""

    def __init__(self, probes: np.ndarray, k: int):
        self.probes, self.k = probes, k
        self.similarity = np.empty((len(probes), 0))
        self.ids = np.empty((len(probes), 0), dtype=np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, min(2048, WORK // max(1, len(self.probes))))
        for at in range(0, len(ids), step):
            scores = np.round(self.probes @ _unit(vectors[at : at + step]).T, DIGITS)
            best, who = _best(scores, ids[at : at + step], self.k)
            similarity = np.concatenate([self.similarity, best], axis=1)
            known = np.concatenate([self.ids, who], axis=1)
            order = np.lexsort((known, -similarity), axis=1)[:, : self.k]
            self.similarity = np.take_along_axis(similarity, order, 1)
            self.ids = np.take_along_axis(known, order, 1)

    def rows(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.repeat(names, self.ids.shape[1]), self.ids.ravel(), self.similarity.ravel()


def top_k(probes: DataFrame, stored: DataFrame, k: int, *, probe_id: str = "probe_id",
          vec_id: str = "vec_id", vector: str = "embedding", min_similarity: float | None = None,
          probe_bytes: int = PROBE_BYTES, stored_bytes: int = STORED_BYTES) -> DataFrame:
    """The k most similar stored vectors of each probe, best first, ties to the lower id.

    Ids are whole numbers. Similarities are rounded to nine digits before they
    are ranked, so equal vectors tie in every plan. ``probe_bytes`` bounds what
    is broadcast, and a block of probes beyond it; ``stored_bytes`` bounds a
    block of stored vectors.
    """
    probes = probes.select(F.col(probe_id).cast("bigint").alias("probe_id"), F.col(vector).alias("v"))
    stored = stored.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("v"))
    count, width = probes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(width or 0, 0)
    if not count or not width:
        return _ranked(probes.sparkSession.createDataFrame([], "probe_id bigint, vec_id bigint, similarity double"), k)
    if count * width * 8 <= probe_bytes:
        found = _against_broadcast(probes, stored, k, width)
    else:
        found = _against_blocks(probes, stored, k, width, count, probe_bytes, stored_bytes)
    if min_similarity is not None:
        found = found.where(F.col("similarity") >= min_similarity)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("probe_id").orderBy(F.desc("similarity"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _against_broadcast(probes: DataFrame, stored: DataFrame, k: int, width: int) -> DataFrame:
    local = probes.toPandas()
    names = local["probe_id"].to_numpy(dtype=np.int64)
    shared = probes.sparkSession.sparkContext.broadcast(_unit(_matrix(local["v"], width)))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = _Keeper(shared.value, k)
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            keeper.add(ids, _arrow_matrix(batch.column("v"), width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in keeper.rows(names)], ["probe_id", "vec_id", "similarity"]
        )

    return stored.mapInArrow(best_of_task, "probe_id bigint, vec_id bigint, similarity double")


def _arrow_matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten()
    if column.null_count == 0 and flat.null_count == 0 and len(flat) == len(column) * width:
        return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    return _matrix(column.to_pylist(), width)


def _table_matrix(table: pa.Table, width: int) -> np.ndarray:
    parts = [_arrow_matrix(chunk, width) for chunk in table["v"].chunks]
    return np.concatenate(parts) if parts else np.zeros((0, width))


def _against_blocks(probes, stored, k, width, count, probe_bytes, stored_bytes):
    probe_blocks = math.ceil(count * width * 8 / probe_bytes)
    stored_blocks = max(1, math.ceil(stored.count() * width * 8 / stored_bytes))

    def block(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = probes.withColumn("pb", block("probe_id", probe_blocks)).withColumn("sb", every(stored_blocks))
    right = stored.withColumn("sb", block("vec_id", stored_blocks)).withColumn("pb", every(probe_blocks))

    def best_of_pair(p: pa.Table, s: pa.Table) -> pa.Table:
        keeper = _Keeper(_unit(_table_matrix(p, width)), k)
        if p.num_rows:
            keeper.add(s["vec_id"].to_numpy(), _table_matrix(s, width))
        found = keeper.rows(p["probe_id"].to_numpy())
        return pa.table(dict(zip(("probe_id", "vec_id", "similarity"), found)))

    return (
        left.groupBy("pb", "sb")
        .cogroup(right.groupBy("pb", "sb"))
        .applyInArrow(best_of_pair, "probe_id bigint, vec_id bigint, similarity double")
    )
