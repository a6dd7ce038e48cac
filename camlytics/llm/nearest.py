"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where the nearest by distance is the nearest
by cosine. Each of ``TABLES`` tables cuts ``HASHES`` Gaussian projections into
cells of ``WIDTH``. A query visits the cells around its own in the order of
their distance from its projections, which is the order of estimated success;
how many it visits is fitted once on a bounded sample. Candidates of all
tables are ranked by their exact cosine.

Rows lie in blocks of about ``BLOCK``: small buckets together, large ones cut
into pieces, so no bucket is too large for a task. A task gets one block and a
group of the queries that visit it, and returns only each query's best k.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics.llm.common import mix, stored

TABLES = 2
HASHES = 4
WIDTH = 1.5
#: Rows of a block, of a piece of a large bucket, queries of a group, and of a step inside a task.
BLOCK, PIECE, ASKED, STEP = 2048, 512, 4096, 256
#: Rows and queries of the sample that the number of visited cells is fitted on, and the share of neighbours wanted there.
SAMPLE, SAMPLE_QUERIES, WANTED = 2000, 300, 0.96
REACH = 3
_STEPS = np.stack(np.meshgrid(*[np.arange(-REACH, REACH + 1)] * HASHES, indexing="ij"), -1).reshape(-1, HASHES)


@lru_cache(maxsize=16)
def _projections(dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng((seed, dim))
    return draw.standard_normal((TABLES, dim, HASHES)), draw.uniform(0, WIDTH, (TABLES, 1, HASHES))


def _places(unit: np.ndarray, seed: int) -> np.ndarray:
    """Cell coordinates (table, row, hash) as real numbers."""
    a, b = _projections(unit.shape[1], seed)
    return (unit[None] @ a + b) / WIDTH


def _visits(at: np.ndarray, number: int) -> np.ndarray:
    """The ``number`` nearest cells of one query in one table, nearest first."""
    inside = at - np.floor(at)
    gap = np.maximum(0, np.maximum(_STEPS - inside, inside - _STEPS - 1))
    cost = (gap * gap).sum(1)
    order = np.argsort(cost, kind="stable")[:number]
    return np.floor(at).astype(np.int64) + _STEPS[order]


def _packed(cells: np.ndarray) -> np.ndarray:
    out = np.zeros(cells.shape[:-1], dtype=np.uint64)
    for j in range(cells.shape[-1]):
        out = mix(out + cells[..., j].astype(np.uint64) + np.uint64(j + 1))
    return out.astype(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def _buckets(vector: Column, cells: int, seed: int) -> Column:
    """array<struct(slot, bucket)>: the home cell in each table, or the ``cells`` nearest ones."""

    @F.arrow_udf("array<struct<slot: int, bucket: bigint>>")
    def hashed(vectors: pa.Array) -> pa.Array:
        slots, buckets, sizes = [], [], []
        for row in vectors:
            unit = _unit(np.array(row.as_py(), dtype=np.float64)[None])
            places = _places(unit, seed)[:, 0]
            for slot in range(TABLES):
                keys = _packed(_visits(places[slot], cells) if cells > 1 else np.floor(places[slot]).astype(np.int64)[None])
                slots.append(np.full(len(keys), slot, dtype=np.int32))
                buckets.append(keys)
            sizes.append(sum(len(k) for k in buckets[-TABLES:]))
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(slots) if slots else [], pa.int32()), pa.array(np.concatenate(buckets) if buckets else [], pa.int64())],
            names=["slot", "bucket"],
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)

    return hashed(vector)


def clean(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles), dim: one row per id, the smallest vector of an id that has several.

    Rows without id, and vectors that are null, empty, zero or hold a null or a
    number that is not finite, are left out.
    """
    v = F.col(vector).cast("array<double>")
    limit = F.lit(float("inf"))
    good = (
        F.col(vec_id).isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
        & F.exists(v, lambda x: x != 0)
    )
    kept = vectors.where(good).select(F.col(vec_id).alias("vec_id"), v.alias("vector"))
    return kept.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))


def fitted_cells(rows: DataFrame, k: int, seed: int = 0) -> int:
    """How many cells to visit, so that a sample of about SAMPLE rows finds the wanted share of its neighbours.

    Neighbours in the whole table are nearer than those in the sample and so
    are found more often.
    """
    total = rows.count()
    top = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if top is None:
        return 1
    draw = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30))
    chosen = rows.where((F.col("dim") == top["dim"]) & (draw < int(SAMPLE / total * (1 << 30)) + 1))
    found = chosen.select("vector").toPandas()["vector"]  # about SAMPLE rows
    if len(found) < 50:
        return len(_STEPS)
    unit = _unit(np.stack([np.asarray(x, dtype=np.float64) for x in found]))
    queries = unit[:SAMPLE_QUERIES]
    nearness = queries @ unit.T
    nearness[np.arange(len(queries)), np.arange(len(queries))] = -2
    best = np.argsort(-nearness, axis=1)[:, :k]
    places = _places(unit, seed)
    first = np.full(best.shape, len(_STEPS))
    for slot in range(TABLES):
        home = _packed(np.floor(places[slot]).astype(np.int64))
        for i in range(len(queries)):
            visited = {b: n for n, b in enumerate(_packed(_visits(places[slot, i], len(_STEPS))).tolist())}
            first[i] = np.minimum(first[i], [visited.get(b, len(_STEPS)) for b in home[best[i]].tolist()])
    return int(min(len(_STEPS), np.quantile(first, WANTED) + 1))


def _best(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of a block, among those in the buckets it visits, for each query; ties to the smaller id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if left.num_rows and right.num_rows:
        dim = left.column("dim")[0].as_py()
        ids = left.column("vec_id").to_numpy()
        buckets, bucket = np.unique(left.column("bucket").to_numpy(), return_inverse=True)
        held = _matrix(left.column("vector"), dim)
        norms = np.sqrt((held * held).sum(1))
        for at in range(0, right.num_rows, STEP):
            part = right.slice(at, STEP)
            asked, queries = part.column("query_id").to_numpy(), _matrix(part.column("vector"), dim)
            lengths = np.sqrt((queries * queries).sum(1))
            rough = (queries @ held.T) / lengths[:, None] / norms
            for i, visits in enumerate(part.column("visits")):
                there = np.isin(buckets, visits.values.to_numpy())[bucket] & (ids != asked[i])
                row = rough[i, there]
                # Everything level with the k-th, so that ties are settled by exact numbers.
                edge = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                near = np.flatnonzero(there)[row >= edge - 1e-9]
                score = (held[near] * queries[i]).sum(1) / (lengths[i] * norms[near])
                order = np.lexsort((ids[near], -score))[:k]
                out.append((np.full(len(order), asked[i]), ids[near][order], score[order]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
    return pa.table({
        "query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)),
        "score": pa.array(columns[2].astype(np.float64)),
    })


def _meet(index: DataFrame, queries: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Each query's best k per block of rows.

    ``index`` has vec_id, vector, dim, slot, bucket; ``queries`` query_id,
    vector, dim; ``visits`` query_id, dim, slot, bucket. Buckets, the large
    ones in pieces, are put together to blocks of about BLOCK rows.
    """
    key = ["dim", "slot", "bucket"]
    per_slot = Window.partitionBy("dim", "slot")
    buckets = index.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).select(
        *key, F.ceil(F.col("_n") / PIECE).cast("int").alias("pieces"),
        F.ceil(F.sum("_n").over(per_slot) / BLOCK).cast("int").alias("blocks"),
    )
    asked = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("groups"))

    def block(piece: Column) -> Column:
        return F.pmod(F.xxhash64("bucket", piece), F.col("blocks")).cast("int").alias("block")

    def group(column: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(2), column), F.col("groups")).cast("int").alias("group")

    own = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("pieces")).cast("int")
    left = index.join(buckets, key).join(asked, "dim").select(
        "dim", "slot", block(own), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
        "vec_id", F.col("vector").alias("vector"), "bucket",
    )
    met = visits.join(buckets, key).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    calls = met.select("query_id", "dim", "slot", "bucket", block(F.col("piece"))).groupBy("query_id", "dim", "slot", "block").agg(
        F.collect_set("bucket").alias("visits")  # at most the cells that a query visits
    )
    vectors = queries.select(F.col("query_id").alias("query_id"), F.col("vector").alias("vector"))
    right = calls.join(vectors, "query_id").join(asked, "dim").select(
        F.col("dim").alias("dim"), "slot", "block", group("query_id"), "query_id", "vector", "visits"
    )
    where = ["dim", "slot", "block", "group"]

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        return _best(a, b, k)

    return left.groupBy(*where).cogroup(right.groupBy(*where)).applyInArrow(best, "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, cells: int | None = None, seed: int = 0,
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query row, never the row itself.

    ``is_query`` is a condition on ``vec_id``. Only vectors of the query's
    length are candidates. A query whose cells hold fewer than k candidates is
    compared with all rows of its length, in blocks. Extra columns are not
    read; an empty table gives no rows.
    """
    rows = stored(clean(vectors, vec_id, vector), "vectors")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector", "dim")
    cells = cells or fitted_cells(rows, k, seed)

    def placed(df: DataFrame, number: int) -> DataFrame:
        hashed = df.withColumn("_at", _buckets(F.col("vector"), number, seed))
        return hashed.select(*df.columns, F.inline("_at"))

    found = stored(_meet(placed(rows, 1), queries, placed(queries, cells).drop("vector"), k), "nearest")
    sizes = rows.groupBy("dim").agg((F.count(F.lit(1)) - 1).alias("others"))
    counted = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
    short = stored(
        queries.join(sizes, "dim").join(counted, "query_id", "left")
        .where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.col("others"))).select("query_id", "vector", "dim"),
        "short",
    )
    if not short.isEmpty():
        alone = {"slot": F.lit(-1), "bucket": F.lit(0).cast("bigint")}
        found = found.unionByName(_meet(rows.withColumns(alone), short, short.drop("vector").withColumns(alone), k))
    return _ranked(found, k)
