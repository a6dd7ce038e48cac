"""Shared helpers: stored tables, running sums in order, words of Arrow texts."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from camlytics.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from the files.

    Later plans read the same rows however often they run, also after the loss
    of an executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held.scratch = path
    return held


def dropped(*tables: DataFrame) -> None:
    """Remove the files of ``stored`` tables that nothing reads any more: what came of them is stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame) -> Column:
    """The whole row as one column, so that no name of its columns can clash."""
    return F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns])


def most_counted(counted: DataFrame, most: int, count: str = "n") -> DataFrame:
    """The rows with the highest counts, at most ``most``.

    A histogram over counts, 32 steps per doubling, gives the count to cut at;
    no task and not the driver holds more than its few rows. Rows of the step
    that would go beyond ``most`` are all left out.
    """
    step = F.floor(F.log2(count) * 32)
    held, edge = 0, None
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        held += row["count"]
        if held > most:
            break
        edge = row["step"]
    return counted.where(step >= edge if edge is not None else F.lit(False))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Jobs inside run with these settings of the session; those before come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def text_batches(spark: SparkSession, rows: int = 1000):
    """Jobs inside hand texts to Python in batches of at most ``rows``; the session's own limit comes back afterwards."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def long_rows(spark: SparkSession, rows: int):
    """Jobs inside hold at most ``rows`` long rows at a time where they read them or hand them to Python, and a page of about 1 MB where they write them.

    A writer otherwise looks at the size of its page after 100 rows only, and a reader unpacks a page as a whole.
    """
    return settings(spark, {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.parquet.columnarReaderBatchSize": str(rows),
        "parquet.page.size.row.check.min": "1",
    })


def worker_memory(name: str) -> dict:
    """What a Python worker keeps from task to task: the package travels with each task, so its own globals do not last."""
    module = sys.modules.setdefault("_worker_memory", types.ModuleType("_worker_memory"))
    return module.__dict__.setdefault(name, {})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % by


def running(df: DataFrame, order: list[Column], value: str, name: str, key: str | None = None) -> DataFrame:
    """Add ``_before`` (sum of ``value`` in earlier rows), ``_rank`` (their number) and ``_all`` (sum over all rows).

    ``df`` is dealt by ranges of (key, order) and stored with its partition
    number, so a key of any size lies in many partitions. A small table of
    totals per partition gives each its offset; only the rows of one partition
    are summed in one task. With ``key`` (never null) sums start anew per key.
    """
    ranges = [F.col(key).asc(), *order] if key else order
    parts = stored(
        df.repartitionByRange(partitions(df.sparkSession), *ranges).withColumn("_part", F.spark_partition_id()),
        name,
    )
    group = [key] if key else []
    totals = parts.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *group, "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(whole).alias("_all"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    summed = parts.select(
        "*",
        F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        (F.row_number().over(inside) - 1).alias("_rank"),
    )
    return (
        summed.join(offsets, [*group, "_part"])
        .withColumn("_before", F.col("_before") + F.col("_sum_before"))
        .withColumn("_rank", F.col("_rank") + F.col("_rows_before"))
        .drop("_sum_before", "_rows_before", "_part")
    )


# --- words of a column of texts, for functions over Arrow batches -------------

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
SPAN = 1 << 18


def _powers(base: int) -> np.ndarray:
    out = np.full(SPAN + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


POWER = _powers(BASE)
INVERSE = _powers(pow(BASE, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo, hi = (int(at[0]), int(at[-1])) if len(at) else (0, 0)
    return held[lo:hi], at - lo


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that follow each other."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(int(np.searchsorted(ends, base + SPAN, side="right")), at)
        if to == at:  # one span longer than the table of powers
            digest = hashlib.blake2b(data[base : int(ends[at])].tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(digest, "little")
            at += 1
            continue
        seg = data[base : int(ends[to - 1])].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum(seg * POWER[: len(seg)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * INVERSE[s]
        at = to
    return mix(out)


def words_of(column: pa.Array) -> Words:
    """Words (runs without ASCII white space) of each text, ASCII letters lower-cased."""
    data, at = text_bytes(column)
    data = TO_LOWER[data]
    inside = ~SPACE[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    edges = at[1:] - 1
    after[edges[edges >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, at)
    return Words(data, starts, ends, hash_spans(data, starts, ends), first)


def slices(column: pa.Array, size: int = 4 << 20) -> Iterator[pa.Array]:
    """Neighbouring rows of about ``size`` bytes together; a longer text stays whole, alone."""
    lengths = np.diff(text_bytes(column)[1])
    block = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(column)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield column.slice(lo, hi - lo)
