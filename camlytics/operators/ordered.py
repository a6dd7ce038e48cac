"""Running sums, ranks and first/last N that do not need one task per camera.

A plain window over one camera puts all of that camera's rows into one task.
Here the order is first cut into blocks of bounded size; rows are numbered
inside (key, block) groups, and the totals of the earlier blocks, one row per
group, are added afterwards. Results are those of the plain window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics.session import scratch_path

ROWS_PER_BLOCK = 1_000_000


@dataclass
class Blocked:
    """A DataFrame with a ``_block`` column and whether it has more than one block."""

    df: DataFrame
    many: bool


def in_blocks(df: DataFrame, order: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> Blocked:
    """Cut ``df`` along ``order`` into blocks of about ``rows_per_block`` rows.

    Spark deals the rows by ranges of all order columns, whatever their types,
    so outliers and heavy values of the first column do not unbalance the
    blocks. They are written once with their block's number: the ranges come
    from a sample, and totals and rows must see the same ones.
    """
    number = math.ceil(df.count() / rows_per_block)
    if number <= 1:
        return Blocked(df.withColumn("_block", F.lit(0)), False)
    spark = df.sparkSession
    ranges = [F.col(c).asc_nulls_first() for c in order]
    path = scratch_path(spark, "blocks")
    placed = df.repartitionByRange(number, *ranges).withColumn("_block", F.spark_partition_id())
    placed.write.parquet(path)
    return Blocked(spark.read.schema(placed.schema).parquet(path), True)


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column],
                 rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Sums from the first row of each key up to and including the current row."""
    return running_sums_by(df, {name: (keys, expr) for name, expr in sums.items()}, order, rows_per_block)


def running_sums_by(df: DataFrame, sums: dict[str, tuple[list[str], Column]], order: list[str],
                    rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Several running sums, each over its own keys, in one pass over the blocks.

    All windows are served by one shuffle on the keys they share plus the block.
    """
    keep = df.columns
    key_lists = [list(keys) for keys, _ in sums.values()]
    shared = [k for k in key_lists[0] if all(k in keys for keys in key_lists)]
    blocked = in_blocks(
        df.withColumns({f"_v_{name}": expr for name, (_, expr) in sums.items()}), order, rows_per_block
    )
    part = ["_block"] if blocked.many else []
    rows = blocked.df
    if shared or part:
        rows = rows.repartition(*[F.col(k) for k in [*shared, *part]])
    sort = [F.col(c).asc_nulls_first() for c in order]
    upto = {}
    for name, (keys, _) in sums.items():
        window = Window.partitionBy(*([*keys, *part] or [F.lit(0)])).orderBy(*sort)
        upto[name] = F.sum(f"_v_{name}").over(window.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns(upto)
    if not blocked.many:
        return rows.select(*keep, *sums.keys())

    for keys in {tuple(keys) for keys in key_lists}:
        names = [name for name, (other, _) in sums.items() if tuple(other) == keys]
        totals = blocked.df.groupBy(*keys, "_block").agg(
            *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in names]
        )
        earlier = Window.partitionBy(*(keys or (F.lit(0),))).orderBy("_block").rowsBetween(
            Window.unboundedPreceding, -1
        )
        before = totals.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col("_block").alias("_k_block"),
            *[F.sum(f"_t_{name}").over(earlier).alias(f"_o_{name}") for name in names],
        )
        match = F.col("_block") == F.col("_k_block")
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        rows = rows.join(before, match, "left").withColumns(
            {
                name: F.when(F.col(f"_o_{name}").isNull(), F.col(name))
                .when(F.col(name).isNull(), F.col(f"_o_{name}"))
                .otherwise(F.col(name) + F.col(f"_o_{name}"))
                for name in names
            }
        )
        rows = rows.drop(*[f"_k_{k}" for k in keys], "_k_block", *[f"_o_{n}" for n in names])
    return rows.select(*keep, *sums.keys())


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "n", start: int = 1,
             rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Position of each row within its key, counting from ``start``."""
    one = F.lit(1).cast("bigint")
    out = running_sums(df, keys, order, {name: one}, rows_per_block)
    return out.withColumn(name, F.col(name) - F.lit(1 - start)) if start != 1 else out


# Spark keeps only N rows per key before the shuffle up to this N.
_EARLY_LIMIT = 1000


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int,
            rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The first N rows of each key."""
    return _limited(df, keys, order, n, False, rows_per_block)


def last_n(df: DataFrame, keys: list[str], order: list[str], n: int,
           rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The last N rows of each key; older rows are the ones dropped."""
    return _limited(df, keys, order, n, True, rows_per_block)


def _limited(df, keys, order, n, newest, rows_per_block):
    if n <= _EARLY_LIMIT:
        sort = [F.col(c).desc_nulls_last() if newest else F.col(c).asc_nulls_first() for c in order]
        window = Window.partitionBy(*keys).orderBy(*sort)
        return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")
    counted = numbered(df, keys, order, "_rn", 1, rows_per_block)
    if not newest:
        return counted.where(F.col("_rn") <= n).drop("_rn")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_size")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (
        counted.join(sizes, match)
        .where(F.col("_rn") > F.col("_size") - n)
        .drop("_rn", "_size", *[f"_k_{k}" for k in keys])
    )


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None) -> DataFrame:
    """The newest row of each key.

    The highest value of the first order column is found by a hash aggregate of
    two numbers per key; only the rows that have it, mostly one per key, go
    through the aggregate that carries whole rows. A key whose order column is
    always NULL keeps its highest row by the other columns.
    """
    columns = columns or [c for c in df.columns if c not in keys]
    tops = df.groupBy(*keys).agg(F.max(order[0]).alias("_top")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_top"
    )
    match = F.col(order[0]).eqNullSafe(F.col("_top"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.join(tops, match, "left_semi").groupBy(*keys).agg(newest.alias("_r")).select(
        *keys, *[F.col("_r")[c].alias(c) for c in columns]
    )
