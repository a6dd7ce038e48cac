"""Contiguous shards of nearly equal bytes.

Rows are taken in id order. Byte totals per partition give each partition its
global offset, a row's own prefix sum follows inside the partition, and the
shards are cut at equal targets of the global sum: a row goes to the shard
that holds the middle of its bytes. Every shard is within one row of the
target at each end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from camlytics.llm.common import running

LAW = "bytes"


def assign(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row.

    ``size`` is the text's UTF-8 bytes plus 1, ``slot`` the place in the shard
    from 0. A null text has size 1 and the checksum of the empty text. Rows
    without an id come first; rows with equal ids are ordered by size and
    checksum, and rows equal in all three may change places. An empty table
    gives no rows. Other columns are not read. ``grown_shard`` is null: cutting
    anew for one more shard moves rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(1).cast("long")).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("text_crc32").asc()]
    summed = running(rows, order, "size", "shards")
    middle = F.expr(f"least({shards - 1}, (2 * _before + size) * {shards} div (2 * _all))")
    placed = summed.withColumn("shard", middle.cast("int"))
    starts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    # One row per shard.
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write(docs: DataFrame, path: str, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` to one folder per shard, rows in slot order inside each file.

    Needs ids that name a row; repeated ids with equal texts go together.
    """
    places = assign(docs, shards, doc_id, text).groupBy("doc_id", "text_crc32").agg(
        F.min("shard").alias("_shard"), F.min("slot").alias("_slot")
    )
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    joined = docs.join(
        places, docs[doc_id].eqNullSafe(places["doc_id"]) & (crc == places["text_crc32"])
    ).select(*[docs[c] for c in docs.columns], "_shard", "_slot")
    ranged = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    ranged.drop("_slot").withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)


def skew(placed: DataFrame) -> DataFrame:
    """Rows and bytes of each shard, with the share of all bytes."""
    totals = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    return totals.withColumn("share", F.col("bytes") / F.sum("bytes").over(Window.partitionBy()))
