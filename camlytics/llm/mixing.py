"""Mixing sources to target weights by Sainte-Lague apportionment.

The wanted total is cut into blocks of equal words. Blocks are seats, sources
are parties: the highest quotients target / (2k - 1) win, so every source gets
a whole number of blocks, per shard of the mix too. Each source's documents
stand in a seeded order as one stream of words, cut into blocks; a source gets
each block as often as its quota goes round, and the rest of the quota picks
blocks at even distances from a seeded start.

A quota follows without dealing seat by seat: rounding target / d for a
divisor d a little too large gives at most S seats too few for S sources, and
only the next few quotients of each source compete for those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics.llm.common import WORD, packed, running, stored

# Weights of the sources in code point order, null last.
WEIGHTS = (5, 2, 1)
EPOCHS = 2
SHARE = 1.5
#: Blocks: at least SEATS in the whole mix, and FINE in the source with the smallest target, as far as it has that many words.
SEATS, FINE = 1_000_000, 100


def targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """Target words of each source.

    ``sizes`` has source and source_size. Sources share ``share`` of all words
    by weight; none gets more than twice its own words, and what is over is
    shared again by weight. One row per source, numbered ``_source`` from 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    numbered = sizes.select(
        "*", (F.row_number().over(by_name) - 1).alias("_source"), F.sum("source_size").over(Window.partitionBy()).alias("_words")
    ).withColumn("_weight", F.get(weights, F.col("_source") % len(WEIGHTS)).cast("double"))
    # In order of size per weight, the sources that reach their limit come first.
    fill = Window.orderBy(F.col("source_size") / F.col("_weight"), F.col("_source"))
    whole = Window.partitionBy()
    limit = F.col("source_size") * EPOCHS
    level = numbered.select(
        "*", limit.alias("_limit"),
        (share * F.col("_words")).alias("_budget"),
        F.coalesce(F.sum(limit).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_filled"),
        F.sum("_weight").over(fill.rowsBetween(0, Window.unboundedFollowing)).alias("_open"),
    ).withColumn("_full", F.col("_limit") * F.col("_open") <= F.col("_weight") * (F.col("_budget") - F.col("_filled")))
    rest = F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0)).over(whole)
    sharing = F.sum(F.when(~F.col("_full"), F.col("_weight")).otherwise(0.0)).over(whole)
    return level.withColumns({"_rest": rest, "_sharing": sharing}).select(
        *sizes.columns, "_source", "_budget",
        F.when(F.col("_full"), F.col("_limit").cast("double"))
        .otherwise(F.col("_weight") * (F.col("_budget") - F.col("_rest")) / F.col("_sharing")).alias("target"),
    )


def apportion(parties: DataFrame, group: list[str], target: Column, seats: Column, order: str) -> DataFrame:
    """Whole seats for each party of each group by highest quotients, ties to the lower ``order``.

    Adds ``_quota``; the quotas of a group sum to its seats when a target is positive.
    """
    all_of = Window.partitionBy(*group)
    based = parties.select("*", target.alias("_t"), seats.alias("_n")).select(
        "*", F.sum("_t").over(all_of).alias("_sum"), F.count(F.lit(1)).over(all_of).alias("_parties")
    )

    def rounded(n: Column) -> Column:
        return F.when(F.col("_sum") > 0, F.floor(F.col("_t") * n / F.col("_sum") + 0.5)).otherwise(0).cast("long")

    bounds = based.withColumns({
        "_low": rounded(F.greatest(F.col("_n") - F.col("_parties") / 2 - 1, F.lit(0.0))),
        "_high": rounded(F.col("_n") + F.col("_parties") / 2 + 1),
    })
    open_seats = F.col("_n") - F.sum("_low").over(all_of)
    claims = bounds.withColumn("_left", open_seats).where("_high > _low").select(
        *group, order, "_left", "_t", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")
    )
    best = Window.partitionBy(*group).orderBy((F.col("_t") / (2 * F.col("_k") - 1)).desc(), order)
    won = (
        claims.select("*", F.row_number().over(best).alias("_place")).where("_place <= _left")
        .groupBy(*group, order).agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        bounds.join(won, [*group, order], "left")
        .withColumn("_quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
        .drop("_t", "_n", "_sum", "_parties", "_low", "_high", "_won")
    )


def plan(sizes: DataFrame, seats: int | None, shards: int, share: float = SHARE, seed: int = 0) -> DataFrame:
    """One row per source: target, ``_block`` words per block, ``_quota`` blocks and their split over the shards.

    Without ``seats`` the block is small enough for the smallest source too.
    Seats of shard j are those between the j-th and the next cut of all seats.
    The method gives no party fewer seats when seats are added, so differences
    of the quotas at the cuts are each shard's quotas.
    """
    block = F.ceil(F.col("_budget") / (seats or SEATS))
    if seats is None:
        # One row per source.
        smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy())
        block = F.least(block, F.floor(smallest / FINE))
    base = targets(sizes, share).withColumn("_block", F.greatest(F.lit(1), block).cast("long"))
    cuts = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("_cut"))
    upto = F.expr(f"cast(round(_budget / _block) as long) * _cut div {shards}")
    dealt = apportion(cuts, ["_cut"], F.col("target"), upto, "_source")
    own = F.col("_quota") - F.coalesce(F.lag("_quota").over(Window.partitionBy("_source").orderBy("_cut")), F.lit(0))
    per_source = (
        dealt.withColumn("_own", own).groupBy("_source")
        .agg(
            F.max("_quota").alias("_quota"),
            F.transform(F.array_sort(F.collect_list(F.struct("_cut", "_own"))), lambda x: x["_own"]).alias("shard_blocks"),
        )
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("_block"))).cast("long")
    known = base.join(per_source, "_source").withColumn("_blocks", blocks)
    quota = F.least(F.col("_quota"), EPOCHS * F.col("_blocks"))
    return known.withColumn("_quota", quota).withColumns({
        "_rounds": F.expr("_quota div _blocks"),
        "_extra": F.expr("_quota % _blocks"),
        "_start": F.expr(f"pmod(_source * 7919L + {seed}, _blocks)"),
    }).drop("_budget")


def mix(docs: DataFrame, seats: int | None = None, shards: int = 8, share: float = SHARE, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, shard_blocks, text_hash for each row.

    ``taken`` is the number of the document's words that lie in chosen blocks,
    repeats counted; ``copies`` how often a mix of whole documents takes it,
    by the block of its middle word. The order inside a source is that of
    md5(seed:id:size), then id, size and text hash; rows equal in all of them may
    change places. A null text has size 0 and takes nothing; rows without a source
    form one. An empty table, or one without words, gives targets of 0. A block
    is a millionth of the mix, or a hundredth of the smallest target where that
    is less, and never under a word; a source may miss its target by two blocks.
    ``seats`` sets the number of blocks instead. Other columns are not read.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("size"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    ).withColumns({
        "_mix": F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size").cast("binary")),
        # Sorts as the source does, null last.
        "_key": F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))),
    })
    slim = stored(rows, "sizes")
    sizes = slim.groupBy("source", "_key").agg(F.sum("size").alias("source_size"))
    chosen = stored(plan(sizes, seats, shards, share, seed), "mix").drop("source")
    order = [F.col("_mix").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("text_hash").asc()]
    summed = running(slim, order, "size", "stream", key="_key").drop("_all")
    known = summed.join(chosen, "_key")

    def picked(k: str) -> str:
        """Chosen blocks among the first k."""
        return f"(({k} + _start) * _extra div _blocks - _start * _extra div _blocks)"

    def words_upto(x: str) -> str:
        k = f"({x} div _block)"
        return f"(_block * {picked(k)} + ({picked(f'({k} + 1)')} - {picked(k)}) * ({x} % _block))"

    middle = "((_before + size div 2) div _block)"
    return known.select(
        "doc_id", "source", "size", "source_size", "target",
        F.expr(f"size * _rounds + {words_upto('(_before + size)')} - {words_upto('_before')}").cast("long").alias("taken"),
        F.expr(f"_rounds + {picked(f'({middle} + 1)')} - {picked(middle)}").cast("int").alias("copies"),
        "shard_blocks", "text_hash",
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix in whole documents: each row as often as ``copies`` says, with the columns it came with.

    Rows equal in id, source and text share their copies, the first by the
    whole row's hash getting what is left over.
    """
    key = ["_id", "_name", "_hash"]
    copies = mix(docs, doc_id=doc_id, text=text, source=source, **options).groupBy(
        F.col("doc_id").alias("_kid"), F.col("source").alias("_kname"), F.col("text_hash").alias("_khash")
    ).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0")
    rows = docs.select(
        packed(docs).alias("row"), docs[doc_id].alias("_id"), docs[source].cast("string").alias("_name"), F.xxhash64(docs[text]).alias("_hash")
    )
    known = rows.join(
        copies,
        F.col("_id").eqNullSafe(F.col("_kid")) & F.col("_name").eqNullSafe(F.col("_kname")) & (F.col("_hash") == F.col("_khash")),
    )
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row"))) - 1
    several = known.where("_rows > 1").withColumn("_place", place)
    dealt = known.where("_rows = 1").withColumn("_place", F.lit(0)).unionByName(several)
    own = F.expr("_copies div _rows + if(_place < _copies % _rows, 1, 0)")
    # Each row as often as its copies; none for 0.
    return dealt.select("row", F.explode(F.array_repeat(F.lit(1), own.cast("int")))).select("row.*")


ORACLE = """
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size from documents),
s as (
  select source, cast(sum(size) as bigint) as n, row_number() over (order by source nulls last) - 1 as i from d group by source),
w as (
  select *, cast(case i % 3 when 0 then 5 when 1 then 2 else 1 end as double) as w,
    cast(1.5 as double) * cast(sum(n) over () as double) as m from s),
f as (
  select *, coalesce(cast(sum(2 * n) over (order by n / w, i rows between unbounded preceding and 1 preceding) as double), 0) as filled,
    sum(w) over (order by n / w, i rows between current row and unbounded following) as open_weight from w),
g as (select *, 2 * n * open_weight <= w * (m - filled) as is_full from f),
t as (
  select *, cast(sum(case when is_full then 2 * n else 0 end) over () as double) as rest,
    sum(case when is_full then 0 else w end) over () as sharing from g),
u as (
  select source, i, n, m, case when is_full then cast(2 * n as double) else w * (m - rest) / sharing end as target,
    cast(greatest(1, least(ceil(m / 1000000), floor(min(case when m > 0 then
      case when is_full then cast(2 * n as double) else w * (m - rest) / sharing end end) over () / 100))) as bigint) as b from t),
claims as (
  select i, m, b, target / (2 * k - 1) as quotient
  from (select *, unnest(range(1, cast(ceil(target / b) as bigint) + 2 + (select count(*) from s))) as k from u)),
ranked as (select i, row_number() over (order by quotient desc, i) <= round(m / b) as won from claims),
q as (select i, count(*) filter (won) as quota from ranked group by i),
p as (
  select source, n, target, b, least(quota, 2 * blocks) // blocks as rounds, least(quota, 2 * blocks) % blocks as extra,
    (i * 7919) % blocks as start, blocks
  from (select u.*, q.quota, cast(greatest(1, ceil(n / b)) as bigint) as blocks from u join q using (i))),
o as (
  select *, cast(coalesce(sum(size) over (partition by source
    order by md5('0:' || coalesce(cast(doc_id as varchar), '') || ':' || size), doc_id nulls first, size
    rows between unbounded preceding and 1 preceding), 0) as bigint) as x from d),
j as (
  select o.*, p.* exclude (source), x + o.size as y, (x + o.size // 2) // b as mid from o join p on o.source is not distinct from p.source),
c as (
  select *, (x // b + start) * extra // blocks - start * extra // blocks as x0, (x // b + 1 + start) * extra // blocks - start * extra // blocks as x1,
    (y // b + start) * extra // blocks - start * extra // blocks as y0, (y // b + 1 + start) * extra // blocks - start * extra // blocks as y1,
    (mid + start) * extra // blocks as m0, (mid + 1 + start) * extra // blocks as m1 from j)
select doc_id, size, n as source_size, target,
  cast(size * rounds + b * y0 + (y1 - y0) * (y % b) - b * x0 - (x1 - x0) * (x % b) as bigint) as taken,
  cast(rounds + m1 - m0 as integer) as copies
from c"""
