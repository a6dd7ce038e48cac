"""Exact Jaccard join of word shingles by token-combination prefixes.

A text's tokens are the hashes of its distinct five-word shingles. Two sets of
similarity 0.75 or more differ in at most a quarter of each, so a prefix of a
quarter and one more, in an order that all sets share, must have a token in
common. Rare tokens come first in the order and are indexed one by one. Tokens
of a frequent class (all words among the corpus's commonest, or in more than
``HEAVY`` texts) say little alone: the prefix is extended and two of them, of
the same of several partitions, are indexed together. Losing every signature
takes one difference per rare token and, per partition, one less than its
tokens; the prefix is extended until that is more than a quarter.

Texts of one signature are first linked in a star around the smallest, which
joins almost every group at a cost linear in its size. Only members of different
components that still share a signature are then compared, so a large group of
near copies never becomes all its pairs. Every link is decided on the whole
sets; a parity bitmap spares most of the failing comparisons.

Equal texts are one node, named by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics.llm.common import WORD, Words, dropped, mix, most_counted, packed, partitions, slices, stored, text_batches, words_of
from camlytics.llm.links import components

SHINGLE = 5
#: A word is common from this share of all words on, so at most 100,000 words are; a token is heavy in more
#: texts than HEAVY, and at most HEAVY_TOKENS are. The executors get both sets.
COMMON_SHARE = 1e-5
HEAVY, HEAVY_TOKENS = 32, 1 << 18
#: Sets below SMALL are joined by plain prefixes, sets from LARGE on by classes; sizes between take part in both.
LARGE, SMALL = 32, 43
PARTITION_TOKENS = 8
#: Bits of the smallest parity bitmap; larger sets get at least a bit per token.
BITS = 1024
#: Members of a signature that one task compares with each other, about.
MEMBERS = 1024
#: Pairs that a task holds before it hands them on, and the part of the signatures that the second step looks at.
PAIRS, PART = 200_000, 4
#: Distinct words that a task holds before it hands their counts on.
WORDS = 500_000
_SINGLE, _SHORT = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_FIRST, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Known:
    """A sorted set of hashes with a quick test."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.quick = np.zeros(1 << 20, dtype=bool)
        self.quick[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def has(self, wanted: np.ndarray) -> np.ndarray:
        out = self.quick[(wanted >> np.uint64(44)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.searchsorted(self.hashes, wanted[maybe])
            out[maybe] = self.hashes[np.minimum(at, len(self.hashes) - 1)] == wanted[maybe]
        return out


def _shingles(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its sorted distinct tokens and the number of the word where each starts."""
    h = words.hashes
    every = np.zeros(max(0, len(h) - SHINGLE + 1), dtype=np.uint64)
    for j in range(SHINGLE):
        every = every * _STEP + h[j : len(h) - SHINGLE + 1 + j] if len(every) else every
    every = mix(every)
    for lo, hi in zip(words.first.tolist(), words.first[1:].tolist()):
        if hi - lo >= SHINGLE:
            tokens, at = np.unique(every[lo : hi - SHINGLE + 1], return_index=True)
            yield tokens, at + lo
        elif hi > lo:
            whole = np.zeros(1, dtype=np.uint64)
            for j in range(lo, hi):
                whole = whole * _STEP + h[j]
            yield mix(whole + np.uint64(hi - lo)), np.array([lo])
        else:
            yield np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)


def _frequent_by_words(words: Words, common: _Known) -> np.ndarray:
    """Whether the SHINGLE words from each place on are all common."""
    flag = common.has(words.hashes) if len(common.hashes) else np.zeros(len(words.hashes), dtype=bool)
    out = flag.copy()
    for j in range(1, SHINGLE):
        out[:-j] &= flag[j:]
    return out


def _partitions(n: int) -> list[int]:
    """Numbers of partitions for a set of n tokens: those of every size it can be similar to."""
    def of(m: int) -> int:
        return 1 << max(2, (max(m, 1) // PARTITION_TOKENS).bit_length() - 1)

    return sorted({of(-(-3 * n // 4)), of(n), of(4 * n // 3)})


def _pairs(prefix: np.ndarray, parts: int) -> np.ndarray:
    """Signatures of every two tokens of the prefix in the same partition."""
    kind = prefix & np.uint64(parts - 1)
    order = np.argsort(kind, kind="stable")
    kind, tokens = kind[order], prefix[order]
    out = []
    for d in range(1, len(tokens)):
        same = kind[d:] == kind[:-d]
        if not same.any():
            break
        out.append(mix(tokens[:-d][same] * _FIRST + tokens[d:][same] * _SECOND + np.uint64(parts)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _short(tokens: np.ndarray) -> np.ndarray:
    """Signatures of a small set: its prefix."""
    return mix(tokens[: len(tokens) // 4 + 1] + _SHORT)


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one token and of two tokens, for a set given as sorted tokens and their class."""
    n = len(tokens)
    lost = n // 4
    single, double = [], []
    if 0 < n < SMALL:
        single.append(_short(tokens))
    if n >= LARGE:
        rare = tokens[~frequent][: lost + 1]
        single.append(mix(rare + _SINGLE))
        wanted = lost + 1 - len(rare)
        if wanted > 0:
            rest = tokens[frequent]
            for parts in _partitions(n):
                # The first token of a partition can be lost for nothing, each further one counts.
                counts = np.ones(len(rest), dtype=np.int64)
                counts[np.unique(rest & np.uint64(parts - 1), return_index=True)[1]] = 0
                end = int(np.searchsorted(np.cumsum(counts), wanted)) + 1
                double.append(_pairs(rest[:end], parts))
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate(single) if single else none, np.concatenate(double) if double else none


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of which token hashes, modulo its size, come an odd number of times."""
    size = max(BITS, 1 << max(0, len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], pa.int64()))


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    words, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return words, np.bincount(inverse, weights=np.concatenate([f[1] for f in found]), minlength=len(words)).astype(np.int64)


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set sizes and bitmaps of the texts, and counts of the words of a task, at most about WORDS at a time."""
    none = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    found = [none]

    def counted(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        empty, nothing = pa.nulls(len(words), pa.int64()), pa.nulls(len(words), pa.list_(pa.int64()))
        return pa.record_batch({"doc_id": empty, "node": empty, "n": pa.array(n), "word": _signed(words), "bits": nothing})

    for batch in batches:
        sizes, bits = [], []
        for part in slices(batch.column(2)):
            words = words_of(part)
            for tokens, _ in _shingles(words):
                sizes.append(len(tokens))
                bits.append(_parity(tokens))
            found = [_merged([*found, np.unique(words.hashes, return_counts=True)])]
            if len(found[0][0]) > WORDS:
                yield counted(*found[0])
                found = [none]
        yield pa.record_batch({
            "doc_id": batch.column(0), "node": batch.column(1), "n": pa.array(sizes, pa.int64()),
            "word": pa.nulls(len(sizes), pa.int64()), "bits": _lists(bits),
        })
    yield counted(*found[0])


def _new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Words]]:
    """Nodes and words of the texts that the task has not met before: exact copies count once per task."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        fresh = [i for i, node in enumerate(nodes.tolist()) if node not in seen and not seen.add(node)]
        if fresh:
            fresh = pa.array(fresh, pa.int64())
            kept, at = batch.column(1).take(fresh), 0
            for part in slices(kept):
                yield nodes[fresh.to_numpy()[at : at + len(part)]], words_of(part)
                at += len(part)


def _prefix_tokens(common):
    """The tokens that would be indexed one by one if none were heavy, and the signatures of small sets."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _new_texts(batches):
            frequent, out = _frequent_by_words(words, common.value), [np.zeros(0, dtype=np.uint64)]
            for tokens, at in _shingles(words):
                if len(tokens) >= LARGE:
                    out.append(tokens[~frequent[at]][: len(tokens) // 4 + 1])
                if len(tokens) < SMALL:
                    out.append(_short(tokens))
            yield pa.record_batch({"token": _signed(np.concatenate(out))})

    return emit


def _indexed(common, heavy):
    """Signatures of every text; pairs of tokens and heavy signatures are salted by node, the others have salt 0."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, words in _new_texts(batches):
            frequent, found, owners, sizes, salts = _frequent_by_words(words, common.value), [], [], [], []
            for node, (tokens, at) in zip(nodes.tolist(), _shingles(words)):
                if not len(tokens):
                    continue
                kind = frequent[at]
                if len(heavy.value.hashes):
                    kind = kind | heavy.value.has(tokens)
                for sigs, salt in zip(signatures(tokens, kind), (0, 1 + node % 63)):
                    found.append(sigs)
                    owners.append(np.full(len(sigs), node, dtype=np.int64))
                    sizes.append(np.full(len(sigs), len(tokens), dtype=np.int32))
                    many = heavy.value.has(sigs) if len(heavy.value.hashes) else np.zeros(len(sigs), dtype=bool)
                    salts.append(np.where(many, 1 + node % 63, salt).astype(np.int32))
            if found:
                yield pa.record_batch({
                    "sig": _signed(np.concatenate(found)), "salt": pa.array(np.concatenate(salts)),
                    "node": pa.array(np.concatenate(owners)), "n": pa.array(np.concatenate(sizes)),
                })

    return emit


def _whole_sets(texts: pa.Array) -> pa.Array:
    """The tokens of each text."""
    return _lists([t.view(np.int64) for part in slices(texts) for t, _ in _shingles(words_of(part))])


def _hashes(rows: DataFrame, column: str) -> np.ndarray:
    return rows.select(column).toArrow()[column].to_numpy().astype(np.int64).view(np.uint64)


def _fits(a: str, b: str) -> Column:
    """Sizes that can be similar."""
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


_PLACE_BITS = 26


def _texts_of(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, body of the wanted nodes.

    A bitmap of fixed size (8 MB at most, a row per 32,768 places) over the
    wanted nodes' hashes keeps most other texts out of the shuffle; the join
    then decides.
    """
    place = F.pmod(F.col("node"), F.lit(1 << _PLACE_BITS))
    bitmap = wanted.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = base.select("node", "body", F.bitmap_bucket_number(place).alias("_bucket"), at.alias("_at")).join(
        F.broadcast(bitmap), "_bucket"
    ).where(F.getbit(byte, F.pmod(F.col("_at"), F.lit(8)).cast("int")) == 1)
    return marked.select("node", "body").distinct().join(wanted, "node", "left_semi")


def _distance(a: str, b: str) -> Column:
    """Bits in which two bitmaps differ; one of twice the size is folded, which keeps parity."""

    def folded(x: str, other: str) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        down = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(other), down).otherwise(F.col(x))

    apart = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda s, x: s + x)


def _near(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs (a, b) that their sizes and bitmaps do not rule out, with the bitmaps' ``distance``."""
    sized = pairs.select("a", "b").join(profiles.toDF("a", "na", "bits_a"), "a").join(profiles.toDF("b", "nb", "bits_b"), "b")
    total = F.col("na") + F.col("nb")
    most = total - 2 * F.ceil(3 * total / 7)
    measured = sized.where(_fits("na", "nb")).withColumn("distance", _distance("bits_a", "bits_b"))
    return measured.where(F.col("distance") <= most).select("a", "b", "distance")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components."""
    both = pairs.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _compared(block: pa.RecordBatch, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (outsider, member) of different roots that sizes and bitmaps allow: all, or each outsider's nearest."""
    role, node, root = (block.column(c).to_numpy() for c in ("role", "node", "root"))
    n = block.column("n").to_numpy().astype(np.int64)
    out, member = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
    lists = block.column("bits")
    words, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    width = np.diff(at)
    lo, hi = [], []
    for w in np.unique(width[out]):
        mine = out[width[out] == w]
        sets = []
        for v in np.unique(width[member]):
            if w // 2 <= v <= 2 * w:
                theirs = member[width[member] == v]
                sets.append((theirs, words[at[theirs][:, None] + np.arange(v)].view(np.uint64)))
        for start in range(0, len(mine), 64):
            part = mine[start : start + 64]
            own = words[at[part][:, None] + np.arange(w)].view(np.uint64)
            best, who = np.full(len(part), np.iinfo(np.int64).max), np.full(len(part), -1)
            for theirs, bits in sets:
                size = min(own.shape[1], bits.shape[1])
                apart = np.bitwise_count(_folded(own, size)[:, None] ^ _folded(bits, size)[None]).sum(2, dtype=np.int64)
                total = n[part][:, None] + n[theirs][None]
                fits = 4 * np.minimum(n[part][:, None], n[theirs][None]) >= 3 * np.maximum(n[part][:, None], n[theirs][None])
                fits &= (root[part][:, None] != root[theirs][None]) & (apart <= total - 2 * (-(-3 * total // 7)))
                if every:
                    i, j = np.nonzero(fits)
                    lo.append(node[part[i]])
                    hi.append(node[theirs[j]])
                    continue
                apart = np.where(fits, apart, np.iinfo(np.int64).max)
                j = apart.argmin(axis=1)
                closer = apart[np.arange(len(part)), j] < best
                best, who = np.where(closer, apart[np.arange(len(part)), j], best), np.where(closer, theirs[j], who)
            if not every:
                found = who >= 0
                lo.append(node[part[found]])
                hi.append(node[who[found]])
    if not lo:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = np.concatenate(lo), np.concatenate(hi)
    return np.minimum(a, b), np.maximum(a, b)


def _scanned(every: bool):
    """Compares the members of each block; the rows of a block follow each other. A task gives a pair once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        found = [np.zeros((0, 2), dtype=np.int64)]

        def compare(rows: pa.RecordBatch, edges: np.ndarray) -> None:
            found.extend(np.stack(_compared(rows.slice(lo, hi - lo), every), 1) for lo, hi in zip(edges, edges[1:]))
            found[:] = [np.unique(np.concatenate(found), axis=0)]

        def pairs() -> pa.RecordBatch:
            out = pa.record_batch({"a": pa.array(found[0][:, 0]), "b": pa.array(found[0][:, 1])})
            found[:] = [found[0][:0]]
            return out

        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            keys = [rows.column(c).to_numpy() for c in ("sig", "outside", "inside")]
            new = np.zeros(rows.num_rows, dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            edges = np.concatenate([[0], np.flatnonzero(new)])
            compare(rows, edges)
            held = rows.slice(int(edges[-1]))
            if len(found[0]) > PAIRS:
                yield pairs()
        if held is not None:
            compare(held, np.array([0, held.num_rows]))
        yield pairs()

    return emit


def _open(rows: DataFrame, roots: DataFrame, profiles: DataFrame, every: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a signature and may be similar.

    Every such pair has a member outside the signature's largest component, so
    only those meet the others: blocks of at most about MEMBERS outsiders with
    blocks of members. No pair becomes a row before its bitmaps have been compared.
    """
    placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("c"))
    split = sizes.groupBy("sig").agg(
        F.max_by("root", "c").alias("largest"), F.max("c").alias("top"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("roots")
    ).where("roots > 1").select(
        "sig", "largest", F.ceil((F.col("all") - F.col("top")) / MEMBERS).cast("int").alias("outsides"),
        F.ceil(F.col("all") / MEMBERS).cast("int").alias("insides"),
    )
    known = placed.join(split, "sig").join(profiles.select("node", "bits"), "node")

    def part(seed: int, number: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(number)).cast("int")

    def each(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    columns = ("node", "root", "n", "bits")
    outside = known.where("root <> largest").select(
        "sig", part(1, "outsides").alias("outside"), each("insides").alias("inside"), F.lit(1).alias("role"), *columns
    )
    inside = known.select("sig", each("outsides").alias("outside"), part(2, "insides").alias("inside"), F.lit(0).alias("role"), *columns)
    key = ["sig", "outside", "inside"]
    dealt = outside.unionByName(inside).repartition(partitions(rows.sparkSession), *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_scanned(every), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) of similarity 0.75 or more, decided on the whole sets; ``pairs`` and the result are stored tables."""
    wanted = stored(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "wanted")
    bodies = _texts_of(texts, wanted).select("node", "body")
    held = stored(bodies.select("node", F.arrow_udf(_whole_sets, "array<bigint>")("body").alias("tokens")), "sets")
    both = pairs.select("a", "b").join(held.toDF("a", "ta"), "a").join(held.toDF("b", "tb"), "b")
    same = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - same
    out = stored(both.where(100 * same >= 75 * union).select("a", "b"), name)
    dropped(pairs, wanted, held)
    return out


def link_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) per row, and (node, root) for the nodes that have links; both are written tables."""
    with text_batches(docs.sparkSession):
        return _link_table(docs, doc_id, text)


def _link_table(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), F.col(text).alias("body"))
    surveyed = stored(base.mapInArrow(_surveyed, "doc_id long, node long, n long, word long, bits array<bigint>"), "survey")
    profiles = stored(
        surveyed.where("word is null and n > 0").select("node", F.col("n").cast("int").alias("n"), "bits").dropDuplicates(["node"]), "profiles"
    )
    rows = stored(surveyed.where("word is null").select("doc_id", "node", "n"), "rows")
    found_words = surveyed.where("word is not null")
    total = found_words.agg(F.sum("n")).first()[0] or 0
    counted_words = found_words.groupBy("word").agg(F.sum("n").alias("n"))
    # At most 1 / COMMON_SHARE words can have that share.
    common = spark.sparkContext.broadcast(_Known(_hashes(counted_words.where(F.col("n") >= COMMON_SHARE * total), "word")))
    dropped(surveyed)
    texts = base.where(F.col("body").isNotNull()).select("node", "body")
    counted = texts.mapInArrow(_prefix_tokens(common), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    often = stored(counted.where(F.col("n") > HEAVY), "often")
    heavy = spark.sparkContext.broadcast(_Known(_hashes(most_counted(often, HEAVY_TOKENS), "token")))
    dropped(often)
    group = Window.partitionBy("sig", "salt")
    found = texts.mapInArrow(_indexed(common, heavy), "sig long, salt int, node long, n int")
    index = stored(
        found.select("*", F.min("node").over(group).alias("hub"), F.max("node").over(group).alias("last"))
        .where("hub <> last or salt > 0").dropDuplicates(["sig", "salt", "node"]).drop("last"),
        "signatures",
    )
    # Salted signatures: a mergeable minimum over the salts, then a join.
    two = index.where("salt > 0").select("sig", "node", "n")
    hubs = two.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").drop("last")
    shared = stored(index.where("salt = 0").select("sig", "node", "n", "hub").unionByName(two.join(hubs, "sig")), "shared")
    stars = stored(shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    dropped(index)
    # Links are sought in three steps, and each step leaves out what earlier ones have joined: of each node the
    # hub that looks nearest; of each node outside a signature's largest component the nearest other member, in one
    # of PART signatures, and the other hubs; at last, over all signatures, every pair of different components that
    # sizes and bitmaps allow.
    near = stored(_near(stars, profiles), "near")
    dropped(stars)
    likely = near.groupBy("b").agg(F.min_by("a", "distance").alias("a")).select("a", "b")
    links = _verified(stored(likely, "likely"), texts, "first")
    rest = shared.where("node <> hub").select("sig", "node", "n")
    roots = components(links)
    hubs_left = _apart(near.select("a", "b"), roots)
    nearest = _open(rest.where(F.pmod("sig", F.lit(PART)) == 0), roots, profiles, False).unionByName(hubs_left).distinct()
    nearest = stored(nearest, "nearest")
    dropped(near)
    links = links.unionByName(_verified(nearest, texts, "second"))
    roots = components(links)
    every = stored(_open(rest, roots, profiles, True).distinct(), "open")
    dropped(shared, profiles)
    links = links.unionByName(_verified(every, texts, "third"))
    return rows, components(links)


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row.

    Texts are linked when 100 * intersection >= 75 * union of their shingle
    sets; a text of fewer than five words has the whole sequence as its only
    shingle. A null text, or one without words, has size 0 and is linked with
    nothing. ``component_id`` is the smallest id reachable, equal texts
    included; ids that are null are left out of that, and a group of rows
    without ids has a null component. Repeated rows are kept, extra columns
    are not read, an empty table gives no rows.
    """
    rows, roots = link_table(docs, doc_id, text)
    placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = F.coalesce(F.col("n"), F.lit(0)) == 0
    return placed.withColumn("_root", F.when(~alone, F.col("root"))).join(
        named.withColumnRenamed("root", "_root"), "_root", "left"
    ).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of similar texts, with the columns it came with.

    The row with the smallest id stays; among rows without id, the text with
    the smallest hash. Rows without words all stay.
    """
    rows, roots = link_table(docs, doc_id, text)
    placed = rows.where("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    kept = placed.groupBy("root").agg(F.min(first).alias("_kept")).select(
        F.col("_kept.doc_id").alias("_id"), F.col("_kept.node").alias("_node")
    )
    whole = docs.select(
        packed(docs).alias("row"), docs[doc_id].cast("long").alias("_id"),
        F.xxhash64(docs[text]).alias("_node"),
        F.coalesce(docs[text].rlike(WORD), F.lit(False)).alias("_words"),
    )
    same = whole.where("_words").join(kept.toDF("_kid", "_knode"), (F.col("_node") == F.col("_knode")) & F.col("_id").eqNullSafe(F.col("_kid")))
    once = same.dropDuplicates(["_node", "_id"]).select("row.*")
    return once.unionByName(whole.where(~F.col("_words")).select("row.*"))


ORACLE = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) >= 5 then list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
tokens as (select doc_id, unnest(s) as t, len(s) as n from sets),
links as (
  select a.doc_id as a, b.doc_id as b from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached(doc_id, root) as (
  select doc_id, doc_id from sets union select l.b, r.root from reached r join links l on r.doc_id = l.a)
select doc_id, cast(len(any_value(s)) as bigint) as n_shingles, min(root) as component_id
from reached join sets using (doc_id) group by doc_id"""
