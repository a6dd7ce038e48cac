"""Token ids of all texts in one file format, compressed by grammars.

The ids of all documents, in the order of their numbers, are one sequence; each
document ends with ``END``. The sequence is cut into blocks of ``BLOCK`` ids,
wherever documents end. Each block is compressed on its own by Re-Pair: pairs
of neighbours that occur often become new symbols, again and again, until no
pair occurs often. A block holds the rules, the number of ids that each rule
stands for and the remaining symbols, so any stretch of ids is read by
expanding the few symbols that cover it.

Layout of a block's payload, little-endian: ``RPG1``, then as unsigned 32-bit
numbers the first rule's symbol, the number of rules and of symbols, and the
bytes of a symbol (2 or 4); then the rules' left sides, right sides and lengths
(32 bits each), then the symbols. A file's row is one block with its place and
the documents it holds; a second table tells where each part of the files
begins. Both are Parquet, so that Spark writes, retries and lists them.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.llm.common import SPACE, TO_LOWER, hash_spans, partitions, slices, text_bytes
from camlytics.session import scratch_path

END = 1
BLOCK = 1 << 20
#: A pair must occur, and be replaced, so often; a rule takes the room of four symbols.
LEAST = 8
MAGIC = b"RPG1"
_HEADER = "<4sIIII"


# --- ids of texts --------------------------------------------------------------

BATCH_BYTES = 8 << 20
KNOWN = 2_000_000
LINE = 512

# Fixed value: how the published file word_bpe_49k.json cuts lower-cased text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTER, _DIGIT, _SIGN, _OTHER = range(1, 5)
#: Kinds of bytes. Of letters beyond ASCII only the ones from U+00C0 to U+00FF are cut here; "<" may begin a special string.
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("a") : ord("z") + 1] = _KIND[ord("A") : ord("Z") + 1] = _LETTER
_KIND[ord("<")] = _OTHER
_KIND[SPACE] = 0


def _worker() -> dict:
    """What a Python worker remembers from task to task: the package travels with each task, so its own globals do not last."""
    module = sys.modules.setdefault("_worker_memory", types.ModuleType("_worker_memory"))
    return module.__dict__.setdefault("encoders", {})


def _prepared(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with lower-case letters, and the kind of each."""
    lower, kind = TO_LOWER[data], _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)
    lead, second = lead[letter], second[letter]
    kind[lead] = kind[lead + 1] = _LETTER
    upper = second <= 0x9E
    lower[lead[upper] + 1] += 0x20
    return lower, kind


def _pieces_of(kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs without white space start and end; ``at`` are the ends of texts."""
    inside = kind != 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    starts, ends = at[:-1][np.diff(at) > 0], at[1:][np.diff(at) > 0] - 1
    begins[starts] = inside[starts]
    stops[ends] = inside[ends]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _units(data: np.ndarray, at: np.ndarray, alike: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, where the units in them start and end, and which of them are one word to the library.

    A unit is a run of letters, a digit, a run of signs or one of the endings
    that ``SPLIT`` names; a piece with any other character is one unit, as is
    every piece where the file does not cut ``alike``.
    """
    lower, kind = _prepared(data)
    begins, stops = _pieces_of(kind, at)
    if not len(begins):
        return data, begins, stops, np.zeros(0, dtype=bool)
    whole = np.unique(np.searchsorted(begins, np.flatnonzero(kind == _OTHER), side="right") - 1) if alike else np.arange(len(begins))
    raw = np.zeros(len(data), dtype=bool)
    sizes = stops[whole] - begins[whole]
    raw[np.repeat(begins[whole] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = True
    first = (kind != 0) & ~raw
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    first[begins] = True
    starts = np.flatnonzero(first)
    ends = np.minimum(np.append(starts[1:], len(data)), stops[np.searchsorted(begins, starts, side="right") - 1])
    # A lone apostrophe takes the ending that follows it.
    mark = np.flatnonzero((data[starts] == ord("'")) & (ends - starts == 1) & ~raw[starts])
    mark = mark[mark + 1 < len(starts)]
    mark = mark[(starts[mark + 1] == ends[mark]) & (kind[ends[mark]] == _LETTER)]
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[begins] = True
    mark = mark[~opens[ends[mark]]]
    one = lower[ends[mark]]
    two = np.where(ends[mark + 1] - starts[mark + 1] > 1, lower[np.minimum(ends[mark] + 1, len(data) - 1)], 0)
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    single = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
    taken = np.where(single, 1, np.where(pair, 2, 0))
    ends[mark] += taken
    starts[mark + 1] += taken
    left = starts < ends
    starts = starts[left]
    return np.where(raw, data, lower), starts, ends[left], ~raw[starts]


class _Encoder:
    """Ids of units of text, remembered by one Python worker under 64-bit hashes.

    No token of this kind of tokenizer, no normalisation and no special string
    reaches across white space. Where the file cuts as ``SPLIT`` says, most
    pieces are cut further here, into units, of which there are far fewer. What
    is new goes through the library many units at a time: single words parted
    by spaces, since the last id of a word tells that it is the last, others by
    a special string, at which the library cuts texts before all else; units
    that hold a special string themselves go one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        special = sorted(self.library.get_added_tokens_decoder().items())
        self.strings = [t.content for _, t in special]
        cuts = [(i, t.content) for i, t in special if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.cut = cuts[0] if cuts else None
        said = json.loads(self.library.to_str())
        steps = (said["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        lowers = {"type": "Lowercase"} in (said["normalizer"] or {}).get("normalizers", [])
        suffix = said["model"].get("end_of_word_suffix")
        self.alike = lowers and steps[0].get("pattern") == {"Regex": SPLIT} and bool(suffix)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)  # sorted, with the slot of each
        self.slots = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _through(self, lines: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(lines, add_special_tokens=False)]

    def _lines(self, strings: list[str], between: str) -> list[np.ndarray]:
        return self._through([between.join(strings[at : at + LINE]) for at in range(0, len(strings), LINE)])

    def _encoded(self, strings: list[str], kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings end to end, and how many each has: strings of one word, of several, or with special strings."""
        if kind == "word":
            ids = np.concatenate(self._lines(strings, " "))
            return ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        if kind == "special" or self.cut is None:
            found = self._through(strings)
            return np.concatenate(found), np.array([len(ids) for ids in found], dtype=np.int64)
        mark, between = self.cut
        found = self._lines(strings, between)
        counts = [np.diff(np.concatenate([[-1], np.flatnonzero(ids == mark), [len(ids)]])) - 1 for ids in found]
        ids = np.concatenate(found)
        return ids[ids != mark], np.concatenate(counts)

    def _learn(self, hashes: np.ndarray, strings: list[str], word: np.ndarray) -> None:
        """Remember new units; their hashes are sorted."""
        special = np.array(["<" in s and any(t in s for t in self.strings) for s in strings], dtype=bool)
        slots = np.empty(len(strings), dtype=np.int64)
        for kind, some in (("word", word), ("special", special), ("several", ~word & ~special)):
            some = np.flatnonzero(some)
            if len(some):
                ids, counts = self._encoded([strings[k] for k in some], kind)
                slots[some] = len(self.ends) - 1 + np.arange(len(some))
                self.ids = np.concatenate([self.ids, ids])
                self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that end at ``at``, end to end, and where each text's ids end."""
        if len(self.hashes) > KNOWN:
            self.forget()
        text, starts, ends, word = _units(data, at, self.alike)
        hashes, first, inverse = np.unique(hash_spans(text, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != hashes[inside]
        if new.any():
            held = text.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(hashes[new], [held[a:b].decode() for a, b in spans], word[first[new]])
            place = np.searchsorted(self.hashes, hashes)
        slots = self.slots[place][inverse]
        begin = self.ends[slots]
        sizes = self.ends[slots + 1] - begin
        upto = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(begin - upto[:-1], sizes)
        places += np.arange(len(places))
        return self.ids[places], upto[np.searchsorted(starts, at[1:])]


def encode(texts: pa.Array, path: str, end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each followed by ``end`` if given, and where each text ends; null counts as empty.

    ``path`` names a tokenizer that drops white space. Units are told apart by
    64-bit hashes: among the units of a worker, at most two million and a
    batch's, two would share one by chance once in ten million workers.
    """
    encoders = _worker()
    if path not in encoders:
        encoders[path] = _Encoder(path)
    ids, ends = encoders[path].encode(*text_bytes(texts))
    if end is None:
        return ids, ends
    return np.insert(ids, ends, end), ends + np.arange(1, len(ends) + 1)


# --- grammars --------------------------------------------------------------------


class Grammar(NamedTuple):
    base: int  # symbols from here on are rules
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # ids that each rule stands for
    symbols: np.ndarray


def _chosen(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the frequent pairs, at places ``at`` in order, are replaced: no two of these touch.

    Of touching pairs the one of better rank goes first; in a row of equal
    pairs, as within ``aaaa``, every second one.
    """
    none = np.iinfo(rank.dtype).max
    touch = at[1:] == at[:-1] + 1
    before, after = np.append(none, np.where(touch, rank[:-1], none)), np.append(np.where(touch, rank[1:], none), none)
    begins = before != rank
    number = np.arange(len(at))
    first = np.maximum.accumulate(np.where(begins, number, 0))
    return ((number - first) % 2 == 0) & (~begins | (rank < before)) & ((after == rank) | (rank < after))


def _frequent(symbols: np.ndarray, open_at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The frequent pairs by falling count, then by symbols; their places in order, and the rank of the pair at each.

    Only pairs at the open places are counted. Pair and place share one word,
    so that one sort brings equal pairs and their places together.
    """
    bits = max(int(symbols.max()).bit_length(), 1)
    places = max(len(symbols).bit_length(), 1)
    if 2 * bits + places > 64:
        raise ValueError("too many symbols for one block")
    shift = np.uint64(places)
    packed = (symbols[open_at].astype(np.uint64) << np.uint64(bits) | symbols[open_at + 1]) << shift | open_at.astype(np.uint64)
    packed.sort()
    pairs = packed >> shift
    edges = np.flatnonzero(pairs[1:] != pairs[:-1]) + 1
    edges = np.concatenate([[0], edges, [len(pairs)]])
    counts = np.diff(edges)
    often = np.flatnonzero(counts >= least)
    order = often[np.argsort(-counts[often], kind="stable")]
    rank_of = np.empty(len(edges), dtype=np.int32)
    rank_of[order] = np.arange(len(order), dtype=np.int32)
    held = np.repeat(counts >= least, counts)
    at = (packed[held] & np.uint64((1 << places) - 1)).astype(np.int64)
    rank = np.full(len(symbols), -1, dtype=np.int32)
    rank[at] = np.repeat(rank_of[often], counts[often])
    at = np.flatnonzero(rank >= 0)
    keys = pairs[edges[order]]
    return np.stack([keys >> np.uint64(bits), keys & np.uint64((1 << bits) - 1)]).astype(np.int64), at, rank[at]


def compress(ids: np.ndarray, least: int = LEAST) -> Grammar:
    """Re-Pair: in each round the frequent pairs, most frequent first, become symbols wherever they do not touch.

    A pair that is not frequent never becomes so, since only pairs with new
    symbols are made: later rounds count only pairs that were frequent or that
    hold a new symbol. Equal ids give equal grammars.
    """
    symbols = ids.astype(np.uint32)
    base = int(symbols.max(initial=0)) + 1
    left, right, lengths = [], [], np.zeros(0, dtype=np.int64)
    open_at = np.arange(len(symbols) - 1)
    made = 0
    while len(open_at):
        rules, at, rank = _frequent(symbols, open_at, least)
        if not len(at):
            break
        chosen = _chosen(at, rank)
        kept = np.bincount(rank[chosen], minlength=rules.shape[1]) >= least
        chosen &= kept[rank]
        if not chosen.any():
            break
        rules = rules[:, kept]
        sizes = np.ones(rules.shape, dtype=np.int64)
        sizes[rules >= base] = lengths[rules[rules >= base] - base]
        left.append(rules[0])
        right.append(rules[1])
        lengths = np.concatenate([lengths, sizes.sum(axis=0)])
        made_at = at[chosen]
        symbols[made_at] = (base + made + np.cumsum(kept) - 1)[rank[chosen]]
        is_open = np.zeros(len(symbols), dtype=bool)
        is_open[at] = True
        is_open[made_at[made_at > 0] - 1] = True
        stays = np.ones(len(symbols), dtype=bool)
        stays[made_at + 1] = False
        symbols, is_open = symbols[stays], is_open[stays]
        open_at = np.flatnonzero(is_open[:-1])
        made += rules.shape[1]
    empty = np.zeros(0, dtype=np.int64)
    return Grammar(
        base, *[np.concatenate(x or [empty]).astype(np.uint32) for x in (left, right)],
        lengths.astype(np.uint32), symbols.astype(np.uint32),
    )


def _expanded(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids of some symbols; each step opens all rules there are, and rules are a few tens deep."""
    while True:
        rule = symbols >= grammar.base
        if not rule.any():
            return symbols
        first = np.cumsum(1 + rule) - 1 - rule
        out = np.repeat(symbols, 1 + rule)
        opened = symbols[rule] - np.uint32(grammar.base)
        out[first[rule]] = grammar.left[opened]
        out[first[rule] + 1] = grammar.right[opened]
        symbols = out


def decompress(grammar: Grammar, low: int = 0, high: int | None = None) -> np.ndarray:
    """The ids from place ``low`` up to ``high``, expanding only the symbols that cover them."""
    sizes = np.concatenate([np.ones(grammar.base, dtype=np.int64), grammar.lengths])[grammar.symbols]
    ends = np.cumsum(sizes)
    high = int(ends[-1]) if high is None and len(ends) else high or 0
    if high <= low:
        return np.zeros(0, dtype=np.uint32)
    first, last = int(np.searchsorted(ends, low, side="right")), int(np.searchsorted(ends, high)) + 1
    skipped = low - (int(ends[first]) - int(sizes[first]))
    if 2 * (last - first) > len(ends):
        # Most of the block: open each rule once and copy what it stands for.
        ids = np.concatenate([np.arange(grammar.base, dtype=np.uint32), _expanded(grammar, np.arange(len(grammar.left), dtype=np.uint32) + np.uint32(grammar.base))])
        begin = np.concatenate([np.arange(grammar.base), grammar.base + np.cumsum(grammar.lengths, dtype=np.int64) - grammar.lengths])
        places = np.repeat(begin[grammar.symbols[first:last]] - (ends[first:last] - sizes[first:last]), sizes[first:last])
        places += np.arange(len(places)) + int(ends[first] - sizes[first])
        return ids[places][skipped : skipped + high - low]
    return _expanded(grammar, grammar.symbols[first:last])[skipped : skipped + high - low]


def pack(grammar: Grammar) -> bytes:
    width = 2 if grammar.base + len(grammar.left) <= 1 << 16 else 4
    kind = f"<u{width}"
    return b"".join([
        struct.pack(_HEADER, MAGIC, grammar.base, len(grammar.left), len(grammar.symbols), width),
        grammar.left.astype(kind).tobytes(), grammar.right.astype(kind).tobytes(),
        grammar.lengths.astype("<u4").tobytes(), grammar.symbols.astype(kind).tobytes(),
    ])


def unpack(payload: bytes) -> Grammar:
    magic, base, rules, symbols, width = struct.unpack_from(_HEADER, payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at, out = struct.calcsize(_HEADER), []
    for count, size in ((rules, width), (rules, width), (rules, 4), (symbols, width)):
        out.append(np.frombuffer(payload, dtype=f"<u{size}", count=count, offset=at).astype(np.uint32))
        at += count * size
    return Grammar(base, *out)


# --- files -------------------------------------------------------------------------


def _block_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        # Ids and documents of the part before this block; whether its first document began earlier, its last goes on.
        T.StructField("first_id", T.LongType()), T.StructField("first_document", T.LongType()),
        T.StructField("goes_on", T.BooleanType()), T.StructField("is_cut", T.BooleanType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("counts", T.ArrayType(T.IntegerType())),
        T.StructField("payload", T.BinaryType()),
    ])


def write(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> None:
    """Write the ids of all texts, in ascending order of ``doc_id``, to ``folder``.

    Null texts count as empty: their end alone. Null ids come first; equal ids
    go by bytes and checksum of the text, and rows equal in all three may change
    places, which changes no id of the file. An empty table gives empty files.
    Other columns are not read. A document of any length is cut into blocks;
    a worker holds one text, its ids and one block. ``path`` names a tokenizer
    file that every executor has.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.octet_length("text").asc(), F.crc32(F.col("text").cast("binary")).asc()]
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    dealt = dealt.select("doc_id", "text", F.spark_partition_id().alias("part"))
    kind = docs.schema[doc_id].dataType
    schema = _block_schema(kind)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or _Writer(batch.column(2)[0].as_py(), batch.schema.field(0).type, block)
            at = 0
            for some in slices(batch.column(1), BATCH_BYTES):
                ids, ends = encode(some, path)
                yield from writer.add(batch.column(0).slice(at, len(some)), ids, np.diff(ends, prepend=0))
                at += len(some)
        if writer is not None:
            yield from writer.rest()

    dealt.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    held = spark.read.schema(schema).parquet(f"{folder}/blocks").select(
        "part", F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c).alias("n")
    )
    # One row per part.
    upto = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    totals = held.groupBy("part").agg(F.sum("n").alias("n"))
    totals.select("part", "n", (upto - F.col("n")).alias("start")).write.parquet(f"{folder}/parts")


class _Writer:
    """Cuts the ids of one part into blocks."""

    def __init__(self, part: int, kind: pa.DataType, block: int):
        self.part, self.kind, self.size = part, kind, block
        self.block = self.first_id = self.first_document = 0
        self.goes_on = False
        self.names: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(counts)
        done = taken = 0  # documents and ids that went into earlier blocks
        while self.held + len(ids) - taken >= self.size:
            to = taken + self.size - self.held
            upto = int(np.searchsorted(ends, to)) + 1  # documents with an id before ``to``
            cut = int(ends[upto - 1]) > to
            inside = np.minimum(ends[done:upto], to) - np.maximum(ends[done:upto] - counts[done:upto], taken)
            self._hold(names.slice(done, upto - done), ids[taken:to], inside)
            yield self._block(cut)
            done, taken = upto - cut, to
        if len(ids) > taken:
            self._hold(names.slice(done), ids[taken:], ends[done:] - np.maximum(ends[done:] - counts[done:], taken))

    def _hold(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.names.append(names)
        self.ids.append(ids)
        self.counts.append(counts)
        self.held += len(ids)

    def _block(self, cut: bool) -> pa.RecordBatch:
        names = pa.concat_arrays(self.names)
        counts = np.concatenate(self.counts)
        # A document held in two pieces of one block can only be the one that goes on.
        row = [
            [self.part], [self.block], [self.first_id], [self.first_document], [self.goes_on], [cut],
            pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
            pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int32())),
            pa.array([pack(compress(np.concatenate(self.ids)))], pa.binary()),
        ]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        arrays = [pa.array(v, t) for v, t in zip(row, kinds)] + row[6:]
        self.block += 1
        self.first_id += self.held
        self.first_document += len(names) - cut
        self.goes_on = cut
        self.names, self.counts, self.ids, self.held = [], [], [], 0
        return pa.RecordBatch.from_arrays(arrays, names=[
            "part", "block", "first_id", "first_document", "goes_on", "is_cut", "doc_ids", "counts", "payload",
        ])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self._block(False)


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with the number of ids before each, and the places of whole and of cut documents in it."""
    parts = spark.read.parquet(f"{folder}/parts").select("part", "start")
    blocks = spark.read.parquet(f"{folder}/blocks")
    last = F.size("doc_ids") - 1
    every = F.sequence(F.lit(0), last)

    def is_cut(i):
        return ((i == 0) & F.col("goes_on")) | ((i == last) & F.col("is_cut"))

    # One row per part of the files, whose number is that of the shuffle partitions.
    return blocks.join(F.broadcast(parts), "part").select(
        "part", "first_document", (F.col("start") + F.col("first_id")).alias("first_id"), "doc_ids", "counts", "payload",
        F.filter(every, lambda i: ~is_cut(i)).alias("whole"), F.filter(every, is_cut).alias("cut"),
    )


#: What is told of a document's ids: type, Arrow type and function of their bytes.
_VALUES = {"ids": (T.BinaryType(), pa.binary(), bytes), "ids_crc32": (T.LongType(), pa.int64(), zlib.crc32)}


def _pieces(blocks: DataFrame, places: str, value: str) -> DataFrame:
    """part, document, doc_id, start, n_tokens and value of the documents at these places of each block."""
    kind = blocks.schema["doc_ids"].dataType.elementType
    value_type, arrow_type, of = _VALUES[value]
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("document", T.LongType()), T.StructField("doc_id", kind),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField(value, value_type),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = {name: batch.column(name)[row] for name in batch.schema.names}
                at = held["places"].values.to_numpy()
                counts = held["counts"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(counts)
                grammar = unpack(held["payload"].as_py())
                # All ids at once where most are asked for, else only what covers each document.
                spans = zip((ends[at] - counts[at]).tolist(), ends[at].tolist())
                if counts[at].sum() * 2 > ends[-1]:
                    ids = memoryview(decompress(grammar).astype("<u4").tobytes())
                    values = [of(ids[4 * low : 4 * high]) for low, high in spans]
                else:
                    values = [of(decompress(grammar, low, high).astype("<u4").tobytes()) for low, high in spans]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), held["part"].as_py()), pa.int32()),
                    pa.array(held["first_document"].as_py() + at, pa.int64()),
                    held["doc_ids"].values.take(pa.array(at)),
                    pa.array(held["first_id"].as_py() + ends[at] - counts[at], pa.int64()),
                    pa.array(counts[at], pa.int64()), pa.array(values, arrow_type),
                ], names=schema.names)

    return blocks.withColumn("places", F.col(places)).drop("whole", "cut").where(F.size("places") > 0).mapInArrow(read, schema)


def _crc_joined(pieces: pa.Array) -> pa.Array:
    """Checksum of pieces end to end, from the checksum and number of ids of each.

    The checksum is affine in what came before: zeros in place of the next
    piece carry the earlier checksum over it.
    """
    out = []
    for row in pieces.to_pylist():
        crc = 0
        for piece in row:
            zeros = bytes(4 * piece["n_tokens"])
            crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ piece["ids_crc32"]
        out.append(crc)
    return pa.array(out, pa.int64())


def _documents(blocks: DataFrame, value: str) -> DataFrame:
    """doc_id, start, n_tokens, value of the documents that ``blocks`` names; documents cut into blocks are put together."""
    columns = ["doc_id", "start", "n_tokens", value]
    piece = F.struct("start", "n_tokens", value)
    cut = _pieces(blocks, "cut", value).groupBy("part", "document").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    if value == "ids":
        joined = F.aggregate("pieces", F.lit(b""), lambda held, p: F.concat(held, p["ids"]))
    else:
        joined = F.arrow_udf(_crc_joined, "long")(F.col("pieces"))
    number = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["n_tokens"])
    whole = _pieces(blocks, "whole", value).select(columns)
    return whole.unionByName(cut.select(
        "doc_id", F.col("pieces")[0]["start"].alias("start"), number.alias("n_tokens"), joined.alias(value)
    ))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document: the ids before it, its number of ids with the end, and its ids as unsigned 32-bit little-endian bytes."""
    return _documents(_blocks(spark, folder), "ids")


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """As ``read``, for the documents whose number is in the first column of ``wanted``.

    Only blocks that hold such a document are opened, and of these only the
    rules under its ids. Nulls ask for documents without a number; numbers that
    no document has give no rows.
    """
    blocks = _blocks(spark, folder).withColumn("_row", F.struct("part", "first_id"))
    asked = wanted.select(wanted[wanted.columns[0]].alias("asked")).distinct()
    listed = blocks.select("_row", F.posexplode("doc_ids").alias("place", "name"))
    places = listed.join(asked, F.col("name").eqNullSafe(F.col("asked")), "left_semi").groupBy("_row").agg(
        F.sort_array(F.collect_list("place")).alias("asked")
    )
    found = blocks.join(places, "_row").drop("_row").withColumns(
        {name: F.array_intersect(F.col(name), F.col("asked")) for name in ("whole", "cut")}
    )
    return _documents(found.drop("asked"), "ids")


def report(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from files written for it; see ``write`` for odd rows."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-file")
    write(docs, folder, path, doc_id, text)
    return _documents(_blocks(spark, folder), "ids_crc32")
