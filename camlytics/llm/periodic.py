"""Runs: stretches of words that repeat with a short period, many times over.

A run has a smallest period q, at least ``max(LEAST_WORDS, LEAST_REPEATS * q)``
words, and cannot be extended. Every run of period q holds a multiple of q
within its first q words, so it is enough to look at the harmonic grid: for each
q the pairs (i, i + q) with i a multiple of q. Those that agree on a few words
are extended both ways by longest common extensions, and the ends give the run.

Extensions come from a difference cover: only suffixes at positions whose
residue modulo 7 lies in a perfect difference set are sorted. For any two
positions, after at most six words both are such positions, so a query compares
these few words and reads the rest as the minimum of a range of neighbours'
common prefixes, from a sparse table.

Texts are handled many at a time, parted by separators that occur once each, so
that no stretch goes on from one text into the next.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.llm.common import slices

LEAST_WORDS, LEAST_REPEATS = 6, 4
#: A perfect difference set modulo 7: every difference occurs once.
MODULUS, COVER = 7, (0, 1, 3)
#: Texts handled together, and grid pairs looked at together.
BATCH_BYTES, PAIRS = 1 << 20, 1 << 20

_SLOT = np.full(MODULUS, -1)
_SLOT[list(COVER)] = np.arange(len(COVER))
#: Steps from residues (a, b) until both are in the cover.
_STEPS = np.array([
    [next(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER) for b in range(MODULUS)]
    for a in range(MODULUS)
])


def _names(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the order of the keys; equal keys get equal numbers."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """Longest common extensions to the right, for a sequence whose last symbol occurs once."""

    def __init__(self, symbols: np.ndarray):
        blocks = -(-len(symbols) // MODULUS)
        self.symbols = np.concatenate([symbols, np.zeros((blocks + 2) * MODULUS - len(symbols), dtype=np.int64)])
        self.each = len(COVER)
        places = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.places = places[places < len(symbols)]
        count = len(self.places)
        levels = [self._first_names()]
        # Names of stretches twice as long, until all sampled suffixes differ; a place beyond the end counts as 0.
        while levels[-1].max(initial=0) + 1 < count:
            ahead = self.each << (len(levels) - 1)
            after = np.zeros(count, dtype=np.int64)
            after[: max(count - ahead, 0)] = levels[-1][ahead:] + 1
            levels.append(_names(levels[-1] * (count + 1) + after))
        self.rank = levels[-1]
        self.table = self._sparse(self._neighbours(levels))

    def _first_names(self) -> np.ndarray:
        """Names of the next ``MODULUS`` symbols of each sampled place."""
        bits = max(int(self.symbols.max(initial=0)).bit_length(), 1)
        at_once = max(62 // bits, 1)
        named = None
        for low in range(0, MODULUS, at_once):
            key = np.zeros(len(self.places), dtype=np.int64)
            for step in range(low, min(low + at_once, MODULUS)):
                key = key << bits | self.symbols[self.places + step]
            key = _names(key)
            named = key if named is None else _names(named * (len(key) + 1) + key)
        return named

    def _neighbours(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix with the next one in order."""
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        last = len(order) - 1
        for level in range(len(levels) - 2, -1, -1):
            same = levels[level][np.minimum(a, last)] == levels[level][np.minimum(b, last)]
            same &= (a <= last) & (b <= last)
            step = self.each << level
            common[same] += MODULUS << level
            a[same] += step
            b[same] += step
        inside = (a <= last) & (b <= last)
        x, y = self.places[np.minimum(a, last)], self.places[np.minimum(b, last)]
        for step in range(MODULUS):
            inside &= self.symbols[x + step] == self.symbols[y + step]
            common += inside
        return common

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        rows, width = [values], 1
        while 2 * width <= len(values):
            rows.append(np.minimum(rows[-1][:-width], rows[-1][width:]))
            width *= 2
        return rows

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over low <= k < high, from two rows' entries that cover the range."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the symbols from ``a`` and from ``b`` agree; the two differ."""
        steps = _STEPS[a % MODULUS, b % MODULUS]
        out = np.zeros(len(a), dtype=np.int64)
        alike = np.ones(len(a), dtype=bool)
        for step in range(int(steps.max(initial=0))):
            look = alike & (step < steps)
            alike &= ~look | (self.symbols[a + step] == self.symbols[b + step])
            out += look & alike
        at = np.flatnonzero(alike)
        if len(at):
            x, y = a[at] + steps[at], b[at] + steps[at]
            p = self.rank[x // MODULUS * self.each + _SLOT[x % MODULUS]]
            q = self.rank[y // MODULUS * self.each + _SLOT[y % MODULUS]]
            out[at] += self._least(np.minimum(p, q), np.maximum(p, q))
        return out


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes laid end to end: the group and the place in it of each member."""
    group = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return group, np.arange(len(group)) - np.repeat(ends - counts, counts)


def _grid(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and period of the grid pairs that may start a run.

    The first grid place of a run has fewer than q words of the run before it,
    so the run goes on for more than 2q words after it with period q.
    """
    text, period = _ragged(sizes // LEAST_REPEATS)
    period = period + 1
    counts = np.maximum((sizes[text] - 3 * period - 1) // period + 1, 0)
    cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, counts.sum() + PAIRS, PAIRS))
    for low, high in zip([0, *(cuts[:-1] + 1)], cuts + 1):
        group, nth = _ragged(counts[low:high])
        q = period[low:high][group]
        of = text[low:high][group]
        at = first[of] + nth * q
        for halves in (0, 2, 4, 1, 3):
            look = at + halves * q // 2
            same = np.flatnonzero(ids[look] == ids[look + q])
            at, q, of, nth = at[same], q[same], of[same], nth[same]
        yield of, nth * q, q


def _parted(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen texts' words, each text after a separator of its own and one at the end; where each text starts."""
    group, nth = _ragged(sizes[chosen])
    starts = np.cumsum(sizes[chosen] + 1) - sizes[chosen]
    top = int(ids.max(initial=0)) + 1
    out = np.empty(int(sizes[chosen].sum()) + len(chosen) + 1, dtype=np.int64)
    out[np.append(starts - 1, len(out) - 1)] = top + np.arange(len(chosen) + 1)
    out[starts[group] + nth] = ids[first[chosen][group] + nth]
    return out, starts


def runs_of(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, by text, start and period.

    ``ids`` numbers the words of all texts, text k has ``sizes[k]`` from
    ``first[k]`` on. Equal words have equal numbers.
    """
    of, at, q = (np.concatenate(x) for x in zip(*[(np.zeros(0, dtype=np.int64),) * 3, *_grid(ids, first, sizes)]))
    for backward in (False, True):
        chosen, row = np.unique(of, return_inverse=True)
        if not len(chosen):
            break
        symbols, starts = _parted(ids, first, sizes, chosen)
        here = starts[row] + at
        if backward:
            back = Extensions(symbols[::-1]).of(len(symbols) - here, len(symbols) - here - q)
        else:
            ahead = Extensions(symbols).of(here, here + q)
            long = ahead > 2 * q
            of, at, q, ahead = of[long], at[long], q[long], ahead[long]
    if not len(of):
        return of, at, q, q
    start, length = at - back, back + ahead + q
    long = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * q)
    of, start, length, q = of[long], start[long], length[long], q[long]
    # A stretch found with a multiple of its period has the same ends: the smallest period stays.
    order = np.lexsort((q, length, start, of))
    of, start, length, q = of[order], start[order], length[order], q[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.flatnonzero(new)
    order = order[np.lexsort((q[order], start[order], of[order]))]
    return of[order], start[order], length[order], q[order]


@dataclass
class Analysed:
    """Runs of a batch of texts, and which of their words stay."""

    words: pa.Array
    source: np.ndarray  # place in ``words`` of each word
    first: np.ndarray  # first[k]:first[k + 1] are the words of text k
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray
    kept: np.ndarray

    def collapsed(self) -> pa.Array:
        """The words of each text that stay, joined by one space."""
        ends = np.concatenate([[0], np.cumsum(self.kept)])[self.first]
        words = self.words.take(pa.array(self.source[self.kept]))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), words), pa.scalar(" ", pa.large_string()))


def analyse(texts: pa.Array, order=None) -> Analysed:
    """Runs of each text. ``order(k, n)`` may give the places of text k's words in another order."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, at = lists.flatten(), lists.offsets.to_numpy()
    held = np.asarray(pc.not_equal(pc.binary_length(flat), 0)).astype(bool)
    first = np.concatenate([[0], np.cumsum(held)])[at - at[0]]
    words = flat.filter(pa.array(held))
    sizes = np.diff(first)
    source = np.arange(len(words))
    if order is not None:
        for k in range(len(sizes)):
            places = order(k, int(sizes[k]))
            if places is not None:
                source[first[k] : first[k + 1]] = first[k] + places
    encoded = words.dictionary_encode()
    ids = encoded.indices.to_numpy().astype(np.int64)[source] if len(words) else np.zeros(0, dtype=np.int64)
    text, start, length, period = runs_of(ids, first[:-1], sizes)
    # Words after a run's first period: +1 where they begin, -1 where they end.
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, first[text] + start + period, 1)
    np.add.at(edges, first[text] + start + length, -1)
    return Analysed(words, source, first, text, start, length, period, np.cumsum(edges)[:-1] == 0)


RUNS = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, period: one row for each run of each text; places count words from 0.

    Words are compared as they are. Null and empty texts, and texts without
    runs, give no rows; repeated rows give their runs each. Other columns are
    not read. Memory grows with the longest text: about 300 bytes a word.
    """
    kind = docs.schema[doc_id].dataType

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), BATCH_BYTES):
                a = analyse(part)
                owner = batch.column(0).slice(at, len(part)).take(pa.array(a.text))
                at += len(part)
                yield pa.RecordBatch.from_arrays([owner, *map(pa.array, (a.start, a.length, a.period))], names=["doc_id", *RUNS.names])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(found, T.StructType([T.StructField("doc_id", kind), *RUNS.fields]))


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each run of its texts cut to its first period, words parted by one space.

    Texts without runs, null and empty texts stay as they are, byte for byte;
    so do all other columns and repeated rows.
    """

    @F.arrow_udf("string")
    def shortened(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts, BATCH_BYTES):
            a, held = analyse(part), part.to_pylist()
            if len(a.text):
                joined = a.collapsed()
                for k in np.unique(a.text).tolist():
                    held[k] = joined[k].as_py()
            out += held
        return pa.array(out, type=pa.string())

    return docs.withColumn(text, shortened(F.col(text)))


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The fixture's repetition: every tenth text repeats part of itself, by the checksum of its id; a null id counts as empty."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


_DIGEST = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")],
    *[T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")],
])


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant=planted) -> DataFrame:
    """Per row: number of runs, the run with most repeats, digests of all runs and of the collapsed words.

    Of runs with equally many repeats the first is named, then the one with the
    shorter period. Null and empty texts have no runs and no words: four nulls
    and digests of the empty string. Rows with equal or null ids are handled
    each on its own; extra columns are not read. ``plant(doc_id, n)`` rearranges
    words first. Texts go through in batches of about ``BATCH_BYTES``; memory
    grows with the longest text only, by about 300 bytes a word.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *_DIGEST.fields])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), BATCH_BYTES):
                owner = batch.column(0).slice(at, len(part))
                at += len(part)
                names = owner.to_pylist()
                yield _digested(owner, analyse(part, lambda k, n: plant(names[k], n) if plant else None))

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(digest, schema)


def _digested(owner: pa.Array, a: Analysed) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(7)]
    edges = np.searchsorted(a.text, np.arange(len(owner) + 1))
    joined = a.collapsed()
    for k in range(len(owner)):
        low, high = edges[k], edges[k + 1]
        found = [(int(a.start[r]), int(a.length[r]), int(a.period[r])) for r in range(low, high)]
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        row = (
            len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(joined[k].as_buffer()).hexdigest(),
        )
        for column, value in zip(columns, row):
            column.append(value)
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["doc_id", *_DIGEST.names]
    return pa.RecordBatch.from_arrays([owner, *[pa.array(c, type=t) for c, t in zip(columns, kinds)]], names=names)
