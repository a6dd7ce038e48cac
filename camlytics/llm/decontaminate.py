"""Benchmark items inside training texts, found also when edited.

Every n-gram of an item is a seed, however common it is. A text that holds a
seed is aligned with the item around it by Smith-Waterman over words; the
score, as a share of a perfect copy's, says whether the item leaks. Places
whose words alone rule out that score are not aligned, which loses nothing. A
copy is seen where one n-gram is left whole: four words in a row, two or three
for items of 5 to 8 words, the whole of a shorter item.

Items go to the executors in blocks of at most ``ITEM_BYTES`` of text; a larger
benchmark takes one pass over the documents per block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camlytics.llm.common import TO_LOWER, Words, hash_spans, mix, packed, slices, text_bytes

GRAM = 4
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
ITEM_BYTES = 16 << 20

#: Words are runs of ASCII letters, digits and bytes beyond ASCII, so punctuation added or lost does not matter.
_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _words(column: pa.Array) -> Words:
    data, at = text_bytes(column)
    data = TO_LOWER[data]
    inside = ~_APART[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    edges = at[1:] - 1
    after[edges[edges >= 0]] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, hash_spans(data, starts, ends), np.searchsorted(starts, at))


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each place."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - n + 1 + j]
    return mix(out + np.uint64(n))


def _gram(size: int) -> int:
    """Length of the n-grams of an item; from 5 words on, one edited word leaves one whole."""
    return size if size <= GRAM else min(GRAM, (size - 1) // 2)


class Items(NamedTuple):
    ids: list
    words: list[np.ndarray]
    sizes: tuple[int, ...]  # lengths of n-grams in use
    grams: np.ndarray  # sorted hashes
    spots: list[list[tuple[int, int]]]  # per gram: (item, place)
    quick: np.ndarray  # by the top 16 bits: whether a gram may be there


def _items(rows: list[tuple]) -> Items:
    held = _words(pa.array([r[1] for r in rows], pa.string()))
    words = [held.hashes[a:b] for a, b in zip(held.first, held.first[1:])]
    spots: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes = set()
    for i, w in enumerate(words):
        n = _gram(len(w))
        if n:
            sizes.add(n)
            for at, g in enumerate(_grams(w, n).tolist()):
                spots[g].append((i, at))
    grams = np.array(sorted(spots), dtype=np.uint64)
    quick = np.zeros(1 << 16, dtype=bool)
    quick[(grams >> np.uint64(48)).astype(np.int64)] = True
    return Items([r[0] for r in rows], words, tuple(sorted(sizes)), grams, [spots[g] for g in grams.tolist()], quick)


def _hits(items: Items, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (word numbers in the batch) of the items' n-grams, and which n-gram; none spans two texts."""
    places, which = [], []
    for n in items.sizes:
        grams = _grams(words.hashes, n)
        maybe = np.flatnonzero(items.quick[(grams >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(items.grams, grams[maybe])
        same = (at < len(items.grams)) & (items.grams[np.minimum(at, len(items.grams) - 1)] == grams[maybe])
        place, gram = maybe[same], at[same]
        row = np.searchsorted(words.first, place, side="right") - 1
        whole = place + n <= words.first[row + 1]
        places.append(place[whole])
        which.append(gram[whole])
    return np.concatenate(places) if places else np.zeros(0, int), np.concatenate(which) if which else np.zeros(0, int)


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over two word sequences: score, and begin and end of the best part of ``b``."""

    def best(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
        ramp = -GAP * np.arange(len(y) + 1)
        row, top = np.zeros(len(y) + 1, dtype=np.int64), (0, 0, 0)
        for i, word in enumerate(x):
            new = np.maximum(row + GAP, 0)
            new[1:] = np.maximum(new[1:], row[:-1] + np.where(y == word, MATCH, MISMATCH))
            # A gap of any length in x: the best earlier cell less the way from it.
            row = np.maximum.accumulate(new + ramp) - ramp
            at = int(row.argmax())
            if row[at] > top[0]:
                top = (int(row[at]), i + 1, at)
        return top

    score, i, end = best(a, b)
    back = best(a[:i][::-1], b[:end][::-1])
    return score, end - back[2], end


def _matches(items: Items, words: Words, threshold: float) -> dict[int, list[tuple]]:
    place, gram = _hits(items, words)
    spans: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    row = np.searchsorted(words.first, place, side="right") - 1
    for at, g, r in zip(place.tolist(), gram.tolist(), row.tolist()):
        lo, hi = int(words.first[r]), int(words.first[r + 1])
        for item, offset in items.spots[g]:
            size = len(items.words[item])
            slack = size // 2 + 4
            spans[r, item].append((max(lo, at - offset - slack), min(hi, at - offset + size + slack)))
    out: dict[int, list[tuple]] = defaultdict(list)
    for (r, item), windows in spans.items():
        windows.sort()
        merged = [windows[0]]
        for lo, hi in windows[1:]:
            if lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        perfect = MATCH * len(items.words[item])
        # No alignment matches more of the item's words than the window holds.
        merged = [
            (lo, hi) for lo, hi in merged
            if MATCH * np.isin(items.words[item], words.hashes[lo:hi]).sum() >= threshold * perfect
        ]
        if not merged:
            continue
        score, begin, end = max(
            ((s, -(lo + b), lo + e) for lo, hi in merged for s, b, e in [align(items.words[item], words.hashes[lo:hi])])
        )
        if score >= threshold * perfect:
            first = int(words.first[r])
            out[r].append((items.ids[item], score / perfect, -begin - first, end - first))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> int:
    held = benchmark.agg(F.sum(F.octet_length(F.col(text)) + F.lit(64)).alias("n")).first()["n"]
    return max(1, math.ceil((held or 0) / ITEM_BYTES))


def _matcher(shared, kind: str, threshold: float):
    """Function from texts to the items in each."""
    names = ("item_id", "score", "begin", "end")

    @F.arrow_udf(kind)
    def match(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        for part in slices(texts):
            got = _matches(shared.value, _words(part), threshold)
            out += [[dict(zip(names, m)) for m in sorted(got.get(i, ()))] for i in range(len(part))]
        item = pa.array(shared.value.ids[:1]).type
        return pa.array(out, pa.list_(pa.struct(list(zip(names, (item, pa.float64(), pa.int32(), pa.int32()))))))

    return match


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``_leaks``: array of (item_id, score, begin, end) of every benchmark item in the text.

    ``score`` is 1 for a whole copy; ``begin`` and ``end`` count the text's
    words. A null or empty text leaks nothing, an item without words or without
    an id is never found, repeated items are found each. An empty benchmark
    finds nothing.
    """
    kind = f"array<struct<item_id: {dict(benchmark.dtypes)[item_id]}, score: double, begin: int, end: int>>"
    number = _blocks(benchmark, item_id, item_text)
    known = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("id"), F.col(item_text).alias("text")
    )
    spark = docs.sparkSession
    found = []
    for block in range(number):
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(number)) == block)
        rows = sorted(tuple(r) for r in part.collect())  # at most about ITEM_BYTES
        items = _items(rows)
        if not len(items.grams):
            continue
        found.append(_matcher(spark.sparkContext.broadcast(items), kind, threshold)(F.col(text)))
    return docs.select("*", (F.concat(*found) if found else F.array().cast(kind)).alias("_leaks"))


def report(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, begin_word, end_word: one row for each document and benchmark item in it.

    Repeated documents are reported each. Extra columns are not read.
    """
    found = leaks(docs.select("doc_id", "text"), benchmark, threshold)
    return found.select("doc_id", F.inline("_leaks")).withColumnsRenamed({"begin": "begin_word", "end": "end_word"})


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows that hold no benchmark item, with the columns they came with."""
    whole = docs.select(packed(docs).alias("row"), docs[text].alias("text"))
    return leaks(whole, benchmark, threshold).where(F.size("_leaks") == 0).select("row.*")
