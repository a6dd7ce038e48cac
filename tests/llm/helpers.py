"""Small tables with every odd case, and plain-Python twins of the operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside.
    "row string, size long, shard int, word string, n long, _id long, _part int, hub long, body string"
)
LONG = " ".join(f"word{i % 997} und{i % 31}" for i in range(30_000))


def odd_rows() -> list[tuple]:
    plain = "the cat sat on the mat and looked at the dog for a long while today"
    rows = [
        (1, plain, "en", "b"), (2, plain, "en", "a"), (2, plain, "en", "a"), (3, plain.upper(), "en", None),
        (4, None, "en", "a"), (5, "", "en", "a"), (6, " \t\n ", None, "a"), (7, "one", "en", "b"), (8, "ONE", "en", "b"),
        (9, "%%% 123 ...", "de", "b"), (None, plain + " again", "en", "a"), (None, None, None, None),
        (10, LONG, "en", "long"), (11, LONG + " end", "en", "long"), (12, "été où ça naïve 语言 \U0001F600 x", "fr", "é"),
        (13, "x" * 50_000, None, ""), (14, "a b c d e", "en", "a"), (15, "a b c d", "en", "a"),
    ]
    return [(i, t, g, s, None if t is None else len(t), "r", -1, 99, "w", 7, -5, 3, 0, "b") for i, t, g, s in rows]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[k:] for k in range(5)]))


def similar(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 75 * (len(a) + len(b) - both)


def components(sets: dict) -> dict:
    """Smallest key reachable over similar sets, for keys that can be ordered."""
    by_token = defaultdict(list)
    for key, s in sets.items():
        for token in s:
            by_token[token].append(key)
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for key, s in sets.items():
        for other in Counter(o for token in s for o in by_token[token] if o > key):
            if similar(s, sets[other]):
                a, b = root(key), root(other)
                parent[max(a, b)] = min(a, b)
    return {key: root(key) for key in sets}
