import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, empty, odd
from hypothesis import given, settings
from hypothesis import strategies as st

from camlytics.llm import periodic, queries


def plain_runs(words):
    """All runs, from a comparison of every word with the one a period on, for every period."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, out = np.array([numbers[w] for w in words], dtype=int), []
    for q in range(1, len(words) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids[:-q] == ids[q:], [0]])))
        for i, j in edges.reshape(-1, 2).tolist():
            n = j - i + q
            part = ids[i : i + n]
            if n >= max(6, 4 * q) and not any((part[:-p] == part[p:]).all() for p in range(1, q)):
                out.append((i, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, *digest)


def found(texts):
    a = periodic.analyse(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for row in zip(a.text.tolist(), a.start.tolist(), a.length.tolist(), a.period.tolist()):
        out[row[0]].append(row[1:])
    return out


repeated = st.tuples(
    st.lists(st.sampled_from("ab"), max_size=9), st.lists(st.sampled_from("abc"), min_size=1, max_size=7),
    st.integers(1, 9), st.lists(st.sampled_from("abc"), max_size=9),
).map(lambda t: t[0] + t[1] * t[2] + t[3])


@settings(max_examples=150, deadline=None)
@given(st.lists(repeated, min_size=1, max_size=6))
def test_runs_like_a_walk(texts):
    assert found([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_random_words_of_few_kinds():
    rnd = random.Random(5)
    texts = [[rnd.choice("ab") for _ in range(rnd.randint(0, 150))] for _ in range(60)]
    assert found([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_extensions_like_a_loop():
    rnd = np.random.default_rng(3)
    symbols = np.append(rnd.integers(0, 2, 400), 9)
    symbols[100:180] = symbols[20:100]
    extensions = periodic.Extensions(symbols)
    pairs = rnd.integers(0, 400, (3000, 2))
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]

    def common(i, j):
        n = 0
        while symbols[i + n] == symbols[j + n]:
            n += 1
        return n

    assert extensions.of(pairs[:, 0], pairs[:, 1]).tolist() == [common(i, j) for i, j in pairs.tolist()]


@pytest.mark.parametrize("words", [["x"] * 20_000, ["a", "b", "c"] * 9000 + ["a"], [f"w{i % 4001}" for i in range(20_000)]])
def test_long_runs(words):
    q = len(set(words))
    assert found([" ".join(words)]) == [[(0, len(words), q)]]


def test_words_end_at_ascii_space_only():
    text = "\x1c  \x1c \t\x1c \x0b\x1c \x0c\x1c \r\x1c  a\x85a"
    assert found([text]) == [[(0, 6, 1)]]


def test_no_run_across_texts():
    assert found(["a a a", "a a a", "a a a a a a"]) == [[], [], [(0, 6, 1)]]


def test_digests_like_plain_python(spark, documents, texts):
    got = sorted(tuple(r) for r in periodic.digests(documents).collect())
    assert got == sorted(plain_digest(i, t) for i, t, *_ in texts)
    assert any(r[1] for r in got)


def test_registered_query(spark, tiny, documents):
    got = queries.op13_periodic_runs(spark, tiny)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, periodic.digests(documents).collect()))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == [
        "doc_id bigint", "n_runs bigint", "start bigint", "length bigint", "period bigint", "exponent_milli bigint",
        "runs_sha256 string", "collapsed_sha256 string",
    ]


def test_odd_and_empty_tables(spark):
    got = sorted((tuple(r) for r in periodic.digests(odd(spark)).collect()), key=repr)
    assert got == sorted((plain_digest(r.doc_id, r.text) for r in odd(spark).collect()), key=repr)
    for apply in (periodic.digests, periodic.find_runs, periodic.collapse):
        assert apply(empty(spark)).count() == 0


def test_runs_and_collapsed_texts(spark):
    rows = [(1, "go " * 7 + "on", "en"), (2, "  kept\tas it  is ", "en"), (None, None, None), (3, "", "x"), (1, "go " * 7 + "on", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    assert sorted(map(tuple, periodic.find_runs(docs).collect())) == [(1, 0, 7, 1), (1, 0, 7, 1)]
    short = periodic.collapse(docs)
    assert short.schema == docs.schema
    want = [(i, "go on" if i == 1 else t, s) for i, t, s in rows]
    assert sorted(map(tuple, short.collect()), key=repr) == sorted(want, key=repr)
