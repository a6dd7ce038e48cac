import random

import numpy as np
import oracle
import pytest
from helpers import components, empty, odd, shingles, similar
from hypothesis import given, settings
from hypothesis import strategies as st

from camlytics.llm import jaccard, queries
from camlytics.llm.links import components as linked


def check(df):
    rows = jaccard.join(df).collect()
    given_rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert len(rows) == len(given_rows)
    # Keys in id order, rows without id last.
    keyed = sorted(given_rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = {k: shingles(t) for k, (_, t) in enumerate(keyed)}
    root = components(sets)
    expected = sorted(
        ((i, len(sets[k]), keyed[root[k]][0]) if sets[k] else (i, 0, i) for k, (i, _) in enumerate(keyed)), key=repr
    )
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == expected


def near_copies(seed=0, groups=12):
    """Groups of edited copies around the limit of similarity, some of hundreds, with shared passages."""
    draw = random.Random(seed)
    vocab = ["v" + str(i) for i in range(400)]
    passage = draw.choices(vocab, k=60)
    texts = []
    for g in range(groups):
        base = draw.choices(vocab, k=draw.choice([3, 6, 12, 30, 45, 60, 150, 400]))
        if g % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(120 if g == 4 else draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 25))):
                copy[draw.randrange(len(copy))] = draw.choice(vocab)
            texts.append(" ".join(copy))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("heavy, common", [(32, 1e-5), (2, 1e-5), (2, 4e-3), (1, 1.0)])
def test_near_copies_with_any_classes(spark, monkeypatch, heavy, common):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    monkeypatch.setattr(jaccard, "COMMON_SHARE", common)
    monkeypatch.setattr(jaccard, "MEMBERS", 1024 if heavy == 32 else 8)
    texts = near_copies(heavy)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))


def test_table(documents):
    check(documents)


def test_odd_rows(spark):
    check(odd(spark))
    assert jaccard.join(empty(spark)).collect() == []


def test_matches_sql(spark, tiny):
    assert oracle.compare(spark, oracle.connect(tiny), tiny, "op9", queries.op9_ngram_jaccard, jaccard.ORACLE) == ""


def test_one_of_each_group_stays(spark, documents, texts):
    kept = jaccard.representatives(documents)
    assert kept.schema == documents.schema
    roots = components({i: shingles(t) for i, t, *_ in texts})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
    rows = jaccard.representatives(odd(spark))
    assert rows.columns == odd(spark).columns
    # Without words: ids 4, 5, 6 and one without id.
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows.collect()) == [
        *[(False, i) for i in (1, 4, 5, 6, 7, 9, 10, 12, 13, 14, 15)], (True, 0),
    ]
    assert jaccard.representatives(empty(spark)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_similar_sets_share_a_signature(data):
    n = data.draw(st.integers(1, 300))
    draw = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    pool = draw.integers(0, 2**63, 2 * n + 2).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    pool = np.unique(pool)
    draw.shuffle(pool)
    frequent = set(pool[draw.random(len(pool)) < data.draw(st.sampled_from([0.0, 0.3, 0.8, 1.0]))].tolist())
    a = set(pool[:n].tolist())
    lost, extra = data.draw(st.integers(0, n // 4)), data.draw(st.integers(0, n // 4))
    b = set(pool[lost : n + extra].tolist())
    if not similar(frozenset(a), frozenset(b)):
        return

    def signed(s):
        tokens = np.array(sorted(s), dtype=np.uint64)
        one, two = jaccard.signatures(tokens, np.array([t in frequent for t in tokens.tolist()]))
        return set(one.tolist()) | set(two.tolist())

    assert signed(a) & signed(b)


def test_components_of_links(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (200, 201), (201, 202), (203, 200), (5, 5), (300, 301), (301, 300)]
    got = {r.node: r.root for r in linked(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 1, **{i: 200 for i in (200, 201, 202, 203)}, 300: 300, 301: 300}
    assert linked(spark.createDataFrame([], "a long, b long")).collect() == []
