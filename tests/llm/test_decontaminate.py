import random

import numpy as np
import pyarrow as pa
from helpers import empty, odd

from camlytics.llm import decontaminate
from camlytics.llm.decontaminate import GAP, MATCH, MISMATCH, _words, align


def slow_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = MATCH if a[i - 1] == b[j - 1] else MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    return int(h.max())


def test_alignment_scores():
    draw = np.random.default_rng(0)
    for _ in range(60):
        a, b = (draw.integers(0, 4, draw.integers(1, 25)).astype(np.uint64) for _ in range(2))
        score, begin, end = align(a, b)
        assert score == slow_align(a, b)
        if score:
            assert slow_align(a, b[begin:end]) == score


def _corpus(spark, seed=0):
    draw = random.Random(seed)
    vocab = ["w" + str(i) for i in range(3000)]
    items = [(i, " ".join(draw.choices(vocab, k=draw.randint(12, 60)))) for i in range(30)]
    docs, planted = [], {}
    for d in range(400):
        w = draw.choices(vocab, k=draw.randint(30, 300))
        if d % 5 == 0:
            item, text = items[draw.randrange(30)]
            copy = text.split()
            if d % 2:
                for _ in range(len(copy) // 8):  # an eighth of the words changed, lost or added
                    at = draw.randrange(len(copy))
                    copy[at : at + 1] = draw.choice([[], ["edited"], [copy[at], "more"]])
            at = draw.randrange(len(w))
            w[at:at] = [x.upper() + draw.choice(["", ",", "!"]) for x in copy]
            planted[d] = item
        docs.append((d, " ".join(w)))
    return docs, items, planted


def test_planted_items_are_found_and_clean_texts_left_alone(spark):
    docs, items, planted = _corpus(spark)
    found = decontaminate.report(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {r.doc_id: r.item_id for r in found} == planted and len(found) == len(planted)
    texts = dict(docs)
    for r in found:
        held = _words(pa.array([texts[r.doc_id]]))
        assert 0 <= r.begin_word < r.end_word <= len(held.starts)


def test_brute_force_over_the_table(spark, documents, texts, tiny):
    benchmark = spark.read.parquet(f"{tiny}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.report(documents, benchmark).collect()}
    items = [(r.item_id, _words(pa.array([r.text])).hashes) for r in benchmark.collect()]
    expected = set()
    for i, text, *_ in texts:
        w = _words(pa.array([text])).hashes
        for item, held in items:
            if len(np.intersect1d(w, held)) * 2 >= len(set(held.tolist())) and align(held, w)[0] >= 0.5 * MATCH * len(held):
                expected.add((i, item))
    assert found == expected
    kept = decontaminate.clean(documents, benchmark)
    assert kept.schema == documents.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in texts} - {d for d, _ in expected}


def test_item_that_very_many_texts_hold(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(i, f"{item} tail{i} number{i * 7}") for i in range(300)], "doc_id long, text string")
    found = decontaminate.report(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert found.count() == 300


def test_edited_copies_are_found(spark):
    draw = random.Random(3)
    items = [(i, " ".join(f"i{i}n{j}" for j in range(size))) for i, size in enumerate([5, 6, 7, 8, 10, 30, 40, 40])]
    docs, expected = [], set()

    def plant(item, gone):
        copy = [f"edit{len(docs)}n{j}" if j in gone else w for j, w in enumerate(items[item][1].split())]
        expected.add((len(docs), item))
        docs.append((len(docs), " ".join([f"a{draw.randrange(9999)}" for _ in range(20)] + copy + ["tail"] * 20)))

    for item in range(5):  # each word of a short item in turn; hundreds of equal copies of one edit
        for at in range(len(items[item][1].split())):
            plant(item, {at})
    for _ in range(300):
        plant(4, {4})
    plant(5, {4, 10, 16, 22})
    for item in (6, 7):  # 15 to 30 % of the words, four in a row left
        for _ in range(20):
            for edits in (6, 9, 12):
                keep = draw.randrange(37)
                plant(item, set(draw.sample([j for j in range(40) if not keep <= j < keep + 4], edits)))
    found = decontaminate.report(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected and found.count() == len(expected)


def test_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, "the cat sat on the mat and looked"), (2, None), (None, "the cat sat on the mat"), (3, ""), (4, "one"), (4, "one"), (5, "x" * 50_000)],
        "item_id long, text string",
    )
    found = sorted((r.doc_id or -1, r.item_id) for r in decontaminate.report(odd(spark), items).collect())
    assert found == sorted([(d, 1) for d in (1, 2, 2, 3, -1)] + [(d, 4) for d in (7, 7, 8, 8)] + [(13, 5)])
    assert decontaminate.clean(odd(spark), items).columns == odd(spark).columns
    assert decontaminate.clean(odd(spark), items).count() == odd(spark).count() - 8
    assert decontaminate.report(empty(spark), items).collect() == []
    assert decontaminate.report(odd(spark), items.limit(0)).collect() == []
    assert decontaminate.clean(odd(spark), items.limit(0)).count() == odd(spark).count()


def test_items_in_several_blocks(spark, documents, tiny, monkeypatch):
    benchmark = spark.read.parquet(f"{tiny}/benchmark.parquet")
    whole = sorted(tuple(r)[:3] for r in decontaminate.report(documents, benchmark).collect())
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2000)
    assert sorted(tuple(r)[:3] for r in decontaminate.report(documents, benchmark).collect()) == whole
