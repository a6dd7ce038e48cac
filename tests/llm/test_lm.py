import glob
import math
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import empty, odd, words
from pyspark.sql import functions as F

from camlytics.llm import attention, lm
from camlytics.llm.common import long_rows
from camlytics.llm.queries import SUBWORDS

PATH = public_tokenizers.path(SUBWORDS)


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check(df):
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    learned = [words(t) for i, t in given if not held_out(i)]
    c = Counter(w for t in learned for w in t)
    total, kinds = sum(c.values()) + len(learned), len(c) + bool(learned)
    d = total + kinds + 1
    expected = sorted(
        (i is None, i or 0, held_out(i), len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + bool(learned), total,
         round(sum(math.log10((c[w] + 1) / d) for w in words(t)) + math.log10((len(learned) + 1) / d), 4))
        for i, t in given
    )
    rows = lm.score(df, PATH).collect()
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows
    )
    for a, b in zip(got, expected):
        assert a[:-1] == b[:-1] and a[-1] == pytest.approx(b[-1], rel=1e-9, abs=2e-3)
    assert len(got) == len(expected) and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return rows


def test_counts_and_base_score(spark, documents, monkeypatch):
    check(documents)
    check(odd(spark))
    assert lm.score(empty(spark), PATH).collect() == []


def test_rare_words_are_joined(documents, monkeypatch):
    monkeypatch.setattr(lm, "TOP_WORDS", 20)
    check(documents)


def test_training_lowers_the_loss_on_held_out_texts(documents):
    trained = [r for r in lm.score(documents, PATH, every=4, rounds=4).collect() if r.held_out]
    fresh = {r.doc_id: r.score for r in lm.score(documents, PATH, every=10**9).collect() if r.held_out}
    assert sum(r.score for r in trained) > 0.97 * sum(fresh.values())


def _vocabulary(seed=0):
    draw = np.random.default_rng(seed)
    v = attention.vocabulary((draw.pareto(1, 3000) * 10).astype(int))
    before, ids = draw.integers(0, attention.INPUTS + 1, 5000), draw.integers(0, 3000, 5000)
    cells = attention.cell(v, before, ids)
    return attention.followed(v, cells[cells >= 0], np.ones((cells >= 0).sum()))


def test_each_id_is_scored_once_with_the_ids_before_it():
    v, draw = _vocabulary(), np.random.default_rng(1)
    ids = draw.integers(0, 3000, 500)
    first = np.array([0, 0, 1, 16, 17, 400, 500])
    rows, held, number = attention.windows(ids, first, v.inputs)
    scored = held[:, attention.CONTEXT :].ravel()
    assert scored[scored >= 0].tolist() == ids.tolist() and number.tolist() == [-(-n // attention.SCORED) for n in np.diff(first).tolist()]
    p = attention.split(attention.start(v, 3))
    at = int(number[:4].sum())
    base = attention.log_probability(p, v, rows[at : at + 1], held[at : at + 1])
    # Later ids do not matter for an earlier one.
    cut = held[at : at + 1].copy()
    cut[:, attention.CONTEXT + 10 :] = -1
    changed = rows[at : at + 1].copy()
    changed[:, attention.CONTEXT + 10 :] = 7
    a = attention.log_probability(p, v, rows[at : at + 1], cut)
    assert a == pytest.approx(attention.log_probability(p, v, changed, cut), abs=1e-5) and a[0] > base[0]


def test_the_first_scored_id_sees_eight_ids():
    v = _vocabulary()
    p = attention.split(attention.start(v, 5))
    rows = np.random.default_rng(6).integers(0, attention.INPUTS, (1, attention.WINDOW)).astype(np.int32)
    ids = np.full(rows.shape, -1)
    ids[:, attention.CONTEXT] = 100
    base = attention.log_probability(p, v, rows, ids)
    for back in range(1, 9):
        other = rows.copy()
        other[:, attention.CONTEXT - back] = (other[:, attention.CONTEXT - back] + 1) % attention.INPUTS
        assert attention.CONTEXT >= back and attention.log_probability(p, v, other, ids) != base
    assert p["q"].shape[1] >= 16 and p["out"].shape[1] >= 64


def test_training_with_the_fixed_values_lowers_the_loss(documents):
    trained = [r.score for r in lm.score(documents, PATH).collect() if r.held_out]
    fresh = [r.score for r in lm.score(documents, PATH, every=10**9).collect() if r.held_out]
    assert sum(trained) > sum(fresh)


def test_probabilities_of_a_place_sum_to_one():
    v = _vocabulary()
    p = attention.split(attention.start(v, 5))
    rows = np.tile(np.random.default_rng(2).integers(0, attention.INPUTS, attention.WINDOW).astype(np.int32), (3000, 1))
    ids = np.full(rows.shape, -1)
    ids[:, attention.CONTEXT + 5] = np.arange(3000)
    assert np.exp(attention.log_probability(p, v, rows, ids)).sum() == pytest.approx(1, abs=1e-4)


def test_gradient():
    v, draw = _vocabulary(), np.random.default_rng(4)
    rows, ids, _ = attention.windows(draw.integers(0, 3000, 200), np.array([0, 90, 200]), v.inputs)
    w = attention.start(v, 1)
    g = attention.gradient(w, v, rows, ids)[1]
    for i in np.argsort(-np.abs(g))[[0, 5, 50, 300]]:
        e = np.zeros(len(w))
        e[i] = 1e-2
        slope = (attention.gradient(w + e, v, rows, ids)[0] - attention.gradient(w - e, v, rows, ids)[0]) / 2e-2
        assert slope == pytest.approx(g[i], rel=0.05, abs=1e-5)


def test_every_window_of_the_training_texts_is_trained_on(spark, documents, monkeypatch):
    """By default the stored windows hold each id of each training text once as a scored one."""
    stored, tables = lm.stored, {}

    def kept(df, name):
        tables[name] = stored(df, name)
        return tables[name]

    monkeypatch.setattr(lm, "stored", kept)
    texts = documents.select(F.coalesce("text", F.lit("")).alias("body"))
    lm.fit(texts, PATH)
    held, pieces = tables["windows"].where("ids is not null").select("ids").collect(), lm._pieces(PATH)
    scored = 0
    for row in held:
        ids = np.frombuffer(row.ids, dtype=lm._held_as(pieces)).reshape(-1, attention.WINDOW)
        scored += int((ids[:, attention.CONTEXT :] >= 0).sum())
    bodies = [words(r.body) for r in texts.collect()]
    assert scored == sum(1 + sum(len(pieces.model.encode(w)) for w in words) for words in bodies)


def _batches(texts, rows):
    whole = pa.record_batch({"draw": pa.array(range(len(texts)), pa.int64()), "body": pa.array(texts, pa.string())})
    return [whole.slice(at, rows) for at in range(0, len(texts), rows)]


def test_blocks_do_not_depend_on_the_cut_into_batches():
    texts = ["", "a" * 50, "b" * 3000, "", "c" * 10, *["d" * 90] * 40, "e" * 900]
    expected = [b.to_pydict() for b in lm._blocks(_batches(texts, len(texts)), 1000)]
    assert sum((b["body"] for b in expected), []) == texts and len(expected) > 5
    for rows in (1, 2, 7, 20):
        assert [b.to_pydict() for b in lm._blocks(_batches(texts, rows), 1000)] == expected
    assert list(lm._blocks([], 1000)) == [] and list(lm._blocks(_batches([""], 1)[0:0], 1000)) == []


def test_words_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(lm, "HELD_BYTES", 200)
    monkeypatch.setattr(lm, "HELD_COUNTS", 30)
    texts = [f"The w{i % 9} w{i} {'x ' * (i % 5)}" for i in range(100)] + ["", None]
    got, parts = Counter(), [b for b in lm._count_words(b.select(["body"]) for b in _batches(texts, 30))]
    for b in parts:
        assert b["word"].value_counts().field("counts").to_pylist() == [1] * len(b)
        for w, n in zip(b["word"].to_pylist(), b["n"].to_pylist()):
            got[w] += n
    assert got == Counter(w for t in texts for w in words(t)) and len(parts) > 2


def test_a_task_holds_the_ids_of_few_texts_at_a_time(monkeypatch):
    """What a task holds as words and ids follows HELD_BYTES, not the batch; the training blocks stay as large as before."""
    longest, split = [0], lm._split

    def seen(texts):
        longest[0] = max(longest[0], sum(len(t) for t in texts.to_pylist()))
        return split(texts)

    monkeypatch.setattr(lm, "_split", seen)
    text = "some words of a text that is not short " * 40
    texts, pieces = [text] * 3000, lm._pieces(PATH)
    vocabulary = type("", (), {"value": attention.vocabulary(np.ones(pieces.size))})
    found = list(lm._windows(PATH, vocabulary, 2, 2)(iter(_batches(texts, 2000))))
    assert longest[0] <= (1 << 20) + len(text)
    list(lm._count_words(b.select(["body"]) for b in _batches(texts, 3000)))
    assert longest[0] <= (1 << 20) + len(text)
    each = -(-(1 + sum(len(pieces.model.encode(w)) for w in words(text))) // attention.SCORED)
    n = [b["n"][0].as_py() for b in found if b["ids"][0].is_valid]
    assert sum(n) == 3000 * each and len(n) == 2 * 2


def test_python_gets_texts_and_windows_in_small_batches(spark, documents, monkeypatch):
    key, limits = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    stored, before = lm.stored, spark.conf.get(key)

    def kept(df, name):
        limits[name] = int(spark.conf.get(key))
        return stored(df, name)

    monkeypatch.setattr(lm, "stored", kept)
    lm.score(documents, PATH, every=10**9)
    assert set(limits) == {"words", "windows", "scored"} and max(limits.values()) <= 1000 and spark.conf.get(key) == before


def test_windows_are_written_in_small_pages(spark, documents, monkeypatch):
    """A task packs and unpacks one block of windows at a time, not all of its blocks as one page."""
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before, stored, files = [spark.conf.get(k) for k in keys], lm.stored, []

    def kept(df, name):
        if name == "windows":  # beside the real ones, a task's blocks as large texts give them
            path = stored(spark.range(0, 40, 1, 1).select(F.expr("cast(repeat(cast(rand() as string), 60000) as binary)").alias("ids")), "blocks").scratch
            files.extend(glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
        return stored(df, name)

    monkeypatch.setattr(lm, "stored", kept)
    lm.fit(documents.select(F.coalesce("text", F.lit("")).alias("body")), PATH)
    assert [spark.conf.get(k) for k in keys] == before
    held = pq.ParquetFile(files[0]).metadata
    pages = os.path.getsize(files[0]) - held.serialized_size - sum(
        held.row_group(g).column(0).total_compressed_size for g in range(held.num_row_groups)
    )
    assert pages > 40 * 64  # the file's index has two bounds of each page


def test_settings_come_back(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize", "parquet.page.size.row.check.min"]
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(ValueError), long_rows(spark, 2):
        assert [spark.conf.get(k) for k in keys] == ["2", "2", "1"]
        raise ValueError
    assert [spark.conf.get(k, None) for k in keys] == before


def test_a_task_gives_counts_back_in_parts_and_holds_little_text():
    longest, split, pieces = [0], lm._split, lm._pieces(PATH)

    def seen(texts):
        longest[0] = max(longest[0], sum(len(t) for t in texts.to_pylist()))
        return split(texts)

    words_ = [pieces.model.id_to_piece(i).strip("\u2581") for i in range(300, 4000)]
    draw = np.random.default_rng(0).integers(0, len(words_), (600, 400))
    texts = [" ".join(words_[i] for i in row) for row in draw]
    vocabulary = type("", (), {"value": attention.vocabulary(np.ones(pieces.size))})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lm, "_split", seen)
        m.setattr(lm, "COUNT_ROWS", 1000)
        found = [b for b in lm._windows(PATH, vocabulary, 2, 2)(iter(_batches(texts, 600))) if not b["ids"][0].is_valid]
    assert longest[0] <= lm.HELD_BYTES + max(map(len, texts))
    assert sum(map(len, found)) > 1000 >= max(map(len, found))
    cells = np.concatenate([b["cell"].to_numpy() for b in found])
    assert len(np.unique(cells)) == len(cells)
