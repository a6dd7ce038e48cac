import zlib

import numpy as np
import pytest
from helpers import empty, odd
from pyspark.sql import functions as F

from camlytics.llm import language


def test_held_out_rows_are_right(documents, texts):
    rows = {r.doc_id: r for r in language.language_of(documents).collect()}
    truth = {i: g for i, _, g, _ in texts}
    assert rows.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out]
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert np.mean([r.accepted for r in rows.values()]) >= 0.99


def test_probabilities_of_a_context_sum_to_one(documents):
    model = language.fit(documents, pieces=200)
    letters = np.unique(np.concatenate([language._codes(r.text) for r in documents.limit(100).collect()])).astype(np.uint64)
    for context in ("the", "zzz", " de"):
        h = [np.uint64(ord(c)) for c in context]
        packed = (h[0] << np.uint64(48)) | (h[1] << np.uint64(32)) | (h[2] << np.uint64(16))
        seen = model.grams[0].keys
        total = np.zeros(len(model.languages))
        for c in letters:
            total += np.exp(_probability(model, packed | c))
        # What is left belongs to characters never met.
        assert (total <= 1 + 1e-5).all() and (total > 0.9).all()
        assert len(seen) <= len(letters) + 1


def _probability(model, key):
    out, key = np.zeros(len(model.languages)), np.array([key], dtype=np.uint64)
    for n in range(language.ORDER, 0, -1):
        part = key & language._MASK[n]
        at = model.grams[n - 1].find(part)[0]
        if at >= 0:
            return out + model.grams[n - 1].rows[at]
        if n == 1:
            return out + model.floor
        at = model.backoffs[n - 2].find(part >> np.uint64(16))[0]
        if at >= 0:
            out = out + model.backoffs[n - 2].rows[at]
    return out


def test_other_scripts_are_rejected(spark, documents):
    model = language.fit(documents)
    texts = ["语言识别系统的测试文本内容" * 10, "съешь же ещё этих мягких французских булок " * 5, "qzx xqz zzqx qqxz " * 20]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.x.accepted for r in df.select(language.identify(df, model).alias("x")).collect()] == [False] * 3


def test_odd_rows(spark):
    rows = language.language_of(odd(spark)).collect()
    assert len(rows) == odd(spark).count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (4, 5, 6, 9):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].accepted) == ("und", 0.0, False)
    assert by_id[13].lang_pred != "und"
    assert language.language_of(empty(spark)).collect() == []
    none = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.language_of(none).collect()} == {"und"}
    assert language.accepted(odd(spark)).columns == odd(spark).columns


def test_long_texts_are_scored_in_chunks(spark, documents, monkeypatch):
    model = language.fit(documents)
    text = " ".join(r.text for r in documents.where("lang = 'de'").limit(30).collect())
    whole = language._scores(model, [text])
    monkeypatch.setattr(language, "CHUNK", 5000)
    sums, lengths = language._scores(model, [text])
    assert lengths[0] == pytest.approx(whole[1][0], rel=0.01) and sums[0].argmax() == whole[0][0].argmax()
    np.testing.assert_allclose(sums, whole[0], rtol=0.01)


def test_training_ignores_what_is_held_out(spark, documents):
    changed = documents.withColumn("lang", F.when(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), "zz").otherwise(F.col("lang")))
    a = sorted(tuple(r) for r in language.language_of(documents).collect())
    assert sorted(tuple(r) for r in language.language_of(changed).collect()) == a
