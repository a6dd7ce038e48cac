import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, empty, odd, shingles

import corpus_pipeline
from camlytics.llm import decontaminate, language, mixing
from camlytics.llm.common import stored


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def steps(spark, documents, tiny):
    """The output of every stage over the smallest table."""
    out, docs = {}, documents
    for name, apply in corpus_pipeline.STAGES:
        docs = out[name] = stored(apply(spark, docs, tiny), name)
    return out


def test_stages_keep_the_columns(steps, documents):
    assert list(steps) == ["language_id", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    for name in list(steps)[:-1]:
        assert steps[name].schema == documents.schema


def test_each_stage_like_plain_python(spark, steps, documents, tiny):
    found = {r.doc_id: r for r in language.language_of(documents).collect()}
    rows = {r.doc_id: r for r in documents.collect()}
    kept = {i for i in rows if found[i].accepted}
    assert {r.doc_id for r in steps["language_id"].collect()} == kept
    roots = components({i: shingles(rows[i].text) for i in kept})
    kept = set(roots.values())
    assert sorted(r.doc_id for r in steps["ngram_jaccard"].collect()) == sorted(kept)
    items = [decontaminate._words(pa.array([r.text])).hashes for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]

    def leaks(text):
        w = decontaminate._words(pa.array([text])).hashes
        return any(
            len(np.intersect1d(w, item)) * 2 >= len(set(item.tolist()))
            and decontaminate.align(item, w)[0] >= decontaminate.THRESHOLD * decontaminate.MATCH * len(item)
            for item in items
        )

    kept = {i for i in kept if not leaks(rows[i].text)}
    assert sorted(r.doc_id for r in steps["decontamination"].collect()) == sorted(kept)
    copies = Counter({r.doc_id: r.copies for r in mixing.mix(documents.where(documents.doc_id.isin(sorted(kept)))).collect()})
    assert Counter(r.doc_id for r in steps["mixing"].collect()) == +copies
    last = steps["sharding"].collect()
    assert Counter(r.doc_id for r in last) == +copies
    assert all(r.text_crc32 == zlib.crc32(rows[r.doc_id].text.encode()) for r in last)


def test_run(spark, steps, tiny):
    assert sorted(corpus_pipeline.run(spark, tiny).collect(), key=repr) == sorted(steps["sharding"].collect(), key=repr)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_and_empty_tables(spark, tiny, name):
    got = stored(stage(name)(spark, odd(spark), tiny), name)
    if name != "sharding":
        assert got.columns == odd(spark).columns
    assert got.count() > 0
    assert stored(stage(name)(spark, empty(spark), tiny), name).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert "camlytics.llm" in sys.modules
