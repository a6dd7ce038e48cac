import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import empty, odd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from camlytics.llm import queries, token_file
from camlytics.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(PATH)


def plain(texts):
    return [LIBRARY.encode(t or "", add_special_tokens=False).ids + [token_file.END] for t in texts]


def split(texts):
    ids, ends = token_file.encode(pa.array(texts, pa.string()), PATH)
    return [part.tolist() for part in np.split(ids, ends)[:-1]]


ODD = [
    "<|startoftext|> a", "a<|endoftext|>b <|ENDOFTEXT|>", "it's they're \"x\"!!", "é é É", "x\x1cy\x85z   q", "ǅ İ ẞ 中文 १२३",
    "", " ", None, "<|startoftext|>" * 3, "a'", "'s 'll'd", "́ ́a", "Å̀ ªº µm × ÷", "😀😀", "\x00\x01 a\x7fb", "STRAßE ÉTÉ ÿ", "a\nb\n\n'\n's",
]


def test_ids_like_the_library(texts):
    some = ODD + [t for _, t, *_ in texts]
    assert split(some) == plain(some)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aB'sé<|>́ßİ \t\n\x1c1ª!"), st.characters(exclude_categories=["Cs"])), max_size=24), max_size=6))
def test_any_text(texts):
    assert split(texts) == plain(texts)


ids_of = st.one_of(
    st.lists(st.integers(0, 3), max_size=200), st.lists(st.integers(0, 70_000), max_size=60),
    st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=6), st.integers(1, 60)).map(lambda t: t[0] * t[1]),
)


@settings(max_examples=200, deadline=None)
@given(ids_of, st.data())
def test_round_trip(ids, data):
    ids = np.array(ids, dtype=np.uint32)
    grammar = token_file.unpack(token_file.pack(token_file.compress(ids)))
    assert token_file.decompress(grammar).tolist() == ids.tolist()
    low = data.draw(st.integers(0, len(ids)))
    high = data.draw(st.integers(low, len(ids)))
    assert token_file.decompress(grammar, low, high).tolist() == ids[low:high].tolist()
    for k in range(len(grammar.left)):
        symbol = np.array([grammar.base + k], dtype=np.uint32)
        assert len(token_file._expanded(grammar, symbol)) == grammar.lengths[k]


def test_no_frequent_pair_stays():
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 20, 5000).astype(np.uint32)
    symbols = token_file.compress(ids).symbols
    left = [p for p in zip(symbols[:-1].tolist(), symbols[1:].tolist()) if p[0] != p[1]]
    assert max(left.count(p) for p in set(left)) < 2 * token_file.LEAST
    assert len(token_file.compress(np.zeros(1 << 16, np.uint32)).symbols) < 10


def test_not_a_block():
    with pytest.raises(ValueError):
        token_file.unpack(b"0" * 40)


def expected(rows):
    """Rows in file order with the ids before each, by the library."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode())))
    out, start = [], 0
    for (name, _), ids in zip(rows, plain([t for _, t in rows])):
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def in_order(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_query_like_the_library(spark, tiny, texts):
    got = queries.op12_token_file(spark, tiny)
    assert in_order(got) == expected([(i, t) for i, t, *_ in texts])
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"]


@pytest.mark.parametrize("block", [7, 1000, token_file.BLOCK])
def test_any_block_size(spark, documents, block):
    docs = documents.where("doc_id < 40") if block < 1000 else documents
    if block < 1000:
        docs = docs.withColumn("text", F.substring("text", 1, 300))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    folder = scratch_path(spark, "blocks")
    token_file.write(docs, folder, PATH, block=block)
    assert in_order(token_file._documents(token_file._blocks(spark, folder), "ids_crc32")) == expected(rows)
    whole = {r.doc_id: r for r in token_file.read(spark, folder).collect()}
    assert {i: zlib.crc32(r.ids) for i, r in whole.items()} == {r[0]: r[3] for r in expected(rows)}
    asked = spark.createDataFrame([(3,), (17,), (17,), (None,), (10**9,)], "x long")
    some = {r.doc_id: r for r in token_file.lookup(spark, folder, asked).collect()}
    assert some == {i: whole[i] for i in (3, 17)}


def test_odd_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    folder = scratch_path(spark, "odd")
    token_file.write(odd(spark), folder, PATH, block=5000)
    assert in_order(token_file._documents(token_file._blocks(spark, folder), "ids_crc32")) == expected(rows)
    nulls = token_file.lookup(spark, folder, spark.createDataFrame([(None,)], "x long"))
    assert nulls.count() == sum(i is None for i, _ in rows)
    assert token_file.report(empty(spark), PATH).count() == 0
