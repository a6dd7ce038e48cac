import public_tokenizers
from helpers import empty, odd
from tokenizers import Tokenizer

from camlytics.llm import tokens
from camlytics.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
ODD = [
    "a<|startoftext|>b <|endoftext|>", "it's we'll x", "tab\tVT\x0bFF\x0cCR\rend", "é ́a Å̊", "ΑΣ ΑΣ.Σ", "İI ı",
    "\x1c\x85x", "<|startoftext|", "12345 ab12cd", " ", "\n\n", "語 言語　語", "'S 'Re x's",
]


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(df):
    given = df.select("doc_id", "text").collect()
    rows = tokens.count_tokens(df, PATH).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows), key=repr)
    expected = [(g.doc_id, len((g.text or "").encode()), n, n > 2048) for g, n in zip(given, library([g.text for g in given]))]
    assert got == sorted(expected, key=repr)


def test_like_the_library(spark, documents):
    check(documents)
    check(odd(spark))
    check(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"))
    assert tokens.count_tokens(empty(spark), PATH).collect() == []


def test_small_batches_and_a_full_memory(documents, monkeypatch):
    import pyarrow as pa

    given = [r.text for r in documents.limit(40).collect()]
    monkeypatch.setattr(tokens, "BATCH_BYTES", 1000)
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 50)
    assert tokens._count(PATH, pa.array(given)).to_pylist() == library(given)
