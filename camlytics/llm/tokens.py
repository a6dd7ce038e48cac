"""Token counts of a published tokenizer.

Texts are cut at ASCII white space, which this kind of tokenizer drops: no
token, normalisation or special string reaches across it, so the counts of the
pieces add up to the count of the text. Each batch of about ``BATCH_BYTES``
keeps its distinct pieces once, and only pieces that the worker has not met
before are encoded; lengths alone go back to Spark.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.llm.common import slices

BATCH_BYTES = 4 << 20
KNOWN_PIECES = 400_000
ENCODE_ROWS = 4096

_LOADED: dict[str, tuple] = {}


def _loaded(path: str):
    """The tokenizer and the lengths of the pieces met so far; one of each per Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        _LOADED[path] = (tokenizer, {})
    return _LOADED[path]


def _lengths(path: str, pieces: list[str]) -> np.ndarray:
    tokenizer, known = _loaded(path)
    if len(known) > KNOWN_PIECES:
        known.clear()
    new = [p for p in pieces if p not in known]
    for at in range(0, len(new), ENCODE_ROWS):
        part = new[at : at + ENCODE_ROWS]
        for piece, encoding in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
            known[piece] = len(encoding)
    return np.fromiter((known[p] for p in pieces), dtype=np.int64, count=len(pieces))


def _count(path: str, texts: pa.Array) -> pa.Array:
    out = []
    for part in slices(texts, BATCH_BYTES):
        pieces = pc.ascii_split_whitespace(part.fill_null(""))
        flat = pieces.flatten().dictionary_encode()
        lengths = _lengths(path, flat.dictionary.to_pylist())
        each = np.concatenate([[0], np.cumsum(lengths[flat.indices.to_numpy()])]) if len(flat) else np.zeros(1, np.int64)
        at = pieces.offsets.to_numpy()
        at = at - at[0]
        out.append(each[at[1:]] - each[at[:-1]])
    return pa.array(np.concatenate(out) if out else [], type=pa.int64())


def token_count(text: Column, path: str) -> Column:
    """Tokens of each text, without special tokens added; 0 for null and for empty text."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return _count(path, texts)

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row.

    Bytes are UTF-8. Null texts count as empty: 0 bytes, 0 tokens. Repeated
    rows, null ids and ids of any type are kept as they are; other columns are
    not read. ``path`` names a file that every executor has.
    """
    counted = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
