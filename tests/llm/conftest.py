import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def documents(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """(doc_id, text, lang, source) of the smallest table."""
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]
