import os

import pytest
from brute import EDGE

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with extra columns named as the operators name theirs."""
    rows = [(*r, "x", 1, True, [1]) for r in EDGE]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, q string, n_words int, kept boolean, hits array<int>")


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def plain(documents):
    """(doc_id, text, lang, source) rows for brute-force versions."""
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]
