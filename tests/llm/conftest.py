from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_rows import ODD  # noqa: E402

TEXTS = "doc_id long, text string, lang string, source string, n_chars long, size string, score int, taken boolean"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    """Id and text of the small table."""
    return {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}


def rows_of(pairs):
    """Documents with nulls in every column and extra columns whose names operators use too."""
    return [(i, t, "en" if t else None, f"s{k % 3}" if k % 4 else None, None, "x", 7, None) for k, (i, t) in enumerate(pairs)]


@pytest.fixture(scope="session")
def make(spark):
    return lambda pairs: spark.createDataFrame(rows_of(pairs), TEXTS)


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return make(ODD)


@pytest.fixture(scope="session")
def empty(make, spark):
    return spark.createDataFrame([], TEXTS)
