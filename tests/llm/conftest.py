import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus_rows import ROWS, SCHEMA  # noqa: E402

@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, repeated rows, long texts and columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, "s", "w", "r", "c") for row in ROWS], SCHEMA).coalesce(1)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the smallest table, and the table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text").collect()], docs
