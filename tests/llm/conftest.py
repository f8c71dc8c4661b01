import os

import pytest

from tests.llm.rows import tricky_rows

SMALL = "/root/testdata/sf0.001"
EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start bigint, n_words string, text_hash string, items bigint, node bigint, deleted string"


@pytest.fixture(scope="session")
def tricky(spark):
    """The tricky rows with columns whose names the operators use themselves, over several partitions."""
    rows = [(d, t, ["en", None, "fr"][k % 3], "s", 1, 5, "x", "y", 7, 8, "z") for k, (d, t) in enumerate(tricky_rows())]
    return spark.createDataFrame(rows, EXTRA).repartition(5, "doc_id")


@pytest.fixture(scope="session")
def repeated(spark):
    """Rows that repeat an id, with the same and with another text, and rows without an id."""
    rows = tricky_rows()
    more = [rows[0], rows[0], (1, rows[2][1]), (None, rows[0][1]), (None, rows[0][1]), (None, None), rows[30]]
    return spark.createDataFrame([(d, t, None, "s", 1, 5, "x", "y", 7, 8, "z") for d, t in rows + more], EXTRA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], EXTRA)


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("test tables not present")
    return spark.read.parquet(f"{SMALL}/documents.parquet")
