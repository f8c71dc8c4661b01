import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "citeloom-tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Run a callable under several shuffle partition counts and return all results."""
    def run(fn, counts=(1, 4, 64)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            results = []
            for count in counts:
                spark.conf.set("spark.sql.shuffle.partitions", str(count))
                results.append(fn())
            return results
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    return run


def rows(df, *cs):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*cs) if cs else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))
