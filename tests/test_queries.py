"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from checks.source_queries import TABLES  # noqa: E402

SF_DIR = entry.SMOKE_DIR

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(r) for r in frame.where(frame.notna(), None).itertuples(index=False, name=None))


# The optional operators for training text have tests of their own.
OPTIONAL = {n for m in entry.MODULES if "llm" in m.__name__ or m.__name__ == "corpus_pipeline" for n in m.QUERIES}
NAMES = [n for n in entry.queries() if n not in OPTIONAL]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    expected = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_entry_gives_changes(spark):
    # 36 + 198 + 36, 61 + 160 + 61 and 5 + 44 + 152 changes of the three profiles
    assert entry.entry(spark).count() == 753


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())
