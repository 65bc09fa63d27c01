"""Every registered query at the smallest scale, next to its SQL where there is one."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

from fraudlake import config  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{check.source(sf, t)}')")
    return c


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(name, spark, sf, con, monkeypatch):
    # the registered queries fit all 300 boosted trees (about 4 minutes a fit); here they are run with 5
    monkeypatch.setitem(config.GBT_PARAMS, "maxIter", 5)
    df = entry.queries()[name](spark, sf)
    assert check.problems(df, con, entry.oracle_sql().get(name)) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_all_checks_belong_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
