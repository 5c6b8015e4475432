"""Spark plans vs their DuckDB oracle text (the driver's correctness gate, run locally).

Every registered query of the reference's operators runs at sf0.001.
"""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from ledgerlens import catalog
from tools.check_oracle import TABLES, compare

ORACLE = entry.oracle_sql()
# The training-data queries are held against theirs in tests/llm.
NAMES = sorted(catalog.oracle())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    res = compare(df.columns, [tuple(r) for r in df.collect()],
                  [d[0] for d in cur.description], cur.fetchall())
    assert res == "EXACT", res


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["txn_year_month", "gpv", "prev_month_gpv", "mom_growth_pct"]
    assert df.count() > 0
