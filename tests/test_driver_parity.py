"""Every registered query against its DuckDB oracle over whole tables at
sf0.001 (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tierline.plans import driver
from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = driver.QUERIES
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], ORACLE[name], con)
    assert r["ok"], r.get("detail")
    assert not r["type_mismatches"], r["type_mismatches"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["user_id", "event_type", "season"]
    assert df.count() > 0
