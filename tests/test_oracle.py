"""Every registered query against its DuckDB oracle (the correctness gate),
at sf0.01, the scale of the driver's own check (CALLSHEET_TEST_SF overrides)."""

import os

import pytest

from callsheet.oracle.compare import compare, duckdb_connection
from callsheet.oracle.queries import oracle_sql
from callsheet.plans.registry import queries

SF = os.environ.get("CALLSHEET_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, con, key):
    r = compare(queries()[key](spark, SF), con, oracle_sql()[key])
    assert r["ok"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 48
    assert df.columns[0] == "cod_cli" and len(df.columns) == 25
