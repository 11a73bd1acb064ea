"""Every registered query against its DuckDB twin at sf0.001 (the driver's check runs at sf0.01)."""

import os

import pytest

from tests.oracle_check import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _keys():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from __spark_entry__ import oracle_sql, queries
    ok, msg, _ = compare(spark, con, key, queries()[key], oracle_sql()[key], SF)
    assert ok, msg


def test_rows_only_queries_run(spark):
    from __spark_entry__ import oracle_sql, queries
    for key in sorted(set(queries()) - set(oracle_sql())):
        assert queries()[key](spark, SF).count() >= 0


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and "sentiment_label" in df.columns
