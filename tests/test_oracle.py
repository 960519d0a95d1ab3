"""Every registered query against its DuckDB oracle (rows-only when none)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from oracle_check import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    if name not in ORACLE:
        assert df.count() > 0
        return
    ok, msg = compare(df, ORACLE[name], con)
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "price_median" in df.columns


def test_auc_above_chance(spark):
    row = QUERIES["high_spend_auc"](spark, SF_ORACLE).first()
    assert row.auc > 0.5
