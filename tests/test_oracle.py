"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from dimflow.plans.verify import compare

from conftest import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    if name not in ORACLES:
        assert df.count() >= 0
        return
    assert compare(df, duck, ORACLES[name]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
