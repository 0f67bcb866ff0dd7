"""Every query with SQL agrees with DuckDB; queries without SQL give rows."""

import pytest

import __spark_entry__ as spark_entry
from stockyard.plans.learning import SLOW
from tests.check import compare


@pytest.mark.parametrize("name", sorted(set(spark_entry.oracle_sql()) - set(SLOW)))  # those fit hundreds of trees
def test_matches_sql(spark, duck, sf, name):
    assert compare(spark, duck, name, sf) is None


def test_entry_has_rows(spark):
    rows = spark_entry.entry(spark).collect()
    assert len(rows) == 30 and sum(r["txn_count"] for r in rows) == 6000


def test_oracles_belong_to_queries():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
