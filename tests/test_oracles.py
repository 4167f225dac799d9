"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import DATA
from check_oracles import compare


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_oracle(spark, name):
    ok, note = compare(spark, DATA, name)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["grade", "customers", "share", "revenue", "revenue_per_customer"]
    assert df.count() > 0
