"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from checks.oracle import all_oracles
from checks.queries import all_queries
from compare import assert_same

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_oracles()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, DATA), SQL[name], DATA) > 0 or name.startswith(("anomalies", "csv_sink"))


def test_the_flagship_query(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", ["mask_outliers", "anomalies", "daily_summary_by_user", "upsert_cleaned"])
def test_larger_data_where_masking_happens(spark, name):
    larger = "/root/testdata/sf0.01"
    assert assert_same(QUERIES[name](spark, larger), SQL[name], larger) > 0
