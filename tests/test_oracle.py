"""Every registered query with SQL gives the same columns, types and rows as DuckDB."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import difference


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, folder, name):
    assert difference(spark, folder, name, queries()[name], oracle_sql()[name]) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "quality", "toxic"]
    assert df.count() > 0
