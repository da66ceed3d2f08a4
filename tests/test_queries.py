"""Every registered query against its SQL text, on the smallest tables."""

import duckdb
import pytest

from hourgrid.queries import oracle_sql, queries
from tools.check_queries import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_sql_text_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name].replace("/root/testdata/sf0.01", sf_dir))
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
