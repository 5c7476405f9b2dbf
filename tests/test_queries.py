import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, differences

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, small, con, name):
    got = entry.queries()[name](spark, small).toPandas()
    assert len(got)
    if name in SQL:
        assert differences(got, con.execute(SQL[name]).df()) == ""


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
