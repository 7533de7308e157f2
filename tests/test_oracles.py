"""Every registered lake query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from siltworks.plans import lake_queries as lake

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{DIR}/events.parquet'")
    return c


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(r[i] for i in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(lake.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = lake.QUERIES[name](spark, DIR)
    result = con.execute(lake.ORACLES[name])
    assert canon(df.columns, df.collect()) == canon([d[0] for d in result.description], result.fetchall())


def test_all_oracles_have_queries():
    assert set(lake.ORACLES) <= set(lake.QUERIES)
