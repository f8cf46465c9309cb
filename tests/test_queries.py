"""Every registered query against its SQL on the smallest tables."""
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert found
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)


def test_entry(spark):
    assert driver.entry(spark).columns == ["cnt", "word"]


def test_every_oracle_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
