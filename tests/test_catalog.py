"""Every catalogue query against the same query in SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from mastline.plans import catalog
from mastline.plans.catalog import CATALOG

FOLDER = os.environ.get("MASTLINE_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{FOLDER}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(CATALOG) <= set(contract.queries())
    assert set(CATALOG) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CATALOG)
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    answer = duck.sql(contract.oracle_sql()[name])
    assert sorted(answer.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(map(repr, answer.project(quoted).fetchall()))
    assert got == want
    assert got


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_places_without_one_task_for_all_rows(spark):
    placed = catalog._with_place(spark, spark.range(0, 1000, 1, 7).where("id < 300 or id > 500").withColumnRenamed("id", "x"))
    rows = [(r.place, r.x) for r in placed.orderBy("x").collect()]
    assert rows == list(enumerate([x for x in range(1000) if x < 300 or x > 500], 1))
    assert "row_number" not in placed._jdf.queryExecution().executedPlan().toString()
    assert catalog._with_place(spark, spark.range(0)).count() == 0
