"""Every query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, compare
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


# Nodes that run Python on rows, pair all rows with all, or come from the driver.
UNWANTED = ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    problems, _ = compare(df, db.execute(contract.oracle_sql()[name]))
    assert not problems
