"""Every registered query against its oracle SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from pressledger.plans import all_queries
from tools.check import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
REGISTERED = all_queries()
QUERIES = {name: item.build for name, item in REGISTERED.items()}
ORACLES = {name: item.sql for name, item in REGISTERED.items() if item.sql}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name,column", [("change_detect", "text"), ("plan_diff", "text"), ("partition_fingerprint", "text"), ("snapshot_manifest", "html"),
                                         ("readback", "html")])
def test_large_columns_are_read_once(spark, name, column):
    """What a plan reads after its pins must not be the large column again; a plan without pins reads it once."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"{column}#") == 0 or plan.count("parquet") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    wanted = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(wanted.fetchall(), wanted.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cycle_id", "category", "candidate_id", "score", "group_rank", "emphasis"]
    assert df.count() > 0


def test_top_k_is_pruned_before_the_shuffle(spark):
    plan = QUERIES["quota_selection"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "ReadSchema" in plan


def test_window_filter_reaches_the_scan(spark):
    plan = QUERIES["daily_window"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [isnotnull(ts" in plan
    # only the columns asked for are read
    assert "props" not in plan
