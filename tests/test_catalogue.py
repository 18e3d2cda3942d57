"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# Rows through Python, all pairs, and whole tables sent to every task.
UNWANTED = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop", "BroadcastExchange")


# What is wanted after all: Spark's own broadcast of what it finds to be small (one row per part, a list of keys), and the
# function of the user's.
WANTED = {"dense_keys": "BroadcastExchange", "keyed_lookup": "BroadcastExchange", "datepart_user_function": "EvalPython"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_a_check():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, oracle, name):
    result = entry_points.queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in UNWANTED if step in plan and step != WANTED.get(name)]
    expected = oracle.sql(entry_points.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert rows_of(result.collect(), result.columns) == rows_of(expected.fetchall(), expected.columns)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    def plan(name):
        return entry_points.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

    assert "EqualTo(event_type,click)" in plan("module_filter")
    assert "ReadSchema: struct<event_type:string,value:double>" in plan("my_average_grouped")
    assert "datepart#" in plan("one_date_partition").split("PartitionFilters: [")[1].split("]")[0]


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["event_type", "avg_value"]
    assert result.count() == 5
