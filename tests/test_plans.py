"""Shapes of plans: no Python in the queries, pruned columns and pushed filters at the scan, broadcasts only of small tables."""

import re

import pytest
from pyspark.sql import functions as F

from turnloom.operators import chat, select
from turnloom.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q01_role_distribution", "q04_merge_alternate", "q07_chunks", "q09_quality", "q13_outcome_score", "q23b_decisions", "q25_scrub", "q29_extract_sessions", "q34_snapshots"])
def test_queries_stay_in_the_jvm(spark, sf_dir, name):
    assert not re.search("Python|Pandas|ArrowEval", plan(QUERIES[name](spark, sf_dir)))


def test_scans_read_only_what_they_need(spark, sf_dir):
    assert "ReadSchema: struct<role:string>" in plan(QUERIES["q01_role_distribution"](spark, sf_dir))
    text = plan(QUERIES["q27_preference_pairs"](spark, sf_dir))
    assert "PushedFilters: [In(event_type, [error,purchase])" in text and "props" not in text.split("ReadSchema")[1]


def test_no_cartesian_products(spark, sf_dir):
    for name in QUERIES:
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(QUERIES[name](spark, sf_dir))), name


def test_prompts_are_broadcast_and_first_rows_combined(spark):
    rows, prompts = spark.createDataFrame([("a",)], "role string"), spark.createDataFrame([("a", "p")], "role string, prompt string")
    assert "BroadcastHashJoin" in plan(chat.with_prompts(rows, prompts))
    first = plan(select.keep_first(spark.range(9).withColumn("k", F.col("id") % 3), F.col("k"), "id"))
    assert "partial_min" in first and "Window" not in first


def test_many_prompts_are_joined_and_a_repeated_role_makes_no_rows(spark, monkeypatch):
    rows, prompts = spark.createDataFrame([("a",), ("b",)], "role string"), spark.createDataFrame([("a", "q"), ("a", "p")], "role string, prompt string")
    few = sorted(map(tuple, chat.with_prompts(rows, prompts, "d").collect()))
    monkeypatch.setattr(chat, "FEW", 1)
    assert sorted(map(tuple, chat.with_prompts(rows, prompts, "d").collect())) == few == [("a", "p"), ("b", "d")]
