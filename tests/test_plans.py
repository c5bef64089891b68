"""The shape of the physical plans: what is shuffled, broadcast and read."""

import re

import pytest
from pyspark.sql import functions as F

from dimhistory import Staging, initial_load, merge_history
from dimhistory.operators import numbering, partitioning
from dimhistory.operators.changes import detect_changes
from dimhistory.operators.screening import duplicate_keys, latest_per_key
from util import AB_SPEC, D0, D1


@pytest.fixture()
def staged_plans(monkeypatch):
    """Plans of all staged tables by name."""
    plans = {}
    original = Staging.write

    def remember(self, df, name, **options):
        plans[name] = plan(df)
        return original(self, df, name, **options)

    monkeypatch.setattr(Staging, "write", remember)
    return plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


@pytest.fixture()
def pair(spark, staging):
    rows = spark.range(2000).select(
        F.col("id").alias("k"), F.lit("x").alias("a"), (F.col("id") % 3).cast("int").alias("b")
    )
    history = staging.write(initial_load(rows, AB_SPEC, D0, staging), "h")
    changed = F.when(F.col("k") % 9 == 0, 7).otherwise(F.col("b"))
    # stored, since a generated range counts as partitioned by key already
    return history, staging.write(rows.where("k % 10 <> 1").withColumn("b", changed), "s")


@pytest.fixture()
def many(monkeypatch, spark):
    """Plans as for more rows than one task numbers or a broadcast may hold."""
    monkeypatch.setattr(numbering, "ROWS_ALONE", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_merge_joins_once_and_never_uses_one_task_for_rows(pair, staged_plans, many):
    result = plan(merge_history(*pair, AB_SPEC, D1))
    compared = staged_plans["compared"]
    assert compared.count("SortMergeJoin") == 1 and "FullOuter" in compared
    # one shuffle per side, and copies are counted in the partitions and the order of the join
    assert exchanges(compared) == ["hashpartitioning", "hashpartitioning"]
    assert len(re.findall(r"\bSort \[", compared)) == 2
    # unchanged rows come out of the comparison: nothing joins or shuffles them again
    assert "hashpartitioning" not in result.split("dimhistory_kind")[0]
    assert "Anti" not in result and "FullOuter" not in result
    for text in (result, *staged_plans.values()):
        assert "SinglePartition" not in text
        assert "Python" not in text and "Arrow" not in text
        assert "Nested" not in text and "Cartesian" not in text


def test_partitions_follow_the_rows(pair, staged_plans, monkeypatch):
    history, snapshot = pair
    want = sorted(merge_history(history, snapshot, AB_SPEC, D1).collect())
    monkeypatch.setattr(partitioning, "ROWS_PER_TASK", 100)
    latest = {"on_duplicate": "latest", "order_by": "b"}
    for options in ({}, latest):
        assert sorted(merge_history(history, snapshot, AB_SPEC, D1, **options).collect()) == want
        compared = staged_plans["compared"]
        assert exchanges(compared) == ["hashpartitioning", "hashpartitioning"]
        assert len(re.findall(r"hashpartitioning\(k#\d+L, 21\), REPARTITION_BY_NUM", compared)) == 2


def test_positions_are_sorted_once(spark, staging, staged_plans, many):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("wide").alias("w"))
    result = initial_load(df.withColumn("b", F.lit(1)), AB_SPEC.__class__(["k"], ["w"]), D0, staging)
    # a broadcast of one number per range
    assert exchanges(plan(result)) == ["HashedRelationBroadcastMode"]
    assert "BroadcastHashJoin" in plan(result) and "LocalTableScan [__range" in plan(result)
    positions = staged_plans["positions"]
    assert exchanges(positions) == ["rangepartitioning"]
    assert len(re.findall(r"\bSort \[", positions)) == 1
    # whole rows are written in their order, so nothing but a number per range is joined to them
    assert "w:string" in positions


def test_active_filter_reaches_the_scan(pair):
    history, snapshot = pair
    text = plan(detect_changes(history, snapshot, AB_SPEC))
    assert "EqualTo(current_flag,true)" in text


def test_only_needed_columns_are_read(pair):
    history, _ = pair
    text = plan(history.select("sk"))
    assert "ReadSchema: struct<sk:bigint>" in text


def test_reductions_start_before_the_shuffle(pair):
    history, _ = pair
    for df in (duplicate_keys(history, ["k"]), latest_per_key(history, ["k"], "b")):
        text = plan(df)
        assert text.count("Aggregate(") >= 2 and "partial_" in text
        assert exchanges(text) == ["hashpartitioning"]
