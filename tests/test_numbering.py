import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimhistory.errors import DuplicateKeys
from dimhistory.operators import numbering
from dimhistory.operators.numbering import (
    assign_surrogate_keys,
    dense_row_number,
    max_surrogate_key,
)


def test_equals_the_global_window(spark, staging):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    got = assign_surrogate_keys(df, ["k"], "sk", staging, start=100)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("bigint") + 100)
    assert sorted(got.collect()) == sorted(want.collect())
    assert dict(got.dtypes)["sk"] == "bigint"


def test_composite_text_keys_with_awkward_names(spark, staging):
    df = spark.range(300).select(
        (F.col("id") % 7).cast("string").alias("a (x)"), (-F.col("id")).alias("b.c")
    )
    got = assign_surrogate_keys(df, ["a (x)", "b.c"], "sk", staging).collect()
    ordered = sorted(got, key=lambda r: (r[0], r[1]))
    assert [r["sk"] for r in ordered] == list(range(1, 301))


def test_repeated_order_values_get_dense_numbers(spark, staging):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    rows = dense_row_number(df, ["k"], "n", staging).collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 901))
    assert [r["k"] for r in sorted(rows, key=lambda r: r["n"])] == sorted(r["k"] for r in rows)


def test_a_hot_order_value_is_spread_over_ranges(spark, staging):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id"
    )
    # small ranges would be merged into one here
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        dense_row_number(df, ["k"], "n", staging)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 3)
    positions = [
        spark.read.parquet(f"{staging.path}/{name}") for name in staged(staging, "positions")
    ]
    hot = positions[0].where("k = 5").groupBy(F.shiftright("__position", 33)).count()
    # a third of the rows takes about a third of the nine ranges
    assert hot.count() >= 3


def test_ranges_follow_the_number_of_rows(spark, staging, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 1000)
    monkeypatch.setattr(numbering, "ROWS_ALONE", 0)
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sk", staging, rows=5000)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())
    position = F.shiftright("__position", 33)
    placed = spark.read.parquet(f"{staging.path}/{staged(staging, 'positions')[0]}")
    assert placed.select(position).distinct().count() == 7


def staged(staging, prefix):
    from dimhistory.sources import files

    return [n for n in files.list_names(staging.spark, staging.path) if n.startswith(prefix)]


@pytest.mark.parametrize("rows", [None, 4])
def test_null_keys_are_numbered_first(spark, staging, rows):
    df = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b"), (3, None)], "k int, v string")
    got = {r["v"]: r["sk"] for r in assign_surrogate_keys(df, ["k"], "sk", staging, rows=rows).collect()}
    assert got == {"n": 1, "a": 2, "b": 3, None: 4}
    with pytest.raises(DuplicateKeys):
        assign_surrogate_keys(df.union(df.where("k IS NULL")), ["k"], "sk", staging, rows=rows)


def test_repeated_keys_are_refused(spark, staging):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    with pytest.raises(DuplicateKeys, match="2"):
        assign_surrogate_keys(df, ["k"], "sk", staging)


def test_empty_frames(spark, staging):
    empty = spark.createDataFrame([], "k int, v string")
    assert assign_surrogate_keys(empty, ["k"], "sk", staging).collect() == []
    assert dense_row_number(empty, ["k"], "n", staging).collect() == []
    assert max_surrogate_key(empty.withColumnRenamed("k", "sk"), "sk").first()["max_sk"] == 0


def test_nulls_come_first_without_a_unique_order(spark, staging):
    df = spark.createDataFrame([(3,), (None,), (1,)], "k int")
    rows = {r["k"]: r["n"] for r in dense_row_number(df, ["k"], "n", staging).collect()}
    assert rows == {None: 1, 1: 2, 3: 3}
