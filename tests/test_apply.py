import pytest

from dimhistory.errors import DuplicateKeys
from dimhistory.operators import apply
from dimhistory.operators.apply import apply_changes, keyed_insert, keyed_update, union_by_name
from dimhistory.operators.changes import is_empty
from util import ab


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_update_sets_only_the_given_columns_of_matching_rows(spark):
    target = ab(spark, (1, "x", 1), (2, "y", 2), (3, None, 3))
    change = spark.createDataFrame([(2, None), (3, "z"), (9, "q")], "k long, a string")
    assert rows(keyed_update(target, change, ["k"])) == [(1, "x", 1), (2, None, 2), (3, "z", 3)]


def test_insert_refuses_known_and_repeated_keys(spark):
    target = ab(spark, (1, "x", 1))
    assert rows(keyed_insert(target, ab(spark, (2, "y", 2)), ["k"])) == [(1, "x", 1), (2, "y", 2)]
    with pytest.raises(DuplicateKeys):
        keyed_insert(target, ab(spark, (1, "y", 2)), ["k"])
    with pytest.raises(DuplicateKeys):
        keyed_insert(target, ab(spark, (2, "y", 2), (2, "z", 2)), ["k"])


def test_a_bloom_filter_reaches_the_scan_of_the_target(spark, staging, monkeypatch):
    target = staging.write(spark.range(20000).selectExpr("id AS k", "string(id) AS a", "1 AS b"), "target")
    new = spark.createDataFrame([(k, "n", 1) for k in range(20000, 20200)], "k long, a string, b int")
    for keys in (["k"], ["k", "a"]):
        found = apply.rows_among(target, new, keys)
        text = found._jdf.queryExecution().executedPlan().toString()
        above_scan = text.split("FileScan")[0].rsplit("Filter", 1)[1]
        assert "getbit" in above_scan and "LeftSemi" in text.split("FileScan")[0]
        # nearly all rows of the target are dropped before they are joined
        near = target.where(apply.may_be_among(new, keys))
        assert near.count() < 400 and found.count() == 0
    some = new.union(spark.createDataFrame([(5, "5", 1), (None, "7", 1)], new.schema))
    assert [r["k"] for r in apply.rows_among(target, some, ["k"]).collect()] == [5]
    # keys of another type, and too many keys, are joined without a filter
    other = some.selectExpr("int(k) AS k")
    assert [r["k"] for r in apply.rows_among(target, other, ["k"]).collect()] == [5]
    monkeypatch.setattr(apply, "MOST_BITS", 64)
    assert apply.may_be_among(new, ["k"]) is None
    assert [r["k"] for r in apply.rows_among(target, some, ["k"]).collect()] == [5]


def test_change_types(spark):
    target = ab(spark, (1, "x", 1))
    assert len(rows(apply_changes(target, ab(spark, (2, "y", 2)), "INSERT", ["k"]))) == 2
    assert rows(apply_changes(target, ab(spark, (1, "y", 2)), "UPDATE", ["k"])) == [(1, "y", 2)]
    with pytest.raises(ValueError):
        apply_changes(target, target, "DELETE", ["k"])


def test_union_goes_by_name_and_keeps_duplicates(spark):
    df = ab(spark, (1, "x", 1))
    assert rows(union_by_name(df, df.select("b", "a", "k"), df)) == [(1, "x", 1)] * 3
    with pytest.raises(Exception, match="Cannot resolve"):
        union_by_name(df, df.drop("b"))


def test_is_empty(spark):
    assert is_empty(ab(spark)) and not is_empty(ab(spark, (1, "x", 1)))
