import datetime as dt

import pytest

from dimhistory import functions as fn


def test_normalize_names():
    assert fn.normalize_names([" CustomerID ", "Annual_Income_(k$)"]) == [
        "customerid",
        "annual_income_(k$)",
    ]


@pytest.mark.parametrize("names", [["a", " "], ["a", ""], ["a", " A"]])
def test_normalize_names_refuses_blank_and_clashing(names):
    with pytest.raises(ValueError):
        fn.normalize_names(names)


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], [" CustomerID ", "Annual_Income_(K$)"])
    assert fn.normalize_columns(df).columns == ["customerid", "annual_income_(k$)"]


def test_suffixes_touch_only_the_end(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["x_history_y", "x", "annual_income_(k$)"])
    long = fn.append_suffix(df, "_history")
    assert long.columns == ["x_history_y_history", "x_history", "annual_income_(k$)_history"]
    assert fn.strip_suffix(long, "_history").columns == df.columns


def test_fingerprint_ignores_nulls_and_separators(spark):
    df = spark.createDataFrame(
        [(1, 23, None), (12, 3, ""), (1, 24, None)], "a int, b int, `c.(d)` string"
    )
    rows = fn.with_fingerprint(df, df.columns).collect()
    assert rows[0].hash_md5 == rows[1].hash_md5 != rows[2].hash_md5


def test_fingerprint_of_no_columns_is_one_constant(spark):
    df = fn.with_fingerprint(spark.range(3), [])
    # md5 of the text "1"
    assert {r.hash_md5 for r in df.collect()} == {"c4ca4238a0b923820dcc509a6f75849b"}


def test_project_constants_and_dates(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c"])
    assert fn.project(df, ["c", "a.b"]).columns == ["c", "a.b"]
    df = fn.with_constants(df, {"flag": True})
    df = fn.stamp_date(df, dt.date(2024, 2, 29), "from", "until")
    assert dict(df.dtypes) | {} == {
        "a.b": "bigint", "c": "bigint", "flag": "boolean", "from": "date", "until": "date",
    }
    shown = fn.format_date(df, "from", "dd.MM.yyyy").first()
    assert shown["from"] == "29.02.2024" and shown["until"] == dt.date(2024, 2, 29)
