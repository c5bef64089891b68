import pytest
from pyspark.sql import functions as F

from dimhistory import accept_snapshot
from dimhistory.errors import CorruptHistory, DuplicateKeys, SchemaMismatch
from dimhistory.operators.screening import (
    Profile,
    _same_number,
    _written_number,
    duplicate_keys,
    latest_per_key,
    profile,
    screen_once,
    screen_snapshot,
    usable_keys,
)
from util import AB, AB_SPEC, D0, END, ab, ab_history


def test_types_are_converted_and_bad_values_rejected(spark):
    text = spark.createDataFrame(
        [("1", "x", "19"), ("2", "y", "n/a"), (None, "z", "3"), ("4", None, None)],
        "k string, a string, b string",
    )
    accepted, rejected = screen_snapshot(text, AB, ["k"])
    assert accepted.schema == AB
    assert sorted(tuple(r) for r in accepted.collect()) == [(1, "x", 19), (4, None, None)]
    assert {(r["a"], r["b"], r["reject_reason"]) for r in rejected.collect()} == {
        ("y", "n/a", "bad value: b"),
        ("z", "3", "null key: k"),
    }


def test_fractions_do_not_become_integers_silently(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "x", 2.5), (3, "x", 1e12)], "k long, a string, b double")
    accepted, rejected = screen_snapshot(df, AB, ["k"])
    assert [r["k"] for r in accepted.collect()] == [1]
    assert sorted(r["k"] for r in rejected.collect()) == [2, 3]


@pytest.mark.parametrize("schema", ["k long, a string", "k long, a string, b int, c int"])
def test_columns_must_be_the_history_columns(spark, schema):
    with pytest.raises(SchemaMismatch):
        screen_snapshot(spark.createDataFrame([], schema), AB, ["k"])


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, "new"), (2, None, "b"), (2, None, "c"), (3, 1, None)],
        "k int, seen int, v string",
    )
    got = latest_per_key(df, ["k"], "seen")
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, 9, "new"), (2, None, "c"), (3, 1, None)]


def test_duplicate_policy(spark):
    rows = ab(spark, (1, "x", 1), (1, "x", 2), (2, "y", 1))
    accepted, _ = accept_snapshot(rows, AB, AB_SPEC, "latest", "b")
    assert sorted(tuple(r) for r in accepted.collect()) == [(1, "x", 2), (2, "y", 1)]
    assert [tuple(r) for r in duplicate_keys(rows, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        accept_snapshot(rows, AB, AB_SPEC, "latest")
    with pytest.raises(ValueError):
        accept_snapshot(rows, AB, AB_SPEC, "first")


@pytest.mark.parametrize(
    ("source", "target", "good", "bad"),
    [
        ("decimal(12,4)", "decimal(12,2)", "1.2300", "1.2349"),
        ("timestamp", "date", "2024-01-02 00:00:00", "2024-01-02 03:04:05"),
        ("bigint", "double", "9007199254740992", "9007199254740993"),
        ("double", "int", "3", "3.5"),
        ("string", "decimal(12,2)", "1.23", "1.239"),
        ("string", "date", "2024-01-02", "2024-01-02 03:04:05"),
        ("string", "date", " 2024-01-02 ", "2024-01-02T00:00:00+05:00"),
        ("string", "decimal(38,2)", "123456789012345678901234567890123456.70", "1.239"),
        ("string", "decimal(38,2)", "1.2300000000000000000000000000000000000000000", "1234567890123456789012.123456"),
        ("string", "decimal(12,2)", "-12.5e1", "1e-3"),
        ("string", "decimal(12,2)", "0e9", "0.001"),
        ("string", "decimal(12,2)", "1200e-2", "1205e-3"),
        ("string", "int", "+007", "7.0"),
        ("string", "float", "16777216", "16777217"),
        ("string", "float", "0.1", "0.12345678901"),
        ("string", "double", "9007199254740992", "9007199254740993"),
        ("string", "double", "0.10", "1e999"),
        ("string", "double", "NaN", "1.0d"),
        ("string", "double", "-Infinity", "0x1p3"),
        ("string", "double", "2.5E-3", "0.1234567890123456789"),
        ("int", "boolean", "1", "5"),
        ("double", "boolean", "0", "0.5"),
        ("boolean", "int", "true", None),
        ("int", "float", "16777216", "16777217"),
        ("bigint", "int", "2147483647", "2147483648"),
        ("decimal(38,10)", "decimal(38,2)", "1.2300000000", "1.2390000000"),
        ("string", "timestamp", "2024-01-02 03:04:05.123456", "2024-01-02 03:04:05.1234567"),
        ("string", "timestamp", "2024-01-02T03:04:05.123456000Z", "2024-01-02T03:04:05+05:00"),
        ("string", "timestamp", "2024-01-02", "2024-01-02 25:00:00"),
        ("string", "timestamp_ntz", "2024-01-02 03:04:05", "2024-01-02 03:04:05+05:00"),
        ("string", "timestamp_ntz", "2024-01-02 03:04", "2024-01-02 03:04:05.0000001"),
        ("string", "boolean", "true", "maybe"),
    ],
)
def test_conversions_that_lose_something_are_rejected(spark, source, target, good, bad):
    schema = spark.sql(f"SELECT 1L AS k, CAST(null AS {target}) AS v").schema
    bad_value = "null" if bad is None else f"'{bad}'"
    rows = spark.sql(
        f"SELECT * FROM VALUES (1L, CAST('{good}' AS {source})), (2L, CAST({bad_value} AS {source})), "
        f"(3L, CAST(null AS {source})) AS t(k, v)"
    )
    accepted, rejected = screen_snapshot(rows, schema, ["k"])
    assert sorted(r["k"] for r in accepted.collect()) == [1, 3] if bad else [1, 2, 3]
    assert [(r["k"], r["reject_reason"]) for r in rejected.collect()] == [(2, "bad value: v")][: bad is not None]


ODD_NUMBERS = """0 -0 +0 00 0. .5 5. 1.10 01.1 -1.1 +7 1e0 1E+2 1e-2 12.5e1 1.005 0.1 16777217 1e18 1e19 1e20 1e38 1e99
1e100 1e400 9999999999999999999 99999999999999999999 0.0000000000000000001 0.00000000000000000001 1e-19 1e-20 -1e-400
9999999999999999999.9999999999999999999 1234567890123456789.5 0.0000123456789012345 1.2345678901234567e-5 0.30000000000000004
9007199254740993 123456789012345678901234567890123456.78 NaN Infinity 1.0d 0x1p3 abc 1_0 1e 1e+ - + . e5 1.2.3""".split()


@pytest.mark.parametrize("kind", ["int", "bigint", "float", "double", "decimal(12,2)", "decimal(38,2)", "decimal(38,30)"])
def test_plain_numbers_are_kept_like_any_others(spark, kind):
    texts = [*ODD_NUMBERS, " 1 ", "1\n", "\t1.5", "\u0661", "\uff11", "\x001", "1\x00", "", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    text, value = F.col("t"), F.col("t").try_cast(kind)
    kept = F.coalesce(_same_number(text, value, df.select(value).schema[0].dataType), F.lit(False))
    plain = _written_number(text) == _written_number(value.cast("string"))
    if kind in ("float", "double"):
        word = F.isnan(value) | (F.abs(value) == float("inf"))
        plain = F.when(_written_number(text).isNull(), word).otherwise(plain)
    got = df.select("t", kept.alias("kept"), F.coalesce(plain, F.lit(False)).alias("plain")).collect()
    assert [(r["t"], r["kept"]) for r in got] == [(r["t"], r["plain"]) for r in got]


def test_the_parts_of_a_number_are_looked_for_once(spark):
    """Parts that the expression names again are matched again: a second for every 5,000 rows."""
    text = spark.createDataFrame([("1", "x", "1")], "k string, a string, b string")
    accepted, _ = screen_snapshot(text, AB, ["k"])
    plan = accepted._jdf.queryExecution().analyzed().toString()
    # a number has four parts, and two numbers of each of two columns are compared
    assert plan.count("regexp_extract(") <= 16


def test_screening_once_gives_the_same_and_reads_once(spark, staging):
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    text = spark.createDataFrame([("1", "x", "1"), ("2", "y", "?"), (None, "z", "3")], "k string, a string, b string")
    want = [sorted(map(repr, df.collect())) for df in screen_snapshot(text, AB, ["k"])]
    once = screen_once(text.mapInArrow(counted, text.schema), AB, ["k"], staging)
    assert [sorted(map(repr, df.collect())) for df in (once.accepted, once.rejected)] == want
    assert (once.n_accepted, once.n_rejected) == (1, 2)
    assert seen.value == 3
    assert [tuple(r) for r in usable_keys(once.rejected, AB, ["k"]).collect()] == [(2,)]


GOOD = (1, "x", 1, 1, D0, END, True)


@pytest.mark.parametrize(
    ("row", "problem"),
    [
        ((2, "x", 1, 2, D0, END, None), "null flag"),
        ((2, "x", 1, None, D0, END, True), "null surrogate key"),
        ((None, "x", 1, 2, D0, END, True), "null business key"),
        ((2, "x", 1, 2, END, D0, False), "end before start"),
        ((2, "x", 1, 2, D0, D0, True), "end of an active row"),
        ((2, "x", 1, 2, D0, None, True), "null expiration date"),
        ((2, "x", 1, 2, None, END, True), "null effective date"),
        ((2, "x", 1, 2, D0, END, False), "open end of a closed row"),
        ((2, "x", 1, 2, D0, None, False), "null expiration date"),
    ],
)
def test_unsound_history_is_refused(spark, row, problem):
    with pytest.raises(CorruptHistory, match=problem):
        profile(AB_SPEC, ab_history(spark, GOOD, row))


def test_sound_history_is_measured(spark):
    closed = (2, "x", 1, 9, D0, D0, False)
    assert profile(AB_SPEC, ab_history(spark, GOOD, closed)) == Profile(1, 9, D0, 1, D0)
    assert profile(AB_SPEC, ab_history(spark)) == Profile(0, 0, None, 0, None)
