import datetime as dt
import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from dimhistory import HistorySpec, Staging, initial_load, merge_history
from dimhistory.errors import CorruptHistory, DuplicateKeys, HistoryError, SchemaMismatch
from dimhistory.operators.apply import union_by_name
from dimhistory.operators.changes import detect_changes, filter_inactive
from dimhistory.operators.checks import overlaps, violations
from dimhistory.operators.versions import (
    rows_deleted,
    rows_inserted,
    rows_nochange,
    rows_updated_new,
    rows_updated_old,
)
from dimhistory.plans.merge import merge_with_rejects
from util import (
    AB,
    AB_SPEC,
    D0,
    D1,
    D2,
    END,
    SOURCE,
    SPEC,
    ab,
    ab_history,
    collected,
    frame,
    model_initial,
    model_merge,
)


def customers(changed):
    """200 customers; the later snapshot changes 3 and 5, lacks 7 and has 201."""
    known = {
        3: ("Female", 20, 16, 6),
        5: ("Female", 31, 17, 40),
        7: ("Female", 35, 18, 6),
        201: ("Female", 40, 123, 76),
    }
    if changed:
        known[3] = ("Female", 22, 16, 6)
        known[5] = ("Female", 31, 17, 50)
    keys = [k for k in range(1, 202) if k != (7 if changed else 201)]
    other = [("Male", 18 + k % 50, 15 + k % 100, 1 + k % 99) for k in range(202)]
    return [(k, *known.get(k, other[k])) for k in keys]


def test_golden_customers(spark):
    first = initial_load(frame(spark, SOURCE, customers(False)), SPEC, D0)
    assert first.columns == [*SOURCE.names, *SPEC.scd_columns]
    result = collected(
        merge_history(first, frame(spark, SOURCE, customers(True)), SPEC, D1), "sk_customerid"
    )
    assert len(result) == 203
    assert [r[5] for r in result] == list(range(1, 204))
    changed = [r for r in result if r[0] in (3, 5, 7, 201)]
    assert sorted(changed) == [
        (3, "Female", 20, 16, 6, 3, D0, D1, False),
        (3, "Female", 22, 16, 6, 202, D1, END, True),
        (5, "Female", 31, 17, 40, 5, D0, D1, False),
        (5, "Female", 31, 17, 50, 203, D1, END, True),
        (7, "Female", 35, 18, 6, 7, D0, D1, False),
        (201, "Female", 40, 123, 76, 201, D1, END, True),
    ]
    same = [r for r in result if r[0] not in (3, 5, 7, 201)]
    assert same == [(*r, r[0], D0, END, True) for r in customers(False) if r[0] not in (3, 5, 7)]


def check_sound(before, after, accepted, spec, as_of):
    found = violations(before, after, accepted, spec, as_of).collect()
    assert {r["check"]: r["violations"] for r in found if r["violations"]} == {}


@pytest.mark.parametrize("seed", range(2))
def test_random_loads_match_the_model(spark, seed, staging):
    rng = random.Random(seed)

    def snapshot():
        keys = rng.sample(range(40), rng.randrange(0, 30))
        return [(k, rng.choice(["x", "y", "", None]), rng.choice([0, 1, None])) for k in keys]

    rows = snapshot()
    expected = model_initial(rows, D0)
    history = staging.write(initial_load(ab(spark, *rows), AB_SPEC, D0), "h")
    assert collected(history) == expected
    for day in (D1, D1, D2):
        rows = snapshot()
        expected = model_merge(expected, rows, day)
        after = staging.write(merge_history(history, ab(spark, *rows), AB_SPEC, day), "h")
        assert collected(after) == expected
        check_sound(history, after, ab(spark, *rows), AB_SPEC, day)
        history = after


H = [(1, "x", 1, 1, D0, END, True), (2, "y", 2, 2, D0, END, True)]


def test_empty_history(spark):
    got = merge_history(ab_history(spark), ab(spark, (2, "y", 1), (1, "x", 1)), AB_SPEC, D1)
    assert collected(got) == [(1, "x", 1, 1, D1, END, True), (2, "y", 1, 2, D1, END, True)]


def test_empty_snapshot_closes_everything(spark):
    got = merge_history(ab_history(spark, *H), ab(spark), AB_SPEC, D1)
    assert collected(got) == [(*r[:5], D1, False) for r in H]


def test_empty_both(spark):
    assert collected(merge_history(ab_history(spark), ab(spark), AB_SPEC, D1)) == []
    assert collected(initial_load(ab(spark), AB_SPEC, D1)) == []


def test_updates_without_inserts_are_numbered(spark):
    got = merge_history(ab_history(spark, *H), ab(spark, (1, "x", 9), (2, "y", 2)), AB_SPEC, D1)
    assert collected(got)[-1] == (1, "x", 9, 3, D1, END, True)


def test_same_snapshot_again_changes_nothing(spark):
    got = merge_history(ab_history(spark, *H), ab(spark, (1, "x", 1), (2, "y", 2)), AB_SPEC, D1)
    assert collected(got) == H


def test_returning_key_is_new(spark):
    gone = (3, "z", 3, 3, D0, D1, False)
    snapshot = ab(spark, (1, "x", 1), (2, "y", 2), (3, "z", 3))
    got = collected(merge_history(ab_history(spark, *H, gone), snapshot, AB_SPEC, D2))
    assert got == [*H, gone, (3, "z", 3, 4, D2, END, True)]


def test_second_change_on_one_day_leaves_an_empty_interval(spark):
    got = merge_history(ab_history(spark, *H), ab(spark, (1, "x", 5), (2, "y", 2)), AB_SPEC, D0)
    assert (1, "x", 1, 1, D0, D0, False) in collected(got)


def test_null_and_empty_text_differ_only_when_exact(spark):
    history = ab_history(spark, (1, None, 1, 1, D0, END, True))
    snapshot = ab(spark, (1, "", 1))
    assert len(collected(merge_history(history, snapshot, AB_SPEC, D1))) == 2
    md5 = replace(AB_SPEC, compare="md5")
    assert len(collected(merge_history(history, snapshot, md5, D1))) == 1


def test_separator_collision_is_a_change_only_when_exact(spark):
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("k", "a", "b")])
    spec = HistorySpec(["k"], ["a", "b"])
    history = frame(spark, spec.history_schema(schema), [(1, 1, 23, 1, D0, END, True)])
    snapshot = frame(spark, schema, [(1, 12, 3)])
    assert len(collected(merge_history(history, snapshot, spec, D1))) == 2
    assert len(collected(merge_history(history, snapshot, replace(spec, compare="md5"), D1))) == 1


def test_all_null_new_row_is_an_insert(spark):
    got = merge_history(ab_history(spark), ab(spark, (1, None, None)), AB_SPEC, D1)
    assert collected(got) == [(1, None, None, 1, D1, END, True)]


def test_floating_point_values(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("f", T.DoubleType())])
    spec = HistorySpec(["k"], ["f"])
    rows = [(1, float("nan"), 1, D0, END, True), (2, -0.0, 2, D0, END, True)]
    history = frame(spark, spec.history_schema(schema), rows)
    snapshot = frame(spark, schema, [(1, float("nan")), (2, 0.0)])
    assert merge_history(history, snapshot, spec, D1).count() == 2
    assert merge_history(history, snapshot, replace(spec, compare="md5"), D1).count() == 3


def test_atomic_types_and_composite_key(spark):
    schema = T.StructType(
        [
            T.StructField("d", T.DateType()),
            T.StructField("n", T.StringType()),
            T.StructField("amount", T.DecimalType(18, 4)),
            T.StructField("seen", T.TimestampType()),
            T.StructField("ok", T.BooleanType()),
            T.StructField("raw", T.BinaryType()),
        ]
    )
    spec = HistorySpec(["d", "n"], ["amount", "seen", "ok", "raw"])
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 6)

    def row(n, amount, raw=b"\x00"):
        return (D0, n, Decimal(amount), at, True, raw)

    history = initial_load(frame(spark, schema, [row("a", "1.5"), row("b", "2"), row("c", "3")]), spec, D0)
    snapshot = frame(spark, schema, [row("a", "1.5000"), row("b", "2.0001"), row("c", "3", b"\x01")])
    got = collected(merge_history(history, snapshot, spec, D1))
    assert [(r[1], r[6], r[9]) for r in got] == [
        ("a", 1, True), ("b", 2, False), ("c", 3, False), ("b", 4, True), ("c", 5, True),
    ]


def test_untracked_columns_keep_the_history_value(spark):
    spec = HistorySpec(["k"], ["a"])
    got = merge_history(ab_history(spark, *H), ab(spark, (1, "x", 99), (2, "n", 98)), spec, D1)
    assert collected(got) == [
        H[0],
        (*H[1][:5], D1, False),
        (2, "n", 98, 3, D1, END, True),
    ]


def test_null_keys_are_left_out(spark):
    snapshot = ab(spark, (1, "x", 1), (2, "y", 2), (None, "q", 1), (None, "q", 1))
    assert collected(merge_history(ab_history(spark, *H), snapshot, AB_SPEC, D1)) == H
    assert collected(initial_load(ab(spark, (None, "q", 1), (7, "x", 1)), AB_SPEC, D0)) == [
        (7, "x", 1, 1, D0, END, True)
    ]


def test_text_snapshot_takes_the_history_types(spark):
    text = spark.createDataFrame([("1", "x", "1"), ("2", "y", "02")], "k string, a string, b string")
    assert collected(merge_history(ab_history(spark, *H), text, AB_SPEC, D1)) == H


@pytest.mark.parametrize(
    "extra",
    [
        [(1, "x", 1)],  # copy of an unchanged row
        [(1, "x", 5)],  # changed next to unchanged
        [(2, "q", 1), (2, "q", 2)],  # changed twice
        [(7, "n", 1), (7, "n", 1)],  # new twice
    ],
)
@pytest.mark.parametrize("load", ["merge", "initial"])
def test_duplicate_keys_are_refused(spark, extra, load):
    snapshot = ab(spark, (1, "x", 1), (2, "y", 2), *extra)
    with pytest.raises(DuplicateKeys):
        if load == "merge":
            merge_history(ab_history(spark, *H), snapshot, AB_SPEC, D1)
        else:
            initial_load(snapshot, AB_SPEC, D1)


def test_a_copy_cannot_hide_behind_a_deleted_row(spark):
    # as many accepted rows as active rows, though key 1 comes twice and key 2 is gone
    with pytest.raises(DuplicateKeys):
        merge_history(ab_history(spark, *H), ab(spark, (1, "x", 1), (1, "x", 1)), AB_SPEC, D1)


def test_latest_duplicate_wins(spark):
    snapshot = ab(spark, (1, "x", 1), (1, "w", 8), (2, "y", 2))
    got = merge_history(
        ab_history(spark, *H), snapshot, AB_SPEC, D1, on_duplicate="latest", order_by="b"
    )
    assert collected(got)[-1] == (1, "w", 8, 3, D1, END, True)


def test_duplicate_active_history_is_refused(spark):
    twice = ab_history(spark, *H, (1, "x", 2, 3, D0, END, True))
    with pytest.raises(DuplicateKeys, match="active history"):
        merge_history(twice, ab(spark, (1, "x", 1)), AB_SPEC, D1)


def test_null_flag_and_other_columns_are_refused(spark):
    with pytest.raises(CorruptHistory):
        merge_history(ab_history(spark, (1, "x", 1, 1, D0, END, None)), ab(spark), AB_SPEC, D1)
    with pytest.raises(SchemaMismatch):
        merge_history(ab_history(spark, *H), ab(spark).drop("b"), AB_SPEC, D1)
    with pytest.raises(ValueError):
        initial_load(ab(spark).withColumnRenamed("b", "sk"), AB_SPEC, D1)


def test_shared_surrogate_keys_lose_no_row(spark):
    """A key that closes must not take rows of other keys, or closed rows, with it."""
    history = [
        (1, "x", 1, 1, D0, END, True),
        (2, "y", 2, 1, D0, END, True),
        (3, "z", 3, 5, D0, END, True),
        (4, "o", 4, 5, D0, D0, False),
    ]
    later = [(1, "x", 9), (2, "y", 2)]
    got = merge_history(ab_history(spark, *history), ab(spark, *later), AB_SPEC, D1)
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        [
            (1, "x", 1, 1, D0, D1, False),
            (1, "x", 9, 6, D1, END, True),
            (2, "y", 2, 1, D0, END, True),
            (3, "z", 3, 5, D0, D1, False),
            (4, "o", 4, 5, D0, D0, False),
        ]
    )


def test_rejected_rows_hold_their_versions(spark):
    history = ab_history(spark, *H, (3, "z", 3, 3, D0, END, True))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "kab"])
    # 1 has a bad value, 2 stays, 3 is gone, 8 is new and bad, one key is lost
    text = frame(spark, schema, [("1", "x", "n/a"), ("2", "y", "2"), ("8", "n", "?"), ("q", "n", "1")])
    got, rejected, counts = merge_with_rejects(history, text, AB_SPEC, D1)
    assert collected(got) == [*H, (3, "z", 3, 3, D0, D1, False)]
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["bad value: b"] * 2 + ["bad value: k"]
    assert counts == {"INSERT": 0, "DELETE": 1, "UPDATE": 0, "REJECTED": 3}
    # a usable row of the same key counts
    both = frame(spark, schema, [("1", "x", "n/a"), ("1", "x", "7"), ("2", "y", "2"), ("3", "z", "3")])
    assert collected(merge_history(history, both, AB_SPEC, D1))[-1] == (1, "x", 7, 4, D1, END, True)


def test_a_date_before_the_newest_version_is_refused(spark):
    history = ab_history(spark, (1, "x", 1, 1, D1, END, True))
    with pytest.raises(HistoryError, match="before"):
        merge_history(history, ab(spark, (1, "x", 2)), AB_SPEC, D0)


def test_a_date_before_a_closed_version_ends_is_refused(spark):
    gone = (3, "z", 3, 3, D0, D2, False)
    # key 3 would have two versions from D1 to D2
    with pytest.raises(HistoryError, match="closed version"):
        merge_history(ab_history(spark, *H, gone), ab(spark, (3, "z", 3)), AB_SPEC, D1)
    assert merge_history(ab_history(spark, *H, gone), ab(spark, (3, "z", 3)), AB_SPEC, D2).count() == 4


@pytest.mark.parametrize(
    "row",
    [
        (9, "x", 1, 9, D0, None, True),
        (9, "x", 1, 9, None, END, True),
        (9, "x", 1, 9, D0, END, False),
        (9, "x", 1, 9, D0, None, False),
    ],
)
def test_contradictory_intervals_are_refused_and_counted(spark, row):
    history = ab_history(spark, *H, row)
    with pytest.raises(CorruptHistory):
        merge_history(history, ab(spark, (9, "x", 2)), AB_SPEC, D1)
    sound = ab_history(spark, *H)
    found = {r["check"]: r["violations"] for r in violations(sound, history, ab(spark), AB_SPEC, D1).collect()}
    counted = found["no null date"], found["closed intervals end"], found["active intervals are open"]
    assert sum(counted) >= 1


def test_overlapping_versions_are_counted(spark):
    rows = [
        (1, "x", 1, 1, D0, D2, False), (1, "x", 2, 2, D1, END, True),  # overlap
        (2, "x", 1, 3, D0, D1, False), (2, "x", 2, 4, D1, END, True),  # meet
        (3, "x", 1, 5, D1, D1, False), (3, "x", 2, 6, D0, D2, False), (3, "x", 3, 7, D2, END, True),  # empty
        (4, "x", 1, 8, D0, END, True), (4, "x", 2, 9, D1, D2, False), (4, "x", 2, 10, D2, END, True),  # twice
    ]
    got = overlaps(ab_history(spark, *rows), AB_SPEC)
    assert sorted(r["sk"] for r in got.collect()) == [2, 9, 10]


def test_the_snapshot_is_read_once(spark):
    for snapshot in (ab(spark, (1, "x", 9), (None, "q", 1)), ab(spark, (1, "x", 9)).selectExpr("string(k) k", "a", "b")):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = snapshot.mapInArrow(counted, snapshot.schema)
        got, rejected, counts = merge_with_rejects(ab_history(spark, *H), rows, AB_SPEC, D1)
        assert (got.count(), rejected.count()) == (3, counts["REJECTED"])
        first = initial_load(rows.where("k IS NOT NULL"), HistorySpec(["k"], ["a"]), D1)
        assert first.count() == 1
        assert seen.value == 2 * snapshot.count()


def test_copies_on_both_sides_do_not_multiply(spark, staging, monkeypatch):
    written = {}
    original = Staging.write

    def remember(self, df, name, **options):
        out = original(self, df, name, **options)
        written[name] = out.count()
        return out

    monkeypatch.setattr(Staging, "write", remember)
    twice = ab_history(spark, *[(1, "x", 1, i, D0, END, True) for i in range(1, 61)])
    with pytest.raises(DuplicateKeys):
        merge_history(twice, ab(spark, *[(1, "x", 1)] * 60), AB_SPEC, D1)
    assert written["compared"] == 1


def test_merge_equals_the_union_of_the_actions(spark, staging):
    """The rows of each action, put together one by one, are the merged history."""
    rows = [(k, "x", k % 5) for k in range(200)]
    later = [(k, "x", k % 5 + (k % 7 == 0)) for k in range(20, 220)]
    history = ab_history(spark, *model_initial(rows, D0), (300, "o", 1, 900, D0, D0, False))
    snapshot = ab(spark, *later)
    changes = staging.write(detect_changes(history, snapshot, AB_SPEC), "changes")
    inserted = rows_inserted(changes, AB_SPEC, D1, 900, staging)
    parts = union_by_name(
        filter_inactive(history, AB_SPEC),
        rows_nochange(changes),
        rows_deleted(changes, AB_SPEC, D1),
        inserted,
        rows_updated_old(changes, AB_SPEC, D1),
        rows_updated_new(changes, AB_SPEC, D1, 900 + inserted.count(), staging),
    )
    assert collected(parts) == collected(merge_history(history, snapshot, AB_SPEC, D1))


@pytest.mark.parametrize("compare", ["exact", "md5"])
def test_source_columns_may_be_named_like_internal_ones(spark, compare):
    names = ["k", "action", "hash_md5", "k_history"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    spec = HistorySpec(["k"], names, compare=compare)
    first = initial_load(frame(spark, schema, [("a", "1", "2", "3"), ("b", "1", "2", "3")]), spec, D0)
    got = merge_history(first, frame(spark, schema, [("a", "1", "2", "4"), ("c", "1", "2", "3")]), spec, D1)
    assert collected(got) == [
        ("a", "1", "2", "3", 1, D0, D1, False),
        ("b", "1", "2", "3", 2, D0, D1, False),
        ("c", "1", "2", "3", 3, D1, END, True),
        ("a", "1", "2", "4", 4, D1, END, True),
    ]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        HistorySpec([], ["a"])
    with pytest.raises(ValueError):
        HistorySpec(["k"], ["a"], compare="sha1")
    with pytest.raises(ValueError):
        HistorySpec(["q"], ["a"]).history_schema(AB)
