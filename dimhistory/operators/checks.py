"""Conditions every merge must leave behind."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimhistory.functions import project, quoted, sql_name
from dimhistory.operators.changes import filter_active, filter_inactive
from dimhistory.operators.screening import broken_rows, duplicate_keys
from dimhistory.spec import HistorySpec


def _count(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check).alias("check"), "violations")


def _difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.exceptAll(right).unionByName(right.exceptAll(left))


def overlaps(history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Versions that start before an earlier version of their key ends.

    Intervals are half open, so a version may start where another ends, and an empty interval
    overlaps nothing. Rows without a start, an end or a key are left to the other checks.
    """
    start, end = quoted(spec.effective), quoted(spec.expiration)
    by = [quoted(k) for k in spec.keys]
    whole = history.where(start < end).dropna(subset=list(spec.keys))
    earlier = Window.partitionBy(*by).orderBy(start, end, quoted(spec.sk))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    ends = whole.withColumn("__last_end", F.max(end).over(earlier))
    return ends.where(start < F.col("__last_end")).drop("__last_end")


def violations(
    before: DataFrame, after: DataFrame, accepted: DataFrame, spec: HistorySpec, as_of: dt.date
) -> DataFrame:
    """Violations per check of a merge of ``accepted`` rows into ``before``; all 0 when sound."""
    sk, start = quoted(spec.sk), quoted(spec.effective)
    active = filter_active(after, spec)
    source = spec.attributes(before.schema)
    untracked = [c for c in source if c not in (*spec.keys, *spec.tracked)]
    compared = [c for c in source if c not in untracked]

    new = after.join(project(before, [spec.sk]), spec.sk, "left_anti")
    # both sides give one summary row each; they meet in an aggregate, not in a join
    none = F.lit(None).cast("bigint")
    seen = new.agg(
        F.count(F.lit(1)).alias("n"), F.min(sk).alias("low"), F.max(sk).alias("high"), none.alias("top")
    )
    top = before.agg(
        F.lit(0).cast("bigint").alias("n"), none.alias("low"), none.alias("high"),
        F.coalesce(F.max(sk), F.lit(0)).alias("top"),
    )
    n, low, high, largest = (F.max(c) for c in ("n", "low", "high", "top"))
    dense = (low == largest + 1) & (high == largest + n)
    gap = seen.unionByName(top).agg(((n > 0) & ~dense).alias("gap")).where("gap")
    checks = [
        _count(duplicate_keys(active, spec.keys), "one active row per key"),
        _count(duplicate_keys(after, [spec.sk]), "surrogate keys are unique"),
        _count(gap, "new surrogate keys are dense"),
        _count(
            _difference(project(active, compared), project(accepted, compared)),
            "active rows are the snapshot",
        ),
        _count(
            project(filter_inactive(before, spec), before.columns).exceptAll(
                project(after, before.columns)
            ),
            "closed rows stay as they were",
        ),
        _count(
            project(before, [spec.sk]).join(project(after, [spec.sk]), spec.sk, "left_anti"),
            "no row is lost",
        ),
        _count(
            new.where(~start.eqNullSafe(F.lit(as_of))), "new rows start at the processing date"
        ),
        _count(overlaps(after, spec), "versions of a key do not overlap"),
    ]
    broken = broken_rows(spec)
    by_row = {
        "no null surrogate key or flag": ("null surrogate key", "null flag"),
        "no null date": ("null effective date", "null expiration date"),
        "intervals do not end before they start": ("end before start",),
        "active intervals are open": ("end of an active row", "null end of an active row"),
        "closed intervals end": ("open end of a closed row",),
    }
    broken["null end of an active row"] = (
        f"{sql_name(spec.flag)} <=> true AND {sql_name(spec.expiration)} IS NULL"
    )
    found = [
        F.struct(
            F.lit(check).alias("check"),
            F.expr("count_if({})".format(" OR ".join(f"({broken[w]})" for w in whys))).alias("violations"),
        )
        for check, whys in by_row.items()
    ]
    # one pass for all conditions of single rows
    result = after.agg(F.array(*found).alias("found")).select(F.inline("found"))
    for check in checks:
        result = result.unionByName(check)
    return result
