"""Comparing the active history with a snapshot: one row per business key and its action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimhistory.functions import append_suffix, quoted, sql_name, with_fingerprint
from dimhistory.spec import DELETE, INSERT, NOCHANGE, UPDATE, HistorySpec

OLD, NEW = "_history", "_current"
ACTION = "action"
_FINGERPRINT = "__fingerprint"


def filter_active(history: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.where(quoted(spec.flag))


def filter_inactive(history: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.where(~quoted(spec.flag))


def filter_action(changes: DataFrame, *actions: str) -> DataFrame:
    return changes.where(F.col(ACTION).isin(*actions))


def full_outer_join(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Pair the rows of two frames by key; columns get the suffixes OLD and NEW.

    Each key should occur once on either side: copies multiply, and the rows of one key
    meet in one task.
    """
    left, right = append_suffix(old, OLD), append_suffix(new, NEW)
    same_key = " AND ".join(f"{sql_name(k + OLD)} = {sql_name(k + NEW)}" for k in keys)
    return left.join(right, F.expr(same_key), "full")


def unchanged(spec: HistorySpec) -> Column:
    """Whether the two sides of a pair agree in all tracked columns."""
    if spec.compare == "md5":
        return quoted(_FINGERPRINT + OLD) == quoted(_FINGERPRINT + NEW)
    same = [f"{sql_name(c + OLD)} <=> {sql_name(c + NEW)}" for c in spec.tracked]
    return F.expr(" AND ".join(same) or "true")


def classify(pairs: DataFrame, spec: HistorySpec) -> DataFrame:
    """Label each pair. Presence is tested first: two absent values would compare equal."""
    key = spec.keys[0]
    return pairs.withColumn(
        ACTION,
        F.when(quoted(key + NEW).isNull(), DELETE)
        .when(quoted(key + OLD).isNull(), INSERT)
        .when(unchanged(spec), NOCHANGE)
        .otherwise(UPDATE),
    )


def detect_changes(history: DataFrame, snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    """Full outer join of active history and snapshot by business key, labelled.

    Snapshot rows with a null key match nothing and are left out. Fingerprints are taken
    before the join, where a missing side still has none.
    """
    active = filter_active(history, spec)
    snapshot = snapshot.where(" AND ".join(f"{sql_name(k)} IS NOT NULL" for k in spec.keys))
    if spec.compare == "md5":
        active = with_fingerprint(active, spec.tracked, _FINGERPRINT)
        snapshot = with_fingerprint(snapshot, spec.tracked, _FINGERPRINT)
    changes = classify(full_outer_join(active, snapshot, spec.keys), spec)
    return changes.drop(_FINGERPRINT + OLD, _FINGERPRINT + NEW)


def action_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n"))


def is_empty(df: DataFrame) -> bool:
    """Whether a write of ``df`` can be skipped; reads no more than one row."""
    return df.isEmpty()
