"""The rows each action contributes to the new history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory.functions import sql_date, sql_name
from dimhistory.operators.changes import ACTION, NEW, OLD, filter_action
from dimhistory.operators.numbering import assign_surrogate_keys, dense_row_number
from dimhistory.sources.staging import Staging
from dimhistory.spec import DELETE, INSERT, NOCHANGE, UPDATE, HistorySpec

_CLASS = "__class"


def _side(changes: DataFrame, suffix: str, *extra: str) -> DataFrame:
    """The columns of one side under their own names."""
    names = [c.removesuffix(suffix) for c in changes.columns if c.endswith(suffix)]
    return changes.selectExpr(
        *[f"{sql_name(n + suffix)} AS {sql_name(n)}" for n in names], *map(sql_name, extra)
    )


def _expired(changes: DataFrame, spec: HistorySpec, as_of: dt.date) -> DataFrame:
    """The history's side of changes, closed at ``as_of``."""
    new = {spec.expiration: sql_date(as_of), spec.flag: "false"}
    names = [c.removesuffix(OLD) for c in changes.columns if c.endswith(OLD)]
    return changes.selectExpr(
        *[f"{new.get(n, sql_name(n + OLD))} AS {sql_name(n)}" for n in names]
    )


def open_versions(rows: DataFrame, spec: HistorySpec, as_of: dt.date) -> DataFrame:
    """Give numbered source rows an interval that starts at ``as_of`` and has no end."""
    return rows.selectExpr(
        *map(sql_name, spec.attributes(rows.schema)),
        sql_name(spec.sk),
        f"{sql_date(as_of)} AS {sql_name(spec.effective)}",
        f"{sql_date(spec.end_date)} AS {sql_name(spec.expiration)}",
        f"true AS {sql_name(spec.flag)}",
    )


def rows_nochange(changes: DataFrame) -> DataFrame:
    """Rows that stay, with the history's values."""
    return _side(filter_action(changes, NOCHANGE), OLD)


def rows_deleted(changes: DataFrame, spec: HistorySpec, as_of: dt.date) -> DataFrame:
    """Versions of keys the snapshot lacks, expired in place."""
    return _expired(filter_action(changes, DELETE), spec, as_of)


def rows_updated_old(changes: DataFrame, spec: HistorySpec, as_of: dt.date) -> DataFrame:
    """Old versions of changed keys, expired in place."""
    return _expired(filter_action(changes, UPDATE), spec, as_of)


def rows_closed(changes: DataFrame, spec: HistorySpec, as_of: dt.date) -> DataFrame:
    """Deleted rows and old versions in one pass."""
    return _expired(filter_action(changes, DELETE, UPDATE), spec, as_of)


def rows_inserted(
    changes: DataFrame, spec: HistorySpec, as_of: dt.date, max_sk: int, staging: Staging
) -> DataFrame:
    """First versions of new keys, numbered after ``max_sk`` in key order."""
    # numbering may read its rows more than once, and these come out of a join
    rows, n = staging.observed(
        _side(filter_action(changes, INSERT), NEW), "inserted", {"rows": "count(*)"}
    )
    rows = assign_surrogate_keys(
        rows, spec.keys, spec.sk, staging, start=max_sk, rows=n["rows"]
    )
    return open_versions(rows, spec, as_of)


def rows_updated_new(
    changes: DataFrame, spec: HistorySpec, as_of: dt.date, max_sk: int, staging: Staging
) -> DataFrame:
    """New versions of changed keys, numbered after ``max_sk``, the last inserted key."""
    rows, n = staging.observed(
        _side(filter_action(changes, UPDATE), NEW), "updated", {"rows": "count(*)"}
    )
    rows = assign_surrogate_keys(
        rows, spec.keys, spec.sk, staging, start=max_sk, rows=n["rows"]
    )
    return open_versions(rows, spec, as_of)


def rows_opened(
    changes: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    max_sk: int,
    staging: Staging,
    rows: int | None = None,
    verified: bool = False,
) -> DataFrame:
    """Inserted rows and new versions, numbered together: inserts first, each in key order.

    A key that would get two versions is an error, unless the caller has ``verified`` that
    there is none.
    """
    # the class goes into the order, not a second numbering with its own start
    place = F.expr(f"if({ACTION} = '{INSERT}', 0, 1)")
    new = filter_action(changes, INSERT, UPDATE).withColumn(_CLASS, place)
    new = _side(new, NEW, _CLASS)
    new = dense_row_number(
        new,
        [_CLASS, *spec.keys],
        spec.sk,
        staging,
        start=max_sk,
        unique=True,
        rows=rows,
        verified=verified,
    )
    return open_versions(new.drop(_CLASS), spec, as_of)
