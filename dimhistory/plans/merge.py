"""Initial load and incremental merge as plans over frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory.errors import DuplicateKeys
from dimhistory.functions import project, quoted, sql_name
from dimhistory.operators.apply import union_by_name
from dimhistory.operators.changes import (
    ACTION,
    NEW,
    OLD,
    detect_changes,
    filter_active,
    filter_inactive,
)
from dimhistory.operators.numbering import assign_surrogate_keys
from dimhistory.operators.partitioning import spread
from dimhistory.operators.screening import (
    Profile,
    Screened,
    latest_per_key,
    measured,
    profile,
    profile_metrics,
    require_unique,
    screen_once,
    screen_snapshot,
    usable_keys,
)
from dimhistory.operators.versions import open_versions, rows_closed, rows_opened
from dimhistory.sources.staging import Staging
from dimhistory.spec import DELETE, INSERT, NOCHANGE, UPDATE, HistorySpec

A, B = TypeVar("A"), TypeVar("B")
_COPIES, _HELD = "__copies", "__held"
# Folders of a staged comparison: rows that stay as they are, and everything else.
KIND, STAY, CHANGE = "dimhistory_kind", "stay", "change"
_ACTION, _NEW, _OLD = "__action", "__new", "__old"
# Parts of a stored history that are counted in one number.
PARTS_PER_SET = 62


def accept_snapshot(
    snapshot: DataFrame,
    schema: T.StructType,
    spec: HistorySpec,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows. ``"latest"`` leaves one accepted row per key.

    Both read the snapshot; ``accept_once`` reads it once for both.
    """
    _check_policy(on_duplicate, order_by)
    accepted, rejected = screen_snapshot(snapshot, schema, spec.keys)
    if on_duplicate == "latest":
        accepted = latest_per_key(accepted, spec.keys, order_by)
    return accepted, rejected


def accept_once(
    snapshot: DataFrame,
    schema: T.StructType,
    spec: HistorySpec,
    staging: Staging,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> Screened:
    """``accept_snapshot`` for a snapshot that is read and counted once, whatever becomes of it."""
    _check_policy(on_duplicate, order_by)
    screened = screen_once(snapshot, schema, spec.keys, staging)
    if on_duplicate == "latest":
        latest = latest_per_key(screened.accepted, spec.keys, order_by)
        latest, n = staging.observed(latest, "latest", {"rows": "count(*)"})
        screened = replace(screened, accepted=latest, n_accepted=n["rows"])
    return screened


def both(first: Callable[[], A], second: Callable[[], B]) -> tuple[A, B]:
    """The results of two calls whose jobs run at the same time; the first one's error comes first."""
    with ThreadPoolExecutor(1) as pool:
        other = pool.submit(inheritable_thread_target(SparkSession.getActiveSession())(second))
        return first(), other.result()


def _check_policy(on_duplicate: str, order_by: str | None) -> None:
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    if on_duplicate == "latest" and order_by is None:
        raise ValueError("on_duplicate='latest' needs order_by")


def initial_load(
    snapshot: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    staging: Staging | None = None,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """First history of a source: keys numbered from 1 in order, all intervals open.

    Rows with a null key are left out; ``accept_snapshot`` returns them. ``snapshot`` is read
    once, here; the result reads what was staged.
    """
    staging = staging or Staging(snapshot.sparkSession)
    screened = accept_once(snapshot, snapshot.schema, spec, staging, on_duplicate, order_by)
    return number_first_versions(screened.accepted, spec, as_of, staging, screened.n_accepted)


def number_first_versions(
    accepted: DataFrame, spec: HistorySpec, as_of: dt.date, staging: Staging, rows: int
) -> DataFrame:
    """Open versions of accepted rows; the numbering refuses keys that occur twice."""
    spec.history_schema(accepted.schema)
    numbered = assign_surrogate_keys(accepted, spec.keys, spec.sk, staging, rows=rows)
    return open_versions(numbered, spec, as_of)


@dataclass(frozen=True)
class Merge:
    """What a snapshot does to a history. ``closed`` and ``opened`` are as large as the change.

    ``stays`` are the active rows that no change concerns, out of the comparison itself, if they
    were asked for. ``changes`` holds the keys of all others, each with its action. Of a stored
    history, versions leave the parts ``leaving`` and come into the parts ``arriving``.
    """

    spec: HistorySpec
    stays: DataFrame | None
    changes: DataFrame
    closed: DataFrame
    opened: DataFrame
    counts: dict[str, int]
    before: Profile
    leaving: set[int]
    arriving: set[int]

    @property
    def n_closed(self) -> int:
        return self.counts[DELETE] + self.counts[UPDATE]

    @property
    def n_opened(self) -> int:
        return self.counts[INSERT] + self.counts[UPDATE]


def plan_merge(
    history: DataFrame,
    accepted: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    staging: Staging,
    before: Profile,
    rows: int,
    held: DataFrame | None = None,
    stored: tuple[int, int] | None = None,
) -> Merge:
    """Compare active rows and the ``rows`` accepted ones once and write every pair once.

    Rows that stay leave the comparison with the history's columns only, in a folder of their
    own; changed keys carry both sides, and only they are read again. So the active rows are
    read and shuffled once, and no row depends on a surrogate key to be found.

    With ``stored`` the history lies in so many parts and buckets of its keys: only the snapshot
    moves, to the bucket of its keys. Rows that stay are then not written, since they stay where
    they are; ``before`` tells of the closed rows, and the active ones are measured on the way,
    with the parts that change.

    One row per key and side enters the join, with the number of its copies: copies are refused
    afterwards without having been multiplied. Keys of ``held`` were in the snapshot with values
    that could not be used; their versions stay open.
    """
    if not stored:
        before.require_not_before(as_of)
    active = filter_active(history, spec).selectExpr("*", f"true AS {_OLD}")
    side = accepted.selectExpr("*", f"false AS {_HELD}")
    if held is not None:
        side = side.unionByName(held.withColumn(_HELD, F.lit(True)), allowMissingColumns=True)
    if stored:
        side = side.repartition(stored[1], *[quoted(k) for k in spec.keys])
    else:
        most = max(before.active_rows, rows)
        active, side = spread(active, spec.keys, most), spread(side, spec.keys, most)
    side = _one_per_key(side, spec.keys, f"count_if(NOT {_HELD})", "" if held is None else _HELD)
    active = _one_per_key(active, spec.keys, "count(*)")
    held_key = f"coalesce({_HELD + NEW}, false)"
    action = f"if({held_key}, '{NOCHANGE}', {ACTION})"
    copies = f"greatest(1, {_COPIES + NEW}, {_COPIES + OLD})"
    stay = f"({action} = '{NOCHANGE}' AND {copies} = 1)"
    pairs = (
        detect_changes(active, side, spec)
        .where(f"NOT ({held_key} AND {sql_name(spec.keys[0] + OLD)} IS NULL)")
        .selectExpr(
            f"if({stay}, '{STAY}', '{CHANGE}') AS {KIND}",
            f"{action} AS {_ACTION}",
            f"bigint({copies}) AS {_COPIES}",
            f"{_OLD + OLD} AS {_OLD}",
            *[f"{sql_name(c + OLD)} AS {sql_name(c)}" for c in history.columns],
            *[
                f"if({stay}, NULL, {sql_name(c + NEW)}) AS {sql_name(c + _NEW)}"
                for c in accepted.columns
            ],
        )
    )
    metrics = {a: f"count_if({_ACTION} = '{a}')" for a in (INSERT, DELETE, UPDATE)}
    metrics[_COPIES] = f"max({_COPIES})"
    if stored:
        # rows of the snapshot alone would count as rows with null columns
        metrics |= profile_metrics(spec, among=f"{_OLD} <=> true")
        key = ", ".join(f"coalesce({sql_name(k)}, {sql_name(k + _NEW)})" for k in spec.keys)
        part = f"pmod(hash({key}), {stored[0]})"
        for group in range(0, stored[0], PARTS_PER_SET):
            # a set of parts as bits of one number
            bit = f"if({part} DIV {PARTS_PER_SET} = {group // PARTS_PER_SET}, shiftleft(1L, {part} % {PARTS_PER_SET}), 0L)"
            for name, action in (("leaving", INSERT), ("arriving", DELETE)):
                other = f"{KIND} = '{CHANGE}' AND {_ACTION} <> '{action}'"
                metrics[f"{name} {group}"] = f"bit_or(if({other}, {bit}, 0L))"
    changed_only = f"{KIND} = '{CHANGE}'" if stored else None
    compared, found = staging.observed(pairs, "compared", metrics, changed_only, by=KIND)
    if (found[_COPIES] or 0) > 1:
        require_unique(filter_active(history, spec), spec.keys, "active history")
        require_unique(accepted, spec.keys, "snapshot")
        raise DuplicateKeys("a key occurred more than once while it was compared")
    if stored:
        seen = measured(spec, found)
        before = replace(
            seen,
            max_sk=max(seen.max_sk, before.max_sk),
            closed_rows=before.closed_rows,
            last_end=before.last_end,
        )
        before.require_not_before(as_of)
    counts = {a: found[a] for a in (INSERT, DELETE, UPDATE)}
    n_opened = counts[INSERT] + counts[UPDATE]
    names = history.columns
    changed = compared.where(f"{KIND} = '{CHANGE}'")
    delta = changed.selectExpr(
        f"{_ACTION} AS {ACTION}",
        *[f"{sql_name(c)} AS {sql_name(c + OLD)}" for c in names],
        *[f"{sql_name(c + _NEW)} AS {sql_name(c + NEW)}" for c in accepted.columns],
    )
    opened = history.limit(0)
    if n_opened:
        opened = project(
            rows_opened(delta, spec, as_of, before.max_sk, staging, n_opened, verified=True), names
        )
    def parts(name: str) -> set[int]:
        sets = range(0, stored[0], PARTS_PER_SET) if stored else ()
        return {
            group + i for group in sets for i in range(PARTS_PER_SET)
            if (found[f"{name} {group}"] or 0) >> i & 1
        }

    return Merge(
        spec=spec,
        stays=None if stored else project(compared.where(f"{KIND} = '{STAY}'"), names),
        changes=changed.selectExpr(
            *[f"coalesce({sql_name(k)}, {sql_name(k + _NEW)}) AS {sql_name(k)}" for k in spec.keys],
            f"{_ACTION} AS {ACTION}",
        ),
        closed=project(rows_closed(delta, spec, as_of), names),
        opened=opened,
        counts=counts,
        before=before,
        leaving=parts("leaving"),
        arriving=parts("arriving"),
    )


def _one_per_key(df: DataFrame, keys: tuple[str, ...], copies: str, first: str = "") -> DataFrame:
    """One row of each key with the number of its copies, in the partitions of the join."""
    by = ", ".join(map(sql_name, keys))
    same_key = f"PARTITION BY {by} ORDER BY {by}" + (f", {first}" if first else "")
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return (
        df.selectExpr(
            "*",
            f"row_number() OVER ({same_key}) AS __place",
            f"{copies} OVER ({same_key} {whole}) AS {_COPIES}",
        )
        .where("__place = 1")
        .drop("__place")
    )


def merge_history(
    history: DataFrame,
    snapshot: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    staging: Staging | None = None,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """The history after a full snapshot: what stays, what is closed and what is opened.

    The result reads the closed rows of ``history`` and what was staged; ``history`` must not
    change before it is consumed. ``merge_with_rejects`` returns rejected rows as well.
    """
    return merge_with_rejects(history, snapshot, spec, as_of, staging, on_duplicate, order_by)[0]


def merge_with_rejects(
    history: DataFrame,
    snapshot: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    staging: Staging | None = None,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``merge_history``, the rejected rows, and counts per action and of rejected rows.

    A rejected row that still tells its key holds the key's version open.
    """
    staging = staging or Staging(history.sparkSession)
    schema = spec.source_schema(history.schema)
    screened, before = both(
        lambda: accept_once(snapshot, schema, spec, staging, on_duplicate, order_by),
        lambda: profile(spec, history),
    )
    held = usable_keys(screened.rejected, schema, spec.keys) if screened.n_rejected else None
    merge = plan_merge(
        history, screened.accepted, spec, as_of, staging, before, screened.n_accepted, held
    )
    result = union_by_name(
        merge.stays, filter_inactive(history, spec), merge.closed, merge.opened
    )
    return result, screened.rejected, {**merge.counts, "REJECTED": screened.n_rejected}
