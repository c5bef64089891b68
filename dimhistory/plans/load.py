"""Loads of a stored history: first snapshot, later snapshots, and prepared change sets."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory.errors import CorruptHistory, SchemaMismatch
from dimhistory.functions import project, quoted
from dimhistory.operators.apply import (
    keyed_update,
    require_insertable,
    rows_among,
    union_by_name,
)
from dimhistory.operators.changes import ACTION
from dimhistory.operators.numbering import ROWS_ALONE
from dimhistory.operators.screening import profile, require_unique, usable_keys
from dimhistory.plans.merge import Merge, accept_once, both, number_first_versions, plan_merge
from dimhistory.sources.jdbc import JdbcTable
from dimhistory.sources.staging import Staging
from dimhistory.sources.table import PART, HistoryTable, Place
from dimhistory.spec import DELETE, INSERT, UPDATE, HistorySpec

_GONE, _FROM, _TO, _WAS = "__gone", "__from", "__to", "__was"


@dataclass(frozen=True)
class Load:
    """What a load did. ``name`` finds its rejected rows."""

    name: str
    counts: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    active_rows: int | None = None
    max_sk: int | None = None


def apply_snapshot(
    table: HistoryTable,
    snapshot: DataFrame,
    as_of: dt.date,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> Load:
    """Bring the table up to date with a full snapshot.

    The snapshot is read once, and moves to the buckets of the stored active rows, which are
    compared where they are. What is known of the rows is taken by the tasks that compare and
    write them: nothing is read back. Of closed rows three columns are read, and none is written
    again. Parts without a changed key are not touched.
    """
    spec = table.spec
    with table.loading() as load, Staging(table.spark) as staging:
        active = table.read_active()
        schema = spec.source_schema(active.schema)
        screened, closed = both(
            lambda: accept_once(snapshot, schema, spec, staging, on_duplicate, order_by),
            table.closed_profile,
        )
        held = usable_keys(screened.rejected, schema, spec.keys) if screened.n_rejected else None
        merge = plan_merge(
            active,
            screened.accepted,
            spec,
            as_of,
            staging,
            closed,
            screened.n_accepted,
            held,
            stored=table.sizes,
        )
        if screened.n_rejected:
            screened.rejected.write.parquet(table.rejects_path(load))
        if any(merge.counts.values()):
            _write_changes(table, merge, load)
        return Load(
            load,
            merge.counts,
            screened.n_rejected,
            merge.before.active_rows - merge.counts[DELETE] + merge.counts[INSERT],
            merge.before.max_sk + merge.n_opened,
        )


def _write_changes(table: HistoryTable, merge: Merge, load: str) -> None:
    """Write the parts that a merge changes, and the rows it closes, in one commit."""
    spec, touched = table.spec, merge.leaving | merge.arriving
    keys = list(spec.keys)
    gone = project(merge.changes.where(f"{ACTION} <> '{INSERT}'"), keys).withColumn(_GONE, F.lit(True))
    stays = table.read_parts((True, table.part_name(p)) for p in touched).join(gone, keys, "left")
    none = F.lit(None).cast("boolean")
    rows = union_by_name(
        stays.withColumn(_FROM, F.lit(0)),
        table.placed(merge.opened, load, merge.n_opened <= ROWS_ALONE).withColumn(_GONE, none).withColumn(_FROM, F.lit(1)),
        table.placed(merge.closed, load, merge.n_closed <= ROWS_ALONE).withColumn(_GONE, none).withColumn(_FROM, F.lit(2)),
    )
    seen = table.overwrite_parts(
        rows,
        may_empty=[(True, table.part_name(p)) for p in merge.leaving - merge.arriving],
        metrics={
            "gone": f"count_if({_GONE})",
            "opened": f"count_if({_FROM} = 1)",
            "closed": f"count_if({_FROM} = 2)",
        },
        where=f"{_GONE} IS NULL",
        drop=[_GONE, _FROM],
    )
    found = seen["gone"], seen["opened"], seen["closed"]
    if found != (merge.n_closed, merge.n_opened, merge.n_closed):
        raise CorruptHistory(f"{found} rows left, opened and closed, not what {merge.counts} asks for")


def load_initial(
    table: HistoryTable,
    snapshot: DataFrame,
    as_of: dt.date,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> Load:
    """Replace whatever the table holds with the first history of a snapshot."""
    spec = table.spec
    schema = spec.history_schema(snapshot.schema)
    table.ensure(snapshot.schema)
    stored = {f.name: f.dataType for f in table.read().schema}
    if stored != {f.name: f.dataType for f in schema}:
        raise SchemaMismatch(f"{table.name} holds {stored}, not {schema.simpleString()}")
    with table.loading() as load, Staging(table.spark) as staging:
        screened = accept_once(snapshot, snapshot.schema, spec, staging, on_duplicate, order_by)
        rows = screened.n_accepted
        first = number_first_versions(screened.accepted, spec, as_of, staging, rows)
        if screened.n_rejected:
            screened.rejected.write.parquet(table.rejects_path(load))
        written = table.replace(first, load)["written"]
        if written != rows:
            raise CorruptHistory(f"{written} rows were written, {rows} accepted")
        return Load(load, {INSERT: rows}, screened.n_rejected, rows, rows)


def apply_snapshot_jdbc(
    target: JdbcTable,
    snapshot: DataFrame,
    spec: HistorySpec,
    as_of: dt.date,
    partitions: int,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> dict[str, int]:
    """Bring a history in a database up to date; return the rows per action and rejected rows.

    The active rows are read once, in ``partitions`` ranges of the surrogate key, and staged:
    later steps must not see what this load writes. Of closed rows the database tells the
    largest surrogate key. Only changed rows go back.
    """
    spark = snapshot.sparkSession
    with Staging(spark) as staging:
        active = target.read_active(spark, staging, spec, partitions)
        largest = target.key_range(spark, spec.sk)
        before = profile(spec, active)
        before = replace(before, max_sk=max(before.max_sk, largest[1] if largest else 0))
        schema = spec.source_schema(active.schema)
        screened = accept_once(snapshot, schema, spec, staging, on_duplicate, order_by)
        held = usable_keys(screened.rejected, schema, spec.keys) if screened.n_rejected else None
        merge = plan_merge(
            active, screened.accepted, spec, as_of, staging, before, screened.n_accepted, held
        )
        if any(merge.counts.values()):
            changed = union_by_name(merge.closed, merge.opened)
            target.apply_rows(spark, changed, [*spec.keys, spec.sk])
        return {**merge.counts, "REJECTED": screened.n_rejected}


def apply_change_set(table: HistoryTable, rows: DataFrame, change_type: str) -> None:
    """Insert rows, or update rows by business and surrogate key, in one commit.

    An insert adds files. An update rewrites the partitions that hold one of the rows before or
    after it, and no others; rows that it closes become a part of their own.
    """
    if change_type not in (INSERT, UPDATE):
        raise ValueError(f"change type must be INSERT or UPDATE, not {change_type!r}")
    spec = table.spec
    keys = [*spec.keys, spec.sk]
    with table.loading() as load, Staging(table.spark) as staging:
        # checks and writes must all see the same rows
        rows = staging.write(rows, "rows")
        if change_type == INSERT:
            profile(spec, rows)
            require_insertable(table.read(), rows, keys)
            table.append(table.placed(rows, load))
            return
        require_unique(rows, keys, "update")
        wanted = project(rows, keys)
        hit = staging.write(rows_among(table.read_with_part(), wanted, keys), "hit")
        changed = keyed_update(hit.drop(PART), rows, keys)
        profile(spec, changed)
        changed = table.with_part(changed, load).withColumnRenamed(PART, _TO)
        # a closed row that stays closed stays in its part
        was = hit.select(*[quoted(k) for k in keys], PART, quoted(spec.flag).alias(_WAS))
        same = ~F.col(_WAS) & ~quoted(spec.flag)
        changed = changed.join(was, keys)
        changed = changed.withColumn(PART, F.when(same, F.col(PART)).otherwise(F.col(_TO)))
        changed = staging.write(changed.drop(_WAS, _TO), "changed")
        before, after = _places(hit, spec), _places(changed, spec)
        if not before:
            return
        others = table.read_parts(before | after).join(wanted, keys, "left_anti")
        by = [quoted(k) for k in spec.keys]
        changed = changed.repartition(table.sizes[1], *by)
        table.overwrite_parts(union_by_name(others, changed), may_empty=before)


def _places(rows: DataFrame, spec: HistorySpec) -> set[Place]:
    """The partitions of rows, at most as many as the table has."""
    found = rows.select(quoted(spec.flag).alias("flag"), PART).distinct().collect()
    return {(r["flag"], r[PART]) for r in found}
