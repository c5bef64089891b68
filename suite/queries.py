"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory import (
    HistorySpec,
    Staging,
    accept_snapshot,
    initial_load,
    merge_history,
    merge_with_rejects,
)
from dimhistory.functions import (
    append_suffix,
    format_date,
    normalize_columns,
    project,
    stamp_date,
    strip_suffix,
    with_constants,
    with_fingerprint,
)
from dimhistory.operators import apply, changes, checks, numbering, screening, versions
from dimhistory.plans.load import apply_change_set, apply_snapshot, load_initial
from dimhistory.sources.catalog import ensure_table, table_exists
from dimhistory.sources.csv import csv_columns, history_columns, read_csv, write_csv
from dimhistory.sources.table import HistoryTable
from dimhistory.spec import DELETE, INSERT, UPDATE
from suite.frames import (
    AS_OF,
    MONEY,
    Case,
    conversation_case,
    customer_case,
    customers,
    order_case,
    read,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _detected(case: Case) -> DataFrame:
    return changes.detect_changes(case.history, case.snapshot, case.spec)


def _staged_changes(spark: SparkSession, case: Case) -> DataFrame:
    return Staging(spark).write(_detected(case), "changes")


def _table(spark: SparkSession, spec: HistorySpec) -> HistoryTable:
    name, location = f"history_{uuid.uuid4().hex}", f"{Staging(spark).path}/table"
    return HistoryTable(spark, name, spec, location, parts=4, buckets=4)


# sources and sinks


def _customer_csv(spark: SparkSession, df: DataFrame) -> str:
    path = f"{Staging(spark).path}/csv"
    write_csv(df.withColumnRenamed("c_custkey", "C_CustKey"), path)
    return path


@query("scan_csv")
def scan_csv(spark, sf_dir):
    df = customers(spark, sf_dir)
    return read_csv(spark, _customer_csv(spark, df), schema=df.schema)


def _ragged_csv(spark: SparkSession, df: DataFrame) -> str:
    """A CSV in which every 11th key's line lacks a value and every 23rd has one too many."""
    key, names = F.col("c_custkey"), ["C_CustKey", *df.columns[1:]]
    texts = [F.col(c).cast("string") for c in df.columns]
    whole = F.concat_ws(",", *texts)
    line = (
        F.when(key % 11 == 0, F.concat_ws(",", *texts[:-1]))
        .when(key % 23 == 0, F.concat(whole, F.lit(",extra")))
        .otherwise(whole)
    )
    path = f"{Staging(spark).path}/ragged"
    # one column whose values are whole lines
    lines = df.select(line.alias(",".join(names)))
    lines.write.options(header=True, sep="\x01", quote="").csv(path)
    return path


def _ragged_split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    df = customers(spark, sf_dir)
    text = read_csv(spark, _ragged_csv(spark, df))
    return accept_snapshot(text, df.schema, HistorySpec(["c_custkey"], df.columns))


@query("scan_csv_text")
def scan_csv_text(spark, sf_dir):
    return _ragged_split(spark, sf_dir)[0]


@query("scan_csv_text_rejects")
def scan_csv_text_rejects(spark, sf_dir):
    return _ragged_split(spark, sf_dir)[1].select(screening.CORRUPT, screening.REASON)


@query("scan_csv_columns")
def scan_csv_columns(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    path = _customer_csv(spark, case.snapshot)
    names = history_columns(csv_columns(spark, path), case.spec.scd_columns)
    filled = case.history.agg(*[F.count(n).alias(n) for n in names])
    columns = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"),
                        F.col(n).alias("filled")) for i, n in enumerate(names)]
    return filled.select(F.inline(F.array(*columns)))


@query("sink_keyed_insert")
def sink_keyed_insert(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    table = _table(spark, case.spec)
    table.overwrite(case.history)
    rows = versions.rows_inserted(
        _staged_changes(spark, case), case.spec, AS_OF, case.max_sk, Staging(spark)
    )
    apply_change_set(table, rows, "INSERT")
    return table.read()


@query("sink_keyed_update")
def sink_keyed_update(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    table = _table(spark, case.spec)
    table.overwrite(case.history)
    apply_change_set(table, versions.rows_closed(_detected(case), case.spec, AS_OF), "UPDATE")
    return table.read()


def _catalog_steps(spark, case: Case, step) -> list[tuple]:
    """Run ``step(name, create)`` before and after the history is inserted into a new table."""
    name, staging = f"history_{uuid.uuid4().hex}", Staging(spark)

    def create() -> bool:
        return ensure_table(
            spark, name, case.history.schema, case.spec.flag, f"{staging.path}/table"
        )

    rows = []
    try:
        first = step(name, create)
        create()
        rows.append(("before", first, spark.table(name).count()))
        case.history.select(spark.table(name).columns).write.insertInto(name)
        rows.append(("after", step(name, create), spark.table(name).count()))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows


@query("ensure_table")
def ensure_table_once(spark, sf_dir):
    rows = _catalog_steps(spark, customer_case(spark, sf_dir), lambda name, create: create())
    return spark.createDataFrame(rows, "step string, created boolean, n_rows bigint")


@query("table_exists")
def table_exists_by_name(spark, sf_dir):
    rows = _catalog_steps(
        spark, customer_case(spark, sf_dir), lambda name, create: table_exists(spark, name)
    )
    return spark.createDataFrame(rows, "step string, found boolean, n_rows bigint")


# projections, naming, derived columns


@query("normalize_columns")
def normalize_columns_query(spark, sf_dir):
    df = customers(spark, sf_dir)
    return normalize_columns(df.toDF(*[f" {c.upper()} " for c in df.columns]))


@query("suffix_append")
def suffix_append(spark, sf_dir):
    return append_suffix(customer_case(spark, sf_dir).history, "_history")


@query("suffix_strip")
def suffix_strip(spark, sf_dir):
    df = customers(spark, sf_dir).withColumnRenamed("c_name", "c_history_name")
    return strip_suffix(append_suffix(df, "_history"), "_history")


@query("row_fingerprint")
def row_fingerprint(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return with_fingerprint(case.history, case.spec.tracked).select("sk", "hash_md5")


@query("row_fingerprint_empty")
def row_fingerprint_empty(spark, sf_dir):
    return with_fingerprint(customer_case(spark, sf_dir).history, []).select("sk", "hash_md5")


@query("project_columns")
def project_columns(spark, sf_dir):
    return project(customer_case(spark, sf_dir).history, ["sk", "c_mktsegment", "c_custkey"])


@query("add_constants")
def add_constants(spark, sf_dir):
    spec = customer_case(spark, sf_dir).spec
    return with_constants(
        customers(spark, sf_dir), {spec.flag: True, spec.expiration: spec.end_date}
    )


@query("stamp_as_of")
def stamp_as_of(spark, sf_dir):
    return stamp_date(customers(spark, sf_dir), AS_OF, "effective_date")


@query("reformat_date")
def reformat_date(spark, sf_dir):
    return format_date(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("assign_surrogate_keys")
def assign_surrogate_keys(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    top = numbering.max_surrogate_key(case.history, case.spec.sk).first()["max_sk"]
    return numbering.assign_surrogate_keys(
        case.snapshot, case.spec.keys, case.spec.sk, Staging(spark), start=top
    )


@query("dense_row_number")
def dense_row_number(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return numbering.dense_row_number(
        lines, ["l_orderkey", "l_linenumber"], "row_number", Staging(spark)
    )


# comparing history and snapshot


@query("filter_active")
def filter_active(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return changes.filter_active(case.history, case.spec)


@query("filter_inactive")
def filter_inactive(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return changes.filter_inactive(case.history, case.spec)


@query("join_full_outer")
def join_full_outer(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    active = changes.filter_active(case.history, case.spec)
    return changes.full_outer_join(active, case.snapshot, case.spec.keys)


@query("classify_changes")
def classify_changes(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return _detected(case).select("c_custkey_history", "c_custkey_current", "action")


@query("detect_changes")
def detect_changes(spark, sf_dir):
    return _detected(customer_case(spark, sf_dir))


@query("detect_changes_md5")
def detect_changes_md5(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return _detected(replace(case, spec=replace(case.spec, compare="md5")))


@query("filter_action")
def filter_action(spark, sf_dir):
    return changes.filter_action(_detected(customer_case(spark, sf_dir)), UPDATE)


@query("action_counts")
def action_counts(spark, sf_dir):
    return changes.action_counts(_detected(customer_case(spark, sf_dir)))


@query("is_empty_guard")
def is_empty_guard(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    found = _staged_changes(spark, case)
    # a snapshot compared with itself leaves only rows without change
    same = changes.detect_changes(
        initial_load(case.snapshot, case.spec, AS_OF), case.snapshot, case.spec
    )
    rows = [
        (action, changes.is_empty(changes.filter_action(found, action)),
         changes.is_empty(changes.filter_action(same, action)))
        for action in (INSERT, DELETE, UPDATE)
    ]
    return spark.createDataFrame(rows, "action string, skipped boolean, skipped_when_same boolean")


@query("max_surrogate_key")
def max_surrogate_key(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return numbering.max_surrogate_key(case.history, case.spec.sk)


@query("max_inserted_key")
def max_inserted_key(spark, sf_dir):
    return numbering.max_surrogate_key(rows_inserted(spark, sf_dir), "sk")


# rows per action


@query("rows_nochange")
def rows_nochange(spark, sf_dir):
    return versions.rows_nochange(_detected(customer_case(spark, sf_dir)))


@query("rows_inserted")
def rows_inserted(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return versions.rows_inserted(_detected(case), case.spec, AS_OF, case.max_sk, Staging(spark))


@query("rows_deleted")
def rows_deleted(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return versions.rows_deleted(_detected(case), case.spec, AS_OF)


@query("rows_updated_old")
def rows_updated_old(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return versions.rows_updated_old(_detected(case), case.spec, AS_OF)


@query("rows_updated_new")
def rows_updated_new(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    found = _staged_changes(spark, case)
    inserted = changes.filter_action(found, INSERT).count()
    return versions.rows_updated_new(
        found, case.spec, AS_OF, case.max_sk + inserted, Staging(spark)
    )


@query("union_by_name")
def union_by_name(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    active = changes.filter_active(case.history, case.spec)
    inactive = changes.filter_inactive(case.history, case.spec)
    return apply.union_by_name(active, inactive.select(*reversed(inactive.columns)), inactive)


# whole loads


@query("initial_load")
def initial_load_query(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return initial_load(case.snapshot, case.spec, AS_OF)


@query("initial_load_stored")
def initial_load_stored(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    table = _table(spark, case.spec)
    load_initial(table, case.snapshot, AS_OF)
    return table.read()


def _merged(case: Case, **spec_changes) -> DataFrame:
    return merge_history(case.history, case.snapshot, replace(case.spec, **spec_changes), AS_OF)


@query("merge_history")
def merge_history_customer(spark, sf_dir):
    return _merged(customer_case(spark, sf_dir))


@query("merge_history_md5")
def merge_history_md5(spark, sf_dir):
    return _merged(customer_case(spark, sf_dir), compare="md5")


@query("merge_history_orders")
def merge_history_orders(spark, sf_dir):
    return _merged(order_case(spark, sf_dir))


@query("merge_history_shared_sk")
def merge_history_shared_sk(spark, sf_dir):
    """Surrogate keys that many keys, active and closed, have in common."""
    case = customer_case(spark, sf_dir)
    shared = case.history.withColumn("sk", F.col("sk") % 97 + 1)
    return _merged(replace(case, history=shared))


def _with_rejects(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    return merge_with_rejects(case.history, _awkward(case.snapshot), case.spec, AS_OF)


@query("merge_history_with_rejects")
def merge_history_with_rejects(spark, sf_dir):
    return _with_rejects(spark, sf_dir)[0]


@query("merge_history_rejects")
def merge_history_rejects(spark, sf_dir):
    return _with_rejects(spark, sf_dir)[1]


@query("merge_history_composite_key")
def merge_history_composite_key(spark, sf_dir):
    return _merged(conversation_case(spark, sf_dir))


@query("apply_snapshot")
def apply_snapshot_stored(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    table = _table(spark, case.spec)
    table.overwrite(case.history)
    apply_snapshot(table, case.snapshot, AS_OF)
    return table.read()


@query("apply_changes")
def apply_changes(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    found, keys = _staged_changes(spark, case), [*case.spec.keys, case.spec.sk]
    closed = versions.rows_closed(found, case.spec, AS_OF)
    opened = versions.rows_opened(found, case.spec, AS_OF, case.max_sk, Staging(spark))
    target = apply.apply_changes(case.history, closed, "UPDATE", keys)
    return apply.apply_changes(target, opened, "INSERT", keys)


# input checks


def _awkward(rows: DataFrame) -> DataFrame:
    """Customers with lost keys, a value that is no number, and one that doesn't fit."""
    key = F.col("c_custkey")
    return rows.withColumns(
        {
            "c_custkey": F.when(key % 17 != 0, key),
            "c_nationkey": F.when(key % 13 == 0, F.lit("n/a")).otherwise(
                F.col("c_nationkey").cast("string")
            ),
            "c_acctbal": (
                F.col("c_acctbal").cast("decimal(14,4)")
                + F.when(key % 19 == 0, F.lit("0.0009")).otherwise("0").cast("decimal(14,4)")
            ).cast("decimal(14,4)"),
        }
    )


def _lossy(rows: DataFrame) -> DataFrame:
    """Values that convert, but some of them not without loss."""
    key = F.col("c_custkey")
    text = key.cast("string")
    seen = F.lit("2024-01-02 03:04:05")
    return rows.withColumns(
        {
            "credit": F.concat(text, F.when(key % 23 == 0, ".129").otherwise(".100")),
            "ratio": F.when(key % 29 == 0, "16777217").otherwise(F.concat(text, F.lit("e0"))),
            "seen": F.concat(seen, F.when(key % 31 == 0, "+05:00").when(key % 37 == 0, ".0000001").otherwise("")),
            "vip": F.when(key % 41 == 0, 5).otherwise(key % 2).cast("int"),
        }
    )


def _awkward_split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    source = customers(spark, sf_dir)
    wanted = source.schema
    for name, kind in {
        "credit": T.DecimalType(38, 2), "ratio": T.FloatType(), "seen": T.TimestampType(), "vip": T.BooleanType(),
    }.items():
        wanted = wanted.add(name, kind)
    # the keys of _lossy are those that _awkward then loses
    return accept_snapshot(_awkward(_lossy(source)), wanted, HistorySpec(["c_custkey"], wanted.names))


@query("accepted_rows")
def accepted_rows(spark, sf_dir):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return project(_awkward_split(spark, sf_dir)[0], columns)


@query("rejected_rows")
def rejected_rows(spark, sf_dir):
    return _awkward_split(spark, sf_dir)[1]


def _lines(spark, sf_dir) -> DataFrame:
    money = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = read(spark, sf_dir, "lineitem")
    return lines.withColumns(
        {c: F.col(c).cast(MONEY) for c in money} | {"l_shipdate": F.col("l_shipdate").cast("date")}
    )


@query("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    return screening.duplicate_keys(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query("latest_per_key")
def latest_per_key(spark, sf_dir):
    return screening.latest_per_key(
        _lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query("assign_surrogate_keys_null_key")
def assign_surrogate_keys_null_key(spark, sf_dir):
    key = F.col("c_custkey")
    rows = customers(spark, sf_dir).withColumn("c_custkey", F.when(key != 7, key))
    return numbering.assign_surrogate_keys(rows, ["c_custkey"], "sk", Staging(spark))


@query("post_conditions")
def post_conditions(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    after = Staging(spark).write(_merged(case), "after")
    return checks.violations(case.history, after, case.snapshot, case.spec, AS_OF)


@query("post_conditions_damaged")
def post_conditions_damaged(spark, sf_dir):
    case = customer_case(spark, sf_dir)
    key, flag = F.col("c_custkey"), F.col("current_flag")
    damaged = _merged(case).where(~(flag & (key % 41 == 0)))
    damaged = damaged.union(damaged.where(flag & (key % 43 == 0)))
    damaged = damaged.withColumns(
        {
            "sk": F.when(~(flag & (key % 47 == 0)), F.col("sk")),
            "c_name": F.when(~flag & (key % 53 == 0), F.lit("changed")).otherwise(F.col("c_name")),
            "expiration_date": F.when(key % 59 == 0, F.lit("2000-01-01").cast("date"))
            .when(~flag & (key % 71 == 0), F.lit("9999-12-31").cast("date"))
            .when(key % 73 != 0, F.col("expiration_date")),
            "effective_date": F.when(key % 61 == 0, F.date_sub("effective_date", 1)).when(
                key % 67 != 0, F.col("effective_date")
            ),
        }
    )
    after = Staging(spark).write(damaged, "damaged")
    return checks.violations(case.history, after, case.snapshot, case.spec, AS_OF)
