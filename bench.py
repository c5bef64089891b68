"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose input and parallelism. ``BENCH_KEYS``, a million by
default, is the number of generated keys of one more merge and initial load. Each time is the
median of ``BENCH_RUNS`` runs after a warm-up, over the whole result.

``plain_*`` are the same results in the obvious form, for comparison: one global window for the
numbers, one window per key for the latest row, one branch of a union per action, and a stored
table that is written anew.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimhistory import Staging, initial_load, merge_history
from dimhistory.functions import stamp_date, with_constants
from dimhistory.operators import changes, versions
from dimhistory.operators.numbering import max_surrogate_key
from dimhistory.spec import INSERT, UPDATE, HistorySpec
from suite.frames import AS_OF, Case, customer_case, order_case, read
from suite.queries import QUERIES, _lines

HEADLINE = [
    "merge_history",
    "merge_history_md5",
    "merge_history_orders",
    "merge_history_composite_key",
    "apply_snapshot",
    "initial_load",
    "detect_changes",
    "action_counts",
    "rows_inserted",
    "dense_row_number",
    "latest_per_key",
    "row_fingerprint",
    "scan_csv",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dimhistory-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    return builder.getOrCreate()


def numbered(rows: DataFrame, spec: HistorySpec, start: int) -> DataFrame:
    place = F.row_number().over(Window.orderBy(*spec.keys))
    return rows.withColumn(spec.sk, place.cast("bigint") + start)


def plain_initial_load(case: Case) -> DataFrame:
    return versions.open_versions(numbered(case.snapshot, case.spec, 0), case.spec, AS_OF)


def plain_merge(case: Case) -> DataFrame:
    spec = case.spec
    top = max_surrogate_key(case.history, spec.sk).first()["max_sk"]
    found = changes.detect_changes(case.history, case.snapshot, spec)
    inserted = changes.filter_action(found, INSERT).count()

    def opened(action: str, start: int) -> DataFrame:
        rows = changes.filter_action(found, action)
        new = [c for c in rows.columns if c.endswith(changes.NEW)]
        rows = rows.select(*[F.col(c).alias(c.removesuffix(changes.NEW)) for c in new])
        rows = stamp_date(numbered(rows, spec, start), AS_OF, spec.effective)
        rows = stamp_date(rows, spec.end_date, spec.expiration)
        return with_constants(rows, {spec.flag: True}).select(*case.history.columns)

    parts = [
        changes.filter_inactive(case.history, spec),
        versions.rows_nochange(found),
        versions.rows_deleted(found, spec, AS_OF),
        opened(INSERT, top),
        versions.rows_updated_old(found, spec, AS_OF),
        opened(UPDATE, top + inserted),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def plain_apply_snapshot(spark: SparkSession, case: Case) -> DataFrame:
    """The whole history written, merged and written again."""
    staging = Staging(spark)
    stored = staging.write(case.history, "stored")
    return staging.write(plain_merge(replace(case, history=stored)), "merged")


def plain_dense_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["l_orderkey", "l_linenumber"]
    lines = read(spark, sf_dir, "lineitem").select(*by)
    return lines.withColumn("row_number", F.row_number().over(Window.orderBy(*by)))


def plain_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, order = ["l_orderkey", "l_linenumber"], "l_shipdate"
    lines = _lines(spark, sf_dir)
    rest = [F.desc(c) for c in lines.columns if c not in (*keys, order)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order), *rest))
    return lines.withColumn("place", place).where("place = 1").drop("place")


def generated_case(spark: SparkSession, n: int) -> Case:
    """``n`` scattered keys; 2 % of them changed, 0.5 % gone, 0.5 % new."""
    staging = Staging(spark)
    key = F.col("id") * 7919 % n
    rows = spark.range(n).select(
        key.alias("key"),
        F.concat(F.lit("name "), F.md5(key.cast("string"))).alias("name"),
        (key % 97).cast("int").alias("score"),
        F.sha1(key.cast("string")).alias("note"),
    )
    spec = HistorySpec(["key"], rows.columns)
    place = F.col("key") % 200
    old = initial_load(rows.where(place != 11), spec, AS_OF.replace(year=2023), staging)
    history = staging.write(old, "history")
    changed = F.when(place.isin(3, 5, 13, 15), F.col("score") + 1).otherwise(F.col("score"))
    snapshot = rows.where(place != 7).withColumn("score", changed.cast("int"))
    top = max_surrogate_key(history, spec.sk).first()["max_sk"]
    return Case(spec, history, staging.write(snapshot, "snapshot"), top)


def timed(run, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def merged(case: Case) -> DataFrame:
    return merge_history(case.history, case.snapshot, case.spec, AS_OF)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    try:
        times = {name: timed(lambda n=name: QUERIES[n](spark, sf_dir), runs) for name in HEADLINE}
        customers, orders = customer_case(spark, sf_dir), order_case(spark, sf_dir)
        plain = {
            "plain_merge_history": timed(lambda: plain_merge(customers), runs),
            "plain_merge_history_orders": timed(lambda: plain_merge(orders), runs),
            "plain_initial_load": timed(lambda: plain_initial_load(customers), runs),
            "plain_apply_snapshot": timed(lambda: plain_apply_snapshot(spark, customers), runs),
            "plain_dense_row_number": timed(lambda: plain_dense_row_number(spark, sf_dir), runs),
            "plain_latest_per_key": timed(lambda: plain_latest_per_key(spark, sf_dir), runs),
        }
        n = int(os.environ.get("BENCH_KEYS", "1000000"))
        if n:
            case = generated_case(spark, n)
            times["merge_generated"] = timed(lambda: merged(case), runs)
            plain["plain_merge_generated"] = timed(lambda: plain_merge(case), runs)
            times["initial_load_generated"] = timed(
                lambda: initial_load(case.snapshot, case.spec, AS_OF), runs
            )
            plain["plain_initial_load_generated"] = timed(lambda: plain_initial_load(case), runs)
    finally:
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "comparison": plain,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
