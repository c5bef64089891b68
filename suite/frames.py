"""Histories and snapshots derived from the given tables by arithmetic on their keys.

The remainder of a key by 20 decides what the snapshot does to it: 11 is new, 7 is gone,
3 and 5 change a column, everything else stays.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimhistory import HistorySpec, Staging
from dimhistory.operators.numbering import assign_surrogate_keys

LOADED = dt.date(2024, 1, 1)
CLOSED_FROM = dt.date(2023, 1, 1)
AS_OF = dt.date(2024, 6, 1)
MONEY = "decimal(12,2)"


@dataclass(frozen=True)
class Case:
    """One stored history and the snapshot that comes next."""

    spec: HistorySpec
    history: DataFrame
    snapshot: DataFrame
    max_sk: int


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast(MONEY), "c_mktsegment"
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast(MONEY),
        F.col("o_orderdate").cast("date"),
        "o_orderpriority",
    )


def _case(
    source: DataFrame,
    keys: list[str],
    place: Column,
    legacy: dict[str, Column],
    on_three: dict[str, Column],
    on_five: dict[str, Column],
) -> Case:
    spec = HistorySpec(keys, source.columns)
    staging = Staging(source.sparkSession)
    remainder = place % 20

    def versions(rows: DataFrame, start: int, since: dt.date, until: dt.date, flag: bool) -> DataFrame:
        rows = assign_surrogate_keys(rows, spec.keys, spec.sk, staging, start=start)
        return rows.withColumns(
            {
                spec.effective: F.lit(since),
                spec.expiration: F.lit(until),
                spec.flag: F.lit(flag),
            }
        )

    base = source.where(remainder != 11)
    n_base = base.count()
    old = base.where(place % 50 == 0)
    active = versions(base, 0, LOADED, spec.end_date, True)
    inactive = versions(old.withColumns(legacy), n_base, CLOSED_FROM, LOADED, False)
    history = staging.write(active.unionByName(inactive), "history")

    def edited(name: str) -> Column:
        column = F.col(name)
        for at, edits in ((3, on_three), (5, on_five)):
            if name in edits:
                column = F.when(remainder == at, edits[name]).otherwise(column)
        return column.cast(source.schema[name].dataType).alias(name)

    snapshot = source.where(remainder != 7).select(*[edited(c) for c in source.columns])
    return Case(spec, history, snapshot, n_base + old.count())


@lru_cache(maxsize=8)
def customer_case(spark: SparkSession, sf_dir: str) -> Case:
    """The history is stored once per session: it is the input of many queries."""
    return _case(
        customers(spark, sf_dir),
        ["c_custkey"],
        F.col("c_custkey"),
        legacy={"c_mktsegment": F.lit("LEGACY")},
        on_three={"c_nationkey": (F.col("c_nationkey") + 1) % 25},
        on_five={"c_acctbal": F.col("c_acctbal") + 100},
    )


@lru_cache(maxsize=8)
def order_case(spark: SparkSession, sf_dir: str) -> Case:
    return _case(
        orders(spark, sf_dir),
        ["o_orderkey"],
        F.col("o_orderkey"),
        legacy={"o_orderstatus": F.lit("L")},
        on_three={"o_orderstatus": F.lit("X")},
        on_five={"o_totalprice": F.col("o_totalprice") + 100},
    )


@lru_cache(maxsize=8)
def conversation_case(spark: SparkSession, sf_dir: str) -> Case:
    return _case(
        read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"),
        ["conv_id", "turn"],
        F.col("conv_id") * 7 + F.col("turn"),
        legacy={"role": F.lit("legacy")},
        on_three={"text": F.concat("text", F.lit("."))},
        on_five={"role": F.lit(None).cast("string")},
    )
