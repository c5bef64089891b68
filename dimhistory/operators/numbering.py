"""Dense row numbers in a global order, without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory.errors import DuplicateKeys
from dimhistory.functions import project, quoted
from dimhistory.operators.screening import require_unique
from dimhistory.sources.staging import Staging

_TIE, _TASK, _COPIES = "__tie", "__task", "__copies"
_POSITION, _RANGE, _OFFSET = "__position", "__range", "__offset"
# Rows that one task sorts.
ROWS_PER_RANGE = 1_000_000
# Rows that one task numbers alone; the same numbers as any other way gives.
ROWS_ALONE = 100_000
# monotonically_increasing_id keeps the partition above bit 33 and the row below it
_ROW_BITS = 33


def dense_row_number(
    df: DataFrame,
    order_by: Sequence[str],
    into: str,
    staging: Staging,
    start: int = 0,
    unique: bool = False,
    rows: int | None = None,
    verified: bool = False,
) -> DataFrame:
    """Add ``start + 1, start + 2, ...`` in the order of ``order_by``, nulls first.

    Up to ``ROWS_ALONE`` rows, if ``rows`` tells so, are numbered by one task in one go. More
    rows are range-partitioned, sorted and written once, whole, with their place in their range;
    the rows of the ranges before are added when they are read. Nothing is joined but one number
    per range. ``rows``, if known, sets the number of ranges.

    With ``unique`` the order values identify a row, and repeated ones are an error, which need
    not be searched for when the caller has ``verified`` that there are none. Otherwise rows that
    tie are told apart by a hash of all their columns, and rows alike in all of them by the task
    that read them, so that a run of equal order values spreads over many ranges.
    """
    by = [quoted(name) for name in order_by]
    if rows is not None and rows <= ROWS_ALONE:
        if unique and not verified:
            require_unique(df, order_by, "what is to be numbered")
        place = F.row_number().over(Window.orderBy(*by)).cast("bigint") + start
        return df.withColumn(into, place)
    sort = by
    if not unique:
        df = df.withColumn(_TIE, _row_hash(df)).withColumn(_TASK, F.spark_partition_id())
        sort = [*by, F.col(_TIE), F.col(_TASK)]
    ranges = [] if rows is None else [rows // ROWS_PER_RANGE + 2]
    ordered = df.repartitionByRange(*ranges, *sort).sortWithinPartitions(*sort).drop(_TIE, _TASK)
    copies = F.lit(1)
    if unique and not verified:
        # copies meet in one range and follow each other: no other exchange, no other sort
        copies = F.count(F.lit(1)).over(Window.partitionBy(*by))
    placed, seen = staging.observed(
        ordered.withColumn(_COPIES, copies).withColumn(_POSITION, F.monotonically_increasing_id()),
        "positions",
        {"copies": f"max({_COPIES})", "last": f"max(shiftright({_POSITION}, {_ROW_BITS}))"},
    )
    if (seen["copies"] or 0) > 1:
        repeated = project(placed.where(F.col(_COPIES) > 1), order_by)
        examples = [tuple(row) for row in repeated.limit(5).collect()]
        raise DuplicateKeys(f"repeated values of {list(order_by)}, among them {examples}")
    placed = placed.drop(_COPIES).withColumn(_RANGE, F.shiftright(_POSITION, _ROW_BITS))
    in_range = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if seen["last"]:
        placed = placed.join(F.broadcast(_offsets(placed, start)), _RANGE)
    else:
        placed = placed.withColumn(_OFFSET, F.lit(start).cast("bigint"))
    numbered = placed.withColumn(into, F.col(_OFFSET) + in_range + 1)
    return numbered.drop(_RANGE, _OFFSET, _POSITION)


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed; a map cannot."""
    return F.xxhash64(*[quoted(f.name) for f in df.schema if not _holds_map(f.dataType)], F.lit(0))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType | T.VariantType)


def _offsets(placed: DataFrame, start: int) -> DataFrame:
    """Rows before each range. One row per shuffle partition, however many rows there are."""
    ranges = placed.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n")).collect()
    ranges.sort(key=lambda r: r[_RANGE])
    before = list(accumulate((r["n"] for r in ranges), initial=start))[:-1]
    table = pa.table(
        {
            _RANGE: pa.array([r[_RANGE] for r in ranges], pa.int64()),
            _OFFSET: pa.array(before, pa.int64()),
        }
    )
    return placed.sparkSession.createDataFrame(table)


def assign_surrogate_keys(
    df: DataFrame,
    keys: Sequence[str],
    sk: str,
    staging: Staging,
    start: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """Number rows of unique ``keys`` from ``start + 1`` in key order, a null key first.

    ``df`` is read twice, the first time for its keys alone: stage it if that is dear.
    """
    return dense_row_number(df, keys, sk, staging, start=start, unique=True, rows=rows)


def max_surrogate_key(history: DataFrame, sk: str) -> DataFrame:
    """One row: the largest key in use, 0 for an empty history."""
    largest = F.coalesce(F.max(quoted(sk)), F.lit(0)).cast("bigint")
    return history.agg(largest.alias("max_sk"))
