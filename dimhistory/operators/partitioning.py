"""Shuffle partitions that follow the counted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dimhistory.functions import quoted

# Rows that one task of a join should sort.
ROWS_PER_TASK = 1_000_000


def spread(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """Hash-partition one side of a join on ``keys`` whose larger side has ``rows`` rows.

    The session's number of partitions stands unless it is far too small: tasks would
    spill, and adaptive execution merges partitions of a full outer join but cannot split
    them. Give both sides the same ``rows``, and the join needs no other exchange.
    """
    wanted = (rows or 0) // ROWS_PER_TASK + 1
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if wanted <= 2 * usual:
        return df
    return df.repartition(wanted, *[quoted(k) for k in keys])
