"""Inserting and updating rows of a target by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory.errors import DuplicateKeys
from dimhistory.functions import append_suffix, project, quoted
from dimhistory.operators.screening import require_unique

_FOUND = "__found"
_CHANGE = "__change"
# Bits of a Bloom filter for one key, and of all; a filter is part of the plan, and the
# largest takes 32 kB. Beyond it the keys would fill the filter, and nothing is filtered.
BITS_PER_KEY, MOST_BITS = 12, 1 << 18
_PROBES = 4


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, duplicates kept; the columns must be the same."""
    for other in others:
        first = first.unionByName(other)
    return first


def _probes(keys: Sequence[str], bits: int) -> list[Column]:
    """The bits of a Bloom filter that a key sets."""
    columns = [quoted(k) for k in keys]
    first, step = F.xxhash64(*columns, F.lit(0)), F.xxhash64(*columns, F.lit(1))
    return [
        F.pmod(first + F.shiftrightunsigned(step, 34) * i, F.lit(bits)).cast("int")
        for i in range(_PROBES)
    ]


def may_be_among(rows: DataFrame, keys: Sequence[str]) -> Column | None:
    """A Bloom filter of the keys of ``rows``: false only for keys that ``rows`` lacks.

    The filter is a constant of the condition, so a scan applies it row by row before
    anything is joined. None when the keys are too many for a small one.
    """
    n = rows.count()
    bits = 1 << max(10, (n * BITS_PER_KEY).bit_length())
    if bits > MOST_BITS:
        return None
    placed = project(rows, keys).select(F.explode(F.array(*_probes(keys, bits))).alias("bit"))
    words = placed.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits")
    )
    filled = [0] * (bits >> 6)
    for row in words.collect():  # at most MOST_BITS / 64 of them
        filled[row["word"]] = row["bits"]
    table = F.array(*[F.lit(w).cast("bigint") for w in filled])
    hits = [F.getbit(F.get(table, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1 for p in _probes(keys, bits)]
    found = hits[0]
    for hit in hits[1:]:
        found = found & hit
    return found


def rows_among(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key ``rows`` has; a Bloom filter drops most others at the scan."""
    # equal values of different types, and the two zeros of a float, have different hashes
    alike = all(
        target.schema[k].dataType == rows.schema[k].dataType
        and not isinstance(rows.schema[k].dataType, T.FloatType | T.DoubleType)
        for k in keys
    )
    if alike:
        near = may_be_among(rows, keys)
        target = target if near is None else target.where(near)
    return target.join(project(rows, keys), list(keys), "left_semi")


def require_insertable(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> None:
    """Refuse rows whose key is there already or occurs twice among them."""
    require_unique(rows, keys, "insert")
    taken = rows_among(project(target, keys), rows, keys).take(1)
    if taken:
        raise DuplicateKeys(f"insert of a key the target has: {taken[0].asDict()}")


def keyed_insert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with ``rows`` added; a key that exists already is an error."""
    require_insertable(target, rows, keys)
    return union_by_name(target, project(rows, target.columns))


def keyed_update(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with every non-key column of ``rows`` set where the keys match.

    Rows without a match change nothing.
    """
    require_unique(rows, keys, "update")
    changed = append_suffix(rows, _CHANGE).withColumn(_FOUND, F.lit(True))
    same_key = [quoted(k) == quoted(k + _CHANGE) for k in keys]
    joined = target.join(changed, same_key, "left")
    return joined.select(
        *[
            F.when(F.col(_FOUND), quoted(c + _CHANGE)).otherwise(quoted(c)).alias(c)
            if c in rows.columns and c not in keys
            else quoted(c)
            for c in target.columns
        ]
    )


def apply_changes(
    target: DataFrame, rows: DataFrame, change_type: str, keys: Sequence[str]
) -> DataFrame:
    """Apply a change set of one type, ``INSERT`` or ``UPDATE``."""
    if change_type == "INSERT":
        return keyed_insert(target, rows, keys)
    if change_type == "UPDATE":
        return keyed_update(target, rows, keys)
    raise ValueError(f"change type must be INSERT or UPDATE, not {change_type!r}")
