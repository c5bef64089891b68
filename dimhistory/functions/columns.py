"""Column naming, projections, fingerprints and date stamps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT = "hash_md5"


def sql_name(name: str) -> str:
    """A name as SQL text, whatever punctuation it holds."""
    return "`" + name.replace("`", "``") + "`"


def sql_date(date: dt.date) -> str:
    """A date as SQL text."""
    return f"DATE '{date.isoformat()}'"


def quoted(name: str) -> Column:
    """Column of exactly this name, whatever punctuation it holds."""
    return F.col(sql_name(name))


def normalize_names(names: Iterable[str]) -> list[str]:
    """Strip and lower-case names; blank or clashing results are an error."""
    out = [name.strip().lower() for name in names]
    if "" in out:
        raise ValueError(f"blank column name at position {out.index('')}")
    clashes = sorted({name for name in out if out.count(name) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def append_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[name + suffix for name in df.columns])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Remove ``suffix`` where a name ends with it, and nowhere else in the name."""
    return df.toDF(*[name.removesuffix(suffix) for name in df.columns])


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.selectExpr(*map(sql_name, names))


def fingerprint(names: Sequence[str]) -> Column:
    """md5 over the texts of the columns; one constant when there are none.

    Nulls are skipped and nothing separates the texts, so different rows can share a
    fingerprint. It serves comparison with tables hashed this way.
    """
    if not names:
        return F.md5(F.lit("1"))
    return F.md5(F.concat_ws("", *[quoted(name).cast("string") for name in names]))


def with_fingerprint(df: DataFrame, names: Sequence[str], into: str = FINGERPRINT) -> DataFrame:
    return df.withColumn(into, fingerprint(names))


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def stamp_date(df: DataFrame, date: dt.date, *names: str) -> DataFrame:
    """Set DATE columns to one processing date, the same for every row and every action."""
    return df.withColumns({name: F.lit(date).cast("date") for name in names})


def format_date(df: DataFrame, name: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Show a date column as text."""
    return df.withColumn(name, F.date_format(quoted(name), pattern))
