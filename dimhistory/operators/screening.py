"""Checks and clean-up of the inputs before anything is compared."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory.errors import CorruptHistory, DuplicateKeys, HistoryError, SchemaMismatch
from dimhistory.functions import project, quoted, sql_date, sql_name
from dimhistory.sources.staging import Staging
from dimhistory.spec import HistorySpec

REASON = "reject_reason"
# Readers put the text of a malformed line here; such a row is rejected as a whole.
CORRUPT = "corrupt_record"
_WHY, _CAME = "__why", "__came"


def screen_snapshot(
    snapshot: DataFrame, schema: T.StructType, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split a snapshot into rows of ``schema`` and rejected rows with a reason.

    A row is rejected when its line was malformed, when a value does not convert to the type
    the history stores or would lose something by it, or when a key column is null. The
    rejected rows keep their values as they came.
    """
    reason, converted = _screen(snapshot, schema, keys)
    return (
        snapshot.where(reason.isNull()).select(*converted),
        snapshot.withColumn(REASON, reason).where(quoted(REASON).isNotNull()),
    )


@dataclass(frozen=True)
class Screened:
    """A snapshot that was read once, and the rows of its two parts."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


def screen_once(
    snapshot: DataFrame, schema: T.StructType, keys: Sequence[str], staging: Staging
) -> Screened:
    """``screen_snapshot`` for a source that is read once: the rows are staged with their verdict.

    Rejected rows keep their values in a column that is null for all others. Both parts are
    counted by the tasks that write them.
    """
    reason, converted = _screen(snapshot, schema, keys)
    as_it_came = F.expr("named_struct({})".format(
        ", ".join(f"{_text(c)}, {sql_name(c)}" for c in snapshot.columns)
    ))
    rows, n = staging.observed(
        snapshot.select(
            reason.alias(_WHY), F.when(reason.isNotNull(), as_it_came).alias(_CAME), *converted
        ),
        "screened",
        {"accepted": f"count_if({_WHY} IS NULL)", "rejected": f"count_if({_WHY} IS NOT NULL)"},
    )
    rejected = rows.where(f"{_WHY} IS NOT NULL")
    return Screened(
        project(rows.where(f"{_WHY} IS NULL"), schema.names),
        rejected.selectExpr(
            *[f"{_CAME}.{sql_name(c)} AS {sql_name(c)}" for c in snapshot.columns],
            f"{_WHY} AS {REASON}",
        ),
        n["accepted"],
        n["rejected"],
    )


def usable_keys(rejected: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Keys of rejected rows that still say which entity a row is about."""
    lines = rejected.where(quoted(CORRUPT).isNull()) if CORRUPT in rejected.columns else rejected
    found, whole = [], F.lit(True)
    for name in keys:
        value, kept = _convert(quoted(name), lines.schema[name].dataType, schema[name].dataType)
        found.append(value.alias(name))
        whole = whole & quoted(name).isNotNull() & kept
    return lines.where(whole).select(*found).distinct()


def _text(value: str) -> str:
    """A text as SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _screen(
    snapshot: DataFrame, schema: T.StructType, keys: Sequence[str]
) -> tuple[Column, list[Column]]:
    columns = [c for c in snapshot.columns if c != CORRUPT or CORRUPT in schema.names]
    if set(columns) != set(schema.names) or len(columns) != len(schema.names):
        raise SchemaMismatch(f"snapshot has {sorted(columns)}, history stores {sorted(schema.names)}")
    problems: list[Column] = []
    if len(columns) < len(snapshot.columns):
        problems.append(F.when(quoted(CORRUPT).isNotNull(), F.lit("malformed line")))
    converted: list[Column] = []
    for field in schema.fields:
        column, source = quoted(field.name), snapshot.schema[field.name].dataType
        if source == field.dataType:
            converted.append(column)
            continue
        value, kept = _convert(column, source, field.dataType)
        problems.append(F.when(column.isNotNull() & ~kept, F.lit(f"bad value: {field.name}")))
        converted.append(value.alias(field.name))
    problems += [
        F.expr(f"if({sql_name(k)} IS NULL, {_text(f'null key: {k}')}, NULL)") for k in keys
    ]
    return F.coalesce(*problems), converted


def _convert(column: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """The converted value, and whether nothing was lost by the conversion.

    Texts must say the same as the text of the value they became; other values must come back
    from the value they became. Types that no rule covers only have to convert.
    """
    if source == target:
        return column, F.lit(True)
    value = column.try_cast(target)
    kept = value.isNotNull()
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(source, plain) and isinstance(target, plain):
        # compared in one type, so nothing is rounded by the comparison
        kept = kept & value.try_cast(source).eqNullSafe(column)
    elif isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        kept = kept & _same_number(column, value, target)
    elif isinstance(source, T.StringType) and isinstance(target, T.DateType):
        kept = kept & _wall_clock(column).eqNullSafe(value.cast(T.TimestampNTZType())) & ~_has_zone(column)
    elif isinstance(source, T.StringType) and isinstance(target, T.TimestampType | T.TimestampNTZType):
        kept = kept & _wall_clock(column).eqNullSafe(value.cast(T.TimestampNTZType())) & ~_has_nanos(column)
        if isinstance(target, T.TimestampNTZType):
            kept = kept & ~_has_zone(column)
    return value, F.coalesce(kept, F.lit(False))


_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,9}))?\s*$"
#: Numbers without digits beyond ``_EXACT``, unless they are too large for it.
_PLAIN = r"^[+-]?[0-9]{1,19}(?:\.[0-9]{0,19})?(?:[eE]\+?[0-9]{1,2})?\z"
_EXACT = T.DecimalType(38, 19)


def _written_number(text: Column) -> Column:
    """Sign, digits without zeros at their ends, and the power of ten of the last digit.

    Texts of equal numbers give equal results, whatever their length: ``1.50``, ``+1.5`` and
    ``15e-1`` do. Null for what is no number in digits.
    """
    names = ("sign", "whole", "part", "power")
    parts = F.struct(*[F.regexp_extract(text, _NUMBER, i).alias(n) for i, n in enumerate(names, 1)])

    def number(found: Column) -> Column:
        sign, whole, part, power = (found[n] for n in names)
        digits = F.ltrim(F.concat(whole, part), F.lit("0"))
        bare = F.rtrim(digits, F.lit("0"))
        shift = F.coalesce(power.try_cast("int"), F.lit(0)) - F.length(part)
        zero = F.struct(F.lit("").alias("sign"), F.lit("0").alias("digits"), F.lit(0).alias("power"))
        other = F.struct(
            F.when(sign == "-", "-").otherwise("").alias("sign"),
            bare.alias("digits"),
            (shift + F.length(digits) - F.length(bare)).alias("power"),
        )
        return F.when(bare == "", zero).otherwise(other)

    in_digits = text.rlike(_NUMBER) & text.rlike("[0-9]")
    # an array of one, so that each part is looked for once
    return F.when(in_digits, F.transform(F.array(parts), number)[0])


def _same_number(text: Column, value: Column, target: T.DataType) -> Column:
    """Whether a text and the number it became are written alike, up to zeros and notation.

    Plain ones are compared as decimals that hold all their digits; only others, and those too
    large for that, digit by digit.
    """
    shown = value.cast("string")
    same = _written_number(text) == _written_number(shown)
    if isinstance(target, T.FloatType | T.DoubleType):
        # words such as NaN and Infinity are no digits, a number that became infinite is
        word = F.isnan(value) | (F.abs(value) == float("inf"))
        same = F.when(_written_number(text).isNull(), word).otherwise(same)
        plain, exact = text.rlike(_PLAIN) & shown.rlike(_PLAIN), shown.try_cast(_EXACT)
    else:
        plain, exact = text.rlike(_PLAIN), value.try_cast(_EXACT)
    return F.coalesce(F.when(plain, text.try_cast(_EXACT) == exact), same)


_CLOCK = r"^\s*([+-]?\d+(?:-\d{1,2}(?:-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)?)?)?)"


def _wall_clock(text: Column) -> Column:
    """Date and time as a text gives them, without regard to a zone behind them."""
    return F.regexp_extract(text, _CLOCK, 1).try_cast(T.TimestampNTZType())


def _has_zone(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, _CLOCK, "")) != ""


def _has_nanos(text: Column) -> Column:
    """Whether a time says more than microseconds."""
    return text.rlike(r"\.\d{6}\d*[1-9]")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Keep the row with the largest ``order_by`` of each key.

    Equal order values fall to the largest remaining columns, so the result does not
    depend on row order. Copies of one key are reduced before the shuffle.
    """
    rest = [name for name in df.columns if name not in (*keys, order_by)]
    best = F.max(F.struct(*[quoted(name) for name in [order_by, *rest]]))
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(best.alias("__best"))
        .select(
            *[
                quoted(name) if name in keys else F.col("__best").getField(name).alias(name)
                for name in df.columns
            ]
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Counted before and after the shuffle of the keys."""
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    examples = duplicate_keys(df, keys).limit(5).collect()
    if examples:
        raise DuplicateKeys(f"{what} has duplicate keys, among them {[r.asDict() for r in examples]}")


@dataclass(frozen=True)
class Profile:
    """What a load needs to know about a history."""

    active_rows: int = 0
    max_sk: int = 0
    last_start: dt.date | None = None
    closed_rows: int = 0
    last_end: dt.date | None = None

    def require_not_before(self, as_of: dt.date) -> None:
        """Refuse a load that would start versions before others start or end.

        A closed version that ends later than ``as_of`` would overlap a new one of its key.
        """
        if self.last_start is not None and as_of < self.last_start:
            raise HistoryError(f"{as_of} is before {self.last_start}, when the newest version starts")
        if self.last_end is not None and as_of < self.last_end:
            raise HistoryError(f"{as_of} is before {self.last_end}, when a closed version ends")


def broken_rows(spec: HistorySpec) -> dict[str, str]:
    """Conditions, as SQL, that no row of a history may meet; each is true or false, never null."""
    flag, sk, start, end = map(sql_name, (spec.flag, spec.sk, spec.effective, spec.expiration))
    null_key = " OR ".join(f"{sql_name(k)} IS NULL" for k in spec.keys)
    open_end = f"{end} <=> {sql_date(spec.end_date)}"
    return {
        "null flag": f"{flag} IS NULL",
        "null surrogate key": f"{sk} IS NULL",
        "null business key": f"{flag} <=> true AND ({null_key})",
        "null effective date": f"{start} IS NULL",
        "null expiration date": f"{end} IS NULL",
        "end before start": f"coalesce({start} > {end}, false)",
        "end of an active row": f"{flag} <=> true AND {end} IS NOT NULL AND NOT ({open_end})",
        "open end of a closed row": f"{flag} <=> false AND {open_end}",
    }


def profile_metrics(spec: HistorySpec, among: str = "true") -> dict[str, str]:
    """Aggregates, as SQL, from which :func:`measured` makes a profile of the rows ``among``."""
    flag, sk, start, end = map(sql_name, (spec.flag, spec.sk, spec.effective, spec.expiration))
    return {
        "active": f"count_if({flag})",
        "closed": f"count_if(NOT {flag})",
        "sk": f"max({sk})",
        "start": f"max(if({flag}, {start}, NULL))",
        "end": f"max(if({flag}, NULL, {end}))",
        **{why: f"count_if(({among}) AND {bad})" for why, bad in broken_rows(spec).items()},
    }


def measured(spec: HistorySpec, found: dict) -> Profile:
    """The profile out of ``profile_metrics``; a history that breaks a rule is refused."""
    broken = {why: found[why] for why in broken_rows(spec) if found[why]}
    if broken:
        raise CorruptHistory(f"rows that break the history: {broken}")
    return Profile(found["active"], found["sk"] or 0, found["start"], found["closed"], found["end"])


def profile(spec: HistorySpec, history: DataFrame) -> Profile:
    """Count a history in one narrow pass, and refuse what no history may hold.

    That is null flags, keys, surrogate keys or dates, intervals that end before they start, and
    intervals that are open or closed against their flag.
    """
    metrics = [f"{sql} AS `{name}`" for name, sql in profile_metrics(spec).items()]
    return measured(spec, history.selectExpr(*metrics).first().asDict())
