"""What a history table looks like: its keys, tracked columns and validity columns."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

END_OF_TIME = dt.date(9999, 12, 31)

NOCHANGE, INSERT, DELETE, UPDATE = "NOCHANGE", "INSERT", "DELETE", "UPDATE"


@dataclass(frozen=True)
class HistorySpec:
    """Names and rules of one type-2 history.

    ``keys`` identify a business entity, a change in any ``tracked`` column opens a
    new version. ``compare`` is ``"exact"`` (null-safe column comparison) or ``"md5"``
    (fingerprint of the concatenated texts, which ignores nulls and separators).
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    sk: str = "sk"
    effective: str = "effective_date"
    expiration: str = "expiration_date"
    flag: str = "current_flag"
    end_date: dt.date = END_OF_TIME
    compare: str = "exact"

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))
        object.__setattr__(self, "tracked", tuple(self.tracked))
        if not self.keys:
            raise ValueError("a history needs at least one business key column")
        if self.compare not in ("exact", "md5"):
            raise ValueError(f"compare must be 'exact' or 'md5', not {self.compare!r}")

    @property
    def scd_columns(self) -> tuple[str, ...]:
        return (self.sk, self.effective, self.expiration, self.flag)

    def attributes(self, schema: T.StructType) -> list[str]:
        """Columns that come from the source, in the order of ``schema``."""
        return [name for name in schema.names if name not in self.scd_columns]

    def source_schema(self, history_schema: T.StructType) -> T.StructType:
        return T.StructType([history_schema[c] for c in self.attributes(history_schema)])

    def history_schema(self, source_schema: T.StructType) -> T.StructType:
        """Schema of the history kept for a source of ``source_schema``."""
        missing = [c for c in self.keys + self.tracked if c not in source_schema.names]
        if missing:
            raise ValueError(f"source lacks key or tracked columns: {missing}")
        clash = [c for c in self.scd_columns if c in source_schema.names]
        if clash:
            raise ValueError(f"source columns clash with validity columns: {clash}")
        return T.StructType(
            list(source_schema.fields)
            + [
                T.StructField(self.sk, T.LongType()),
                T.StructField(self.effective, T.DateType()),
                T.StructField(self.expiration, T.DateType()),
                T.StructField(self.flag, T.BooleanType()),
            ]
        )
