"""A stored history: one table of the session's catalog, in Parquet files as Spark writes them.

The table is partitioned by the flag and by a part, and clustered by key into buckets.

* Active rows lie in a fixed number of parts, by a hash of their key: a load writes the parts
  that it changes, by dynamic partition overwrite, and no others.
* Closed rows of a load are a part of their own: they are written once.
* Buckets follow the same hash, so a part has few of them, and the join of the active rows with
  a snapshot by key moves the snapshot only.

A load is one write that Spark commits at its end. One that fails before leaves the table as it
was. The commit itself replaces one folder after the other: readers may see some parts before and
others after a load, and a driver lost at that moment leaves the table locked, so that no load
builds on it unseen. What must be seen as one state should be read between loads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimhistory.errors import ConcurrentPublish, CorruptHistory, HistoryError, SchemaMismatch
from dimhistory.functions import project, quoted, sql_name
from dimhistory.operators.changes import filter_active, filter_inactive
from dimhistory.operators.screening import Profile, broken_rows, profile, profile_metrics
from dimhistory.sources import files
from dimhistory.sources.catalog import ensure_table, table_exists
from dimhistory.spec import HistorySpec

#: The column of the parts. Active ones are numbered, closed ones are named after their load.
PART = "dimhistory_part"
_PARTS, _BUCKETS = "dimhistory.parts", "dimhistory.buckets"
_MODE = "spark.sql.sources.partitionOverwriteMode"
_LOCK = "_loading"
_BROKEN = "a row breaks the history"

#: A partition: whether its rows are active, and its part.
Place = tuple[bool, str]


class HistoryTable:
    """The table ``name`` of the catalog, created by the first load with the sizes given here.

    ``buckets`` is a multiple of ``parts``; a bucket of active rows should be what one task
    handles at ease, and a part what a change of one key may rewrite. An existing table keeps its
    own sizes.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        spec: HistorySpec,
        location: str | None = None,
        parts: int = 16,
        buckets: int = 16,
    ):
        if parts < 1 or buckets % parts:
            raise ValueError("buckets must be a multiple of parts")
        self.spark, self.name, self.spec = spark, name, spec
        self._location, self._parts, self._buckets = location, parts, buckets

    # the table

    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def ensure(self, source_schema: T.StructType) -> bool:
        """Create an empty table unless it exists; True when it was created."""
        return self._ensure(self.spec.history_schema(source_schema))

    def _ensure(self, schema: T.StructType) -> bool:
        fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
        created = ensure_table(
            self.spark,
            self.name,
            T.StructType([*fields, T.StructField(PART, T.StringType())]),
            self.spec.flag,
            self._location,
            then_by=[PART],
            keys=self.spec.keys,
            buckets=self._buckets,
            properties={_PARTS: self._parts, _BUCKETS: self._buckets},
        )
        if created:
            self.sizes = (self._parts, self._buckets)
        return created

    def _table(self) -> DataFrame:
        try:
            return self.spark.table(self.name)
        except AnalysisException as error:
            raise HistoryError(f"there is no table {self.name}") from error

    @cached_property
    def sizes(self) -> tuple[int, int]:
        """Parts and buckets of the table."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        found = {r["key"]: r["value"] for r in rows}
        return int(found[_PARTS]), int(found[_BUCKETS])

    @cached_property
    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()
        return next(r["data_type"] for r in rows if r["col_name"] == "Location")

    # reading

    def read(self) -> DataFrame:
        """All rows. A filter on the flag reads the folders of that flag only."""
        table = self._table()
        return project(table, self._names(table))

    def _names(self, table: DataFrame) -> list[str]:
        names = [n for n in table.columns if n not in (PART, *self.spec.scd_columns)]
        return [*names, *self.spec.scd_columns]

    def read_with_part(self) -> DataFrame:
        table = self._table()
        return project(table, [*self._names(table), PART])

    def read_active(self) -> DataFrame:
        return filter_active(self.read(), self.spec)

    def read_closed(self) -> DataFrame:
        return filter_inactive(self.read(), self.spec)

    def closed_profile(self) -> Profile:
        """What the closed rows tell, from three of their columns."""
        return profile(self.spec, self.read_closed())

    def rejects_path(self, load: str) -> str:
        return f"{self.location}/_rejects/{load}"

    def read_rejects(self, load: str) -> DataFrame:
        """The rows that a load rejected."""
        if not files.exists(self.spark, self.rejects_path(load)):
            raise HistoryError(f"load {load} of {self.name} rejected no rows")
        return self.spark.read.parquet(self.rejects_path(load))

    # parts

    def part_of(self, active: Column, load: str) -> Column:
        """The part of a row: by its key, or that of the load which closes it."""
        place = F.pmod(F.hash(*[quoted(k) for k in self.spec.keys]), F.lit(self.sizes[0]))
        return F.when(active, F.format_string("active-%05d", place)).otherwise(F.lit(f"closed-{load}"))

    @staticmethod
    def part_name(part: int) -> str:
        return f"active-{part:05}"

    def with_part(self, rows: DataFrame, load: str) -> DataFrame:
        return rows.withColumn(PART, self.part_of(quoted(self.spec.flag), load))

    def read_parts(self, places: Iterable[Place]) -> DataFrame:
        """The rows of some partitions, with their part; no others are read."""
        flag = sql_name(self.spec.flag)
        chosen = [f"({flag} = {str(a).lower()} AND {PART} = '{p}')" for a, p in sorted(places)]
        return self.read_with_part().where(" OR ".join(chosen) or "false")

    def partitions(self) -> set[Place]:
        """Flag and part of all partitions."""
        found = set()
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            flag, part = (piece.partition("=")[2] for piece in row["partition"].split("/"))
            found.add((flag == "true", part))
        return found

    # writing

    @contextmanager
    def loading(self) -> Iterator[str]:
        """The time of one load, which no other may share; gives the load's name.

        The lock is a file below the table. A driver that is lost leaves it there: look whether
        its load was committed, then call ``unlock``.
        """
        lock = f"{self.location}/{_LOCK}"
        if not files.create_new(self.spark, lock):
            raise ConcurrentPublish(f"another load of {self.name} is under way, or broke off: {lock}")
        try:
            yield uuid.uuid4().hex[:12]
        finally:
            self.unlock()

    def unlock(self) -> None:
        files.delete(self.spark, f"{self.location}/{_LOCK}")

    def placed(self, rows: DataFrame, load: str, few: bool = False) -> DataFrame:
        """Rows of a load with their part, dealt so that each bucket of a part is one file.

        Buckets are dealt to one task each, or if there are ``few`` rows to one task altogether.
        """
        rows = self.with_part(rows, load)
        if few:
            return rows.coalesce(1)
        return rows.repartition(self.sizes[1], *[quoted(k) for k in self.spec.keys])

    def append(self, rows: DataFrame) -> None:
        """Add ``rows`` (with their part) in one commit."""
        self._commit(rows, overwrite=False)

    def overwrite_parts(
        self,
        rows: DataFrame,
        may_empty: Iterable[Place] = (),
        metrics: dict[str, str] | None = None,
        where: str = "true",
        drop: Sequence[str] = (),
    ) -> dict:
        """Make ``rows`` (with their part) the contents of the partitions they lie in, in one commit.

        All other partitions stay as they are, but for those of ``may_empty`` that got no row,
        which are dropped after the commit; until then the load's lock is held. ``metrics`` are SQL
        aggregates of all rows, of which ``where`` chooses those to be written, without the
        columns ``drop``. A row that no history may hold stops the write before its commit.
        """
        taken, places = Observation(), sorted(may_empty)
        flag = sql_name(self.spec.flag)
        wanted = {"written": f"count_if({where})"} | (metrics or {})
        for i, (active, part) in enumerate(places):
            here = f"{flag} = {str(active).lower()} AND {PART} = '{part}'"
            wanted[f"place {i}"] = f"coalesce(max(({where}) AND {here}), false)"
        seen = rows.observe(taken, *[F.expr(f"{sql} AS `{name}`") for name, sql in wanted.items()])
        self._commit(seen.where(where).drop(*drop), overwrite=True)
        result = taken.get
        for i, place in enumerate(places):
            if not result[f"place {i}"]:
                self._drop(place)
        return result

    def overwrite(self, history: DataFrame) -> None:
        """Replace the contents with a complete history, which is read once."""
        self._ensure(history.schema)
        with self.loading() as load:
            self.replace(history, load)

    def replace(self, history: DataFrame, load: str) -> dict:
        """``overwrite`` within a load; returns what was written, counted on the way."""
        old = self.partitions()
        rows = self.placed(history, load)
        active = {place for place in old if place[0]}
        result = self.overwrite_parts(rows, may_empty=active, metrics=profile_metrics(self.spec))
        for place in sorted(old - active):
            self._drop(place)
        return result

    def _commit(self, rows: DataFrame, overwrite: bool) -> None:
        table = self._table()
        names = {f.name: f.dataType for f in rows.schema if f.name != PART}
        if names != {f.name: f.dataType for f in table.schema if f.name != PART}:
            raise SchemaMismatch(f"rows have {names}, {self.name} has {table.schema.simpleString()}")
        rows = project(self._sound(rows), table.columns)
        before = self.spark.conf.get(_MODE)
        self.spark.conf.set(_MODE, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=overwrite)
        except Exception as error:
            if _BROKEN in str(error):
                raise CorruptHistory(str(error).partition(_BROKEN)[2].split("\n")[0]) from error
            raise
        finally:
            self.spark.conf.set(_MODE, before)

    def _sound(self, rows: DataFrame) -> DataFrame:
        flag = sql_name(self.spec.flag)
        why = " ".join(f"WHEN {bad} THEN '{reason}'" for reason, bad in broken_rows(self.spec).items())
        refused = f"raise_error(concat('{_BROKEN}: ', CASE {why} END))"
        sound = " AND ".join(f"NOT ({bad})" for bad in broken_rows(self.spec).values())
        return rows.withColumn(self.spec.flag, F.expr(f"if({sound}, {flag}, boolean({refused}))"))

    def _drop(self, place: Place) -> None:
        active, part = place
        flag, value = sql_name(self.spec.flag), str(active).lower()
        self.spark.sql(
            f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({flag} = {value}, {PART} = '{part}')"
        )
        # the files of an external table stay behind
        files.delete(self.spark, f"{self.location}/{self.spec.flag}={value}/{PART}={part}")
