"""Intermediate results written once to the folder all executors share.

A written table cuts lineage: later steps neither recompute a join nor depend on the
executors that ran it, and Spark plans them from the written sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimhistory.sources import files


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local one only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="dimhistory-")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


#: The folder below which new ones are made, if it isn't the session's.
_WITHIN: ContextVar[str | None] = ContextVar("within", default=None)


class Staging:
    """One folder of staged tables. As a context manager it is dropped at the end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{_WITHIN.get() or shared_folder(spark)}/dimhistory-{uuid.uuid4().hex}"

    @contextmanager
    def holding(self) -> Iterator[None]:
        """Make the folders of all ``Staging`` created meanwhile below this one.

        What operators staged on the way can then be dropped together, once their result is
        written.
        """
        before = _WITHIN.set(self.path)
        try:
            yield
        finally:
            _WITHIN.reset(before)

    def write(
        self, df: DataFrame, name: str, by: str | None = None, at: str | None = None, **options: str
    ) -> DataFrame:
        """Write ``df``, with options of the Parquet writer, and return it as read back.

        ``by`` names a column whose values get a folder each. ``at`` is another place for the
        table, which then outlives the staging.
        """
        path = at or f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        writer = df.write.options(**options)
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def observed(
        self,
        df: DataFrame,
        name: str,
        metrics: dict[str, str],
        where: str | None = None,
        by: str | None = None,
    ) -> tuple[DataFrame, dict]:
        """``write`` that also returns SQL aggregates of all rows, taken by the tasks that write them.

        ``where`` chooses what is written of the rows that are measured. Nothing is read again to
        be counted, and the numbers belong to the rows written even if the source changes.
        """
        taken = Observation()
        df = df.observe(taken, *[F.expr(f"{sql} AS `{key}`") for key, sql in metrics.items()])
        written = self.write(df if where is None else df.where(where), name, by=by)
        return written, taken.get

    def drop(self) -> None:
        files.delete(self.spark, self.path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *exc) -> None:
        self.drop()
