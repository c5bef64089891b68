"""Tables of a relational database, read and written by the executors."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from dimhistory.operators.changes import filter_active
from dimhistory.sources.staging import Staging
from dimhistory.spec import HistorySpec


@dataclass(frozen=True)
class JdbcTable:
    """One table behind a JDBC url. Pass credentials in ``options``, never in code."""

    url: str
    table: str
    driver: str
    options: dict[str, str] = field(default_factory=dict)

    def _connect(self, reader_or_writer):
        return reader_or_writer.format("jdbc").options(
            url=self.url, driver=self.driver, **self.options
        )

    def quote(self, spark: SparkSession, name: str) -> str:
        """A name as the database's dialect quotes it; dots part the name of a table."""
        dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        return ".".join(dialect.quoteIdentifier(part) for part in name.split("."))

    def key_range(self, spark: SparkSession, column: str) -> tuple[int, int] | None:
        """Smallest and largest value of a numeric column, computed by the database."""
        dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        name = dialect.quoteIdentifier(column)
        query = f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {self.quote(spark, self.table)}"
        lo, hi = self._connect(spark.read).option("query", query).load().first()
        return None if lo is None else (int(lo), int(hi))

    def read(self, spark: SparkSession, partition_column: str, partitions: int) -> DataFrame:
        """Scan the table in ``partitions`` ranges of a numeric column, one task each.

        Surrogate keys are dense, so equal ranges of them hold about equal numbers of rows.
        """
        if partitions < 1:
            raise ValueError("partitions must be at least 1")
        reader = self._connect(spark.read).option("dbtable", self.quote(spark, self.table))
        bounds = self.key_range(spark, partition_column)
        if bounds is not None:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=bounds[0],
                upperBound=bounds[1] + 1,
                numPartitions=partitions,
            )
        return reader.load()

    def read_active(
        self, spark: SparkSession, staging: Staging, spec: HistorySpec, partitions: int
    ) -> DataFrame:
        """The active rows as they are now; the database filters them.

        A plain scan would be read again after each write to the table.
        """
        rows = self.read(spark, spec.sk, partitions)
        return staging.write(filter_active(rows, spec), "jdbc")

    def overwrite(self, df: DataFrame, batch_size: int = 10_000) -> None:
        """Replace all rows. Truncates, so that the table keeps its types and primary key."""
        self._write(df, "overwrite", batch_size, truncate=True)

    def append(self, df: DataFrame, batch_size: int = 10_000) -> None:
        """Insert rows, each task in its own transaction."""
        self._write(df, "append", batch_size)

    def apply_rows(
        self,
        spark: SparkSession,
        rows: DataFrame,
        keys: Sequence[str],
        batch_size: int = 10_000,
    ) -> None:
        """Insert rows, and replace those whose ``keys`` the table has.

        The executors write to a side table of this load alone. The database then moves the
        rows in one transaction, so the table shows all of them or none, and none passes the
        driver. The side table is dropped in any case.
        """
        jvm = spark._jvm
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        quoted = {name: dialect.quoteIdentifier(name) for name in rows.columns}
        columns = ", ".join(quoted.values())
        side = replace(self, table=f"{self.table}_{uuid.uuid4().hex[:12]}")
        target, source = self.quote(spark, self.table), self.quote(spark, side.table)
        same = " AND ".join(f"c.{quoted[k]} = {target}.{quoted[k]}" for k in keys)
        try:
            replace(side, table=source)._write(rows, "errorifexists", batch_size)
            self._transaction(
                jvm,
                f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {source} c WHERE {same})",
                f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {source}",
            )
        finally:
            self._transaction(jvm, f"DROP TABLE IF EXISTS {source}")

    def _transaction(self, jvm, *statements: str) -> None:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.driver)
        properties = jvm.java.util.Properties()
        for name, value in self.options.items():
            properties.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().executeUpdate(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _write(self, df: DataFrame, mode: str, batch_size: int, **options) -> None:
        self._connect(df.write).options(
            dbtable=self.table, batchsize=batch_size, **options
        ).mode(mode).save()
