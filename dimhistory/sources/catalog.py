"""History tables by name in the session's catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    flag: str | None = None,
    location: str | None = None,
    then_by: Sequence[str] = (),
    keys: Sequence[str] = (),
    buckets: int = 0,
    properties: Mapping[str, object] | None = None,
) -> bool:
    """Create a Parquet table unless it exists; True when it was created.

    ``flag`` partitions the table, so that scans of the active rows skip all others, and
    ``then_by`` partitions it further. With ``buckets`` rows lie in so many buckets of their
    ``keys``, so that a join by them does not move the table.
    """
    if table_exists(spark, name):
        return False

    def listed(names: Sequence[str]) -> str:
        return ", ".join(_quoted(n) for n in names)

    columns = ", ".join(
        "{} {}{}".format(
            _quoted(f.name), f.dataType.simpleString(), "" if f.nullable else " NOT NULL"
        )
        for f in schema.fields
    )
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if flag is not None:
        ddl += f" PARTITIONED BY ({listed([flag, *then_by])})"
    if buckets:
        ddl += f" CLUSTERED BY ({listed(keys)}) SORTED BY ({listed(keys)}) INTO {buckets} BUCKETS"
    if location is not None:
        ddl += f" LOCATION '{location}'"
    if properties:
        ddl += " TBLPROPERTIES ({})".format(", ".join(f"'{k}' = '{v}'" for k, v in properties.items()))
    spark.sql(ddl)
    return True


def _quoted(name: str) -> str:
    return "`{}`".format(name.replace("`", "``"))
