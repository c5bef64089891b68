"""CSV snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimhistory.errors import SchemaMismatch
from dimhistory.functions import normalize_names
from dimhistory.operators.screening import CORRUPT


def csv_columns(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> list[str]:
    """Names in the header, as written. Reads the first line only."""
    return spark.read.options(header=True, sep=delimiter).csv(path).columns


def history_columns(source_names: Sequence[str], scd_columns: Sequence[str]) -> list[str]:
    """Normalised names of a history kept for a source with these columns."""
    return normalize_names([*source_names, *scd_columns])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    delimiter: str = ",",
) -> DataFrame:
    """Read a CSV with a header under normalised column names.

    With ``schema`` the columns take its types by normalised name, in any order of the
    header. Otherwise values stay text, for ``screen_snapshot`` to convert and reject by row,
    and lines with too few or too many values are kept whole in the column ``CORRUPT``, which
    makes it reject them. ``infer`` asks for one more pass to guess types instead. Of several
    files all must have the first one's header.
    """
    names = csv_columns(spark, path, delimiter)
    normalized = normalize_names(names)
    reader = spark.read.options(header=True, sep=delimiter, enforceSchema=False)
    if schema is not None:
        if set(normalized) != set(schema.names):
            raise SchemaMismatch(f"{path} has columns {normalized}, expected {schema.names}")
        fields = [
            T.StructField(name, schema[norm].dataType)
            for name, norm in zip(names, normalized, strict=True)
        ]
        reader = reader.schema(T.StructType(fields)).option("mode", "FAILFAST")
    elif infer:
        reader = reader.option("inferSchema", True)
    else:
        text = [T.StructField(name, T.StringType()) for name in [*names, CORRUPT]]
        # a line's values can only be counted when all of them are parsed
        reader = reader.schema(T.StructType(text)).options(
            columnNameOfCorruptRecord=CORRUPT, columnPruning=False
        )
        normalized = [*normalized, CORRUPT]
    return reader.csv(path).toDF(*normalized)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.options(header=True, sep=delimiter).csv(path)
