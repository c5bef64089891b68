"""Small frames and a dictionary model of the merge."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimhistory import HistorySpec

D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 6, 1), dt.date(2024, 7, 1)
END = dt.date(9999, 12, 31)

SOURCE = T.StructType(
    [
        T.StructField("customerid", T.LongType()),
        T.StructField("genre", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("annual_income_(k$)", T.IntegerType()),
        T.StructField("spending_score", T.IntegerType()),
    ]
)
SPEC = HistorySpec(["customerid"], SOURCE.names, sk="sk_customerid")

AB = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("a", T.StringType()),
        T.StructField("b", T.IntegerType()),
    ]
)
AB_SPEC = HistorySpec(["k"], ["a", "b"])


def frame(spark, schema, rows):
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def ab(spark, *rows):
    return frame(spark, AB, list(rows))


def ab_history(spark, *rows):
    """Rows of (k, a, b, sk, effective, expiration, flag)."""
    return frame(spark, AB_SPEC.history_schema(AB), list(rows))


def collected(df, order="sk"):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[df.columns.index(order)])


def model_initial(rows, as_of):
    return [(*row, i, as_of, END, True) for i, row in enumerate(sorted(rows), 1)]


def model_merge(history, snapshot, as_of):
    """Merge for rows of (k, a, b), one key column, as plain dictionaries."""
    incoming = {row[0]: row for row in snapshot}
    active = {row[0]: row for row in history if row[6]}
    top = max((row[3] for row in history), default=0)
    result, updated = [], []
    for row in history:
        new = incoming.get(row[0])
        if not row[6] or (new is not None and new[1:] == row[1:3]):
            result.append(row)
            continue
        result.append((*row[:5], as_of, False))
        if new is not None:
            updated.append(new)
    inserted = [row for key, row in incoming.items() if key not in active]
    opened = sorted(inserted) + sorted(updated, key=lambda r: r[0])
    result += [(*row, top + i, as_of, END, True) for i, row in enumerate(opened, 1)]
    return sorted(result, key=lambda r: r[3])
