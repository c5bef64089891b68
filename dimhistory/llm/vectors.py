"""Vectors in whole numbers, so that distances and products are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The largest component after scaling. Squares of differences and products of more than 100
#: dimensions still fit 64 bits.
LARGEST = 1 << 27


def scaled(
    df: DataFrame,
    factor: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int | None = None,
) -> DataFrame:
    """``(id, vector)``, the vectors as ``floor(factor * x)`` of each component, x as double.

    Left out are null vectors, those that hold a null, NaN or an infinity, and, where
    ``dimensions`` is given, those with another number of components. A component beyond
    ``LARGEST`` after scaling is an error: its square would not fit. Repeated rows stay, null ids
    too; all other columns are left behind, so their names cannot clash.
    """
    vector = F.col(vector_col)
    usable = vector.isNotNull() & F.forall(vector, _finite)
    if dimensions is not None:
        usable = usable & (F.size(vector) == dimensions)
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
    fits = F.forall(whole, lambda x: F.abs(x) <= LARGEST)
    refused = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling by {factor}"))
    return df.where(usable).select(
        F.col(id_col).alias("id"),
        F.when(fits, F.transform(whole, lambda x: x.cast("int"))).otherwise(refused).alias("vector"),
    )


def _finite(x: Column) -> Column:
    # NaN is larger than infinity in Spark
    return F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """The rows of a list column as one array; shorter rows end in zeros up to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    widest = int(sizes.max(initial=0)) if width is None else width
    if len(values) == len(sizes) * widest:
        return values.reshape(len(sizes), widest)
    rows = np.zeros((len(sizes), widest), values.dtype)
    rows[np.arange(widest) < sizes[:, None]] = values
    return rows
