"""Clustering around centroids, with distances looked up in tables.

Components are whole numbers, of which few different ones occur in a dimension. A round tabulates
the squared difference of every occurring number of a dimension to every centroid; a vector's
distances are then one look-up per dimension, and sums. Tasks return counts and sums of their
clusters, so a round moves a few numbers per task, and the vectors stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.frames import arrow_schema
from dimhistory.llm.vectors import matrix, scaled

SUMS = "cluster int, n long, sums array<long>"
ASSIGNED = "id {id}, cluster int, distance long"
#: Vectors whose distances are looked up at once.
ROWS = 4096


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of a column in order, and the place of each row's number among them."""
    low = int(column.min())
    span = int(column.max()) - low + 1
    if span > 4 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    at = column - low
    seen = np.zeros(span, bool)
    seen[at] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[at]


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of ``vectors`` (rows) to ``centroids`` (columns of the result).

    One table per dimension, of the numbers that occur here: it is never larger than the rows,
    whatever their range, and is dropped when the next dimension's is made.
    """
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for dimension in range(vectors.shape[1]):
        numbers, at = occurring(vectors[:, dimension].astype(np.int64))
        table = (numbers[:, None] - centroids[None, :, dimension]) ** 2
        total += table[at]
    return total


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)``: the nearest centroid of each row, the first of equally near ones."""
    id_type = vectors.schema["id"].dataType.simpleString()
    ddl = ASSIGNED.format(id=id_type)
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            found = distances(matrix(batch.column(1)), centroids)
            nearest = found.argmin(axis=1)
            columns = [
                batch.column(0).cast(schema.field("id").type),
                pa.array(nearest.astype(np.int32)),
                pa.array(found[np.arange(len(found)), nearest]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return vectors.select("id", "vector").mapInArrow(run, ddl)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(cluster, n, sums)``: one row per cluster and task, sums by component."""
    schema = arrow_schema(SUMS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in _batches(batches):
            rows = matrix(batch.column(0)).astype(np.int64)
            nearest = distances(rows, centroids).argmin(axis=1)
            order = np.argsort(nearest, kind="stable")
            clusters, first = np.unique(nearest[order], return_index=True)
            sums[clusters] += np.add.reduceat(rows[order], first, axis=0)
            n += np.bincount(nearest, minlength=len(n))
        full = np.flatnonzero(n)
        if len(full):
            columns = [full.astype(np.int32), n[full], sums[full].tolist()]
            made = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(made, schema=schema)

    return vectors.select("vector").mapInArrow(run, SUMS)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean by component; empty ones stay."""
    width = centroids.shape[1]
    # sums of tasks fit 64 bits, their total may not
    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    found = cluster_sums(vectors, centroids).groupBy("cluster").agg(F.sum("n").alias("n"), *total)
    after = centroids.copy()
    for row in found.collect():  # one row per centroid
        after[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(width)]
    return after


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``salt:id``, in the order of the hash.

    Rows that share an id are ordered by their components; a null id comes last.
    """
    place = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(place.asc_nulls_last(), "vector").select("vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def cluster(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    factor: int = 1024,
    dimensions: int = 64,
    salt: str = "3",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    staging: Staging | None = None,
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector.

    Vectors are kept and scaled by :func:`vectors.scaled`: null ones, and those with null or
    non-finite components or another number of them, get no row. Each of ``rounds`` rounds
    assigns every vector to its nearest centroid (of equally near ones to the smaller number) and
    moves each centroid to the floor of its vectors' mean; then all are assigned once more. With
    fewer than ``k`` vectors there are as many centroids; equal vectors may start several, of
    which only the first gets rows at first. Repeated rows are rows of their own; a null id stays
    null. An empty table gives no rows.

    The driver holds the centroids and ``k`` rows of sums per round. Every round reads the
    vectors from the shared folder, so a lost executor costs its tasks of one round only. Rounds
    end early when no centroid moved: the rest would change nothing. A caller's ``staging`` may
    be dropped once the result is written.
    """
    spark = df.sparkSession
    staging = staging or Staging(spark)
    vectors = staging.write(scaled(df, factor, id_col, vector_col, dimensions), "vectors")
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        centroids = np.zeros((1, dimensions), np.int64)
    for _ in range(rounds):
        after = moved(vectors, centroids)
        if np.array_equal(after, centroids):
            break
        centroids = after
    assigned = staging.write(assign(vectors, centroids), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    rows = assigned.groupBy("cluster").agg(exact.alias("inertia")).collect()  # one per centroid
    total = sum(r["inertia"] for r in rows)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(r["cluster"], r["inertia"], total, digests[r["cluster"]]) for r in rows],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
