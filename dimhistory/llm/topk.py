"""Exact best inner products, skipping blocks of documents that cannot hold any.

The index is a row per block: a range of documents in an order that keeps vectors of like signs
together, the smallest and largest component of each dimension, and the block's vectors (its
forward index). A query's product with any vector of a block is at most the sum over dimensions
of its component times the one of the two that suits its sign. Blocks are scored in the order of
that bound until it falls below the query's k-th best score.

Blocks form segments, and queries form groups, of bounded size; every pair of the two is one small
task of its own. A pair returns at most ``k`` rows a query, which one window merges.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.frames import arrow_schema
from dimhistory.llm.vectors import matrix, scaled

#: Vectors of a block.
BLOCK = 64
#: Fewest and most vectors of a segment; between them there are four segments a core.
SEGMENT = (4_096, 262_144)
#: Queries of a group, and those that a task looks at together.
GROUP, CHUNK = 65_536, 512
#: Candidates held before they are merged into the best.
HELD = 1_000_000
#: Leading dimensions whose signs order the documents.
SIGNS = 16

BLOCKS = "segment int, ids array<long>, low array<int>, high array<int>, width int, forward binary"
ASKED = "q long, query_id long, vector array<int>"
FOUND = "q long, query_id long, vec_id long, score long"

_NO_ID = -(1 << 63)
_NO_SCORE = -(1 << 62)


def signs(vector: Column) -> Column:
    """The signs of the leading dimensions as one number; like vectors lie near each other."""
    first = F.slice(vector, 1, SIGNS)
    return F.aggregate(first, F.lit(0), lambda code, x: code * 2 + (x >= 0).cast("int"))


def build_index(vectors: DataFrame, segments: int, staging: Staging) -> DataFrame:
    """The blocks of ``vectors`` (id, vector), written to the shared folder."""
    by = [signs(F.col("vector")).alias("signs"), F.col("id"), F.col("vector")]
    ranged = vectors.select(*by).repartitionByRange(segments, "signs", "id")
    ranged = ranged.sortWithinPartitions("signs", "id").select("id", "vector")
    schema = arrow_schema(BLOCKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                rows = matrix(part.column(1)).astype(np.int32)
                low, high = rows.min(axis=0), rows.max(axis=0)
                row = [segment, part.column(0).to_pylist(), low, high, rows.shape[1], rows.tobytes()]
                made = [pa.array([v], type=f.type) for v, f in zip(row, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(made, schema=schema)

    return staging.write(ranged.mapInArrow(run, BLOCKS), "blocks")


class Segment:
    """The blocks of one segment, as arrays."""

    def __init__(self, blocks: pa.Table, width: int):
        own = max(blocks.column("width").to_pylist(), default=0)
        self.width = max(own, width)
        self.low = matrix(blocks.column("low"), self.width).astype(np.int64)
        self.high = matrix(blocks.column("high"), self.width).astype(np.int64)
        ids = [i for row in blocks.column("ids").to_pylist() for i in row]
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        sizes = [len(row) for row in blocks.column("ids")]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        # the place of each id in their order, null ids after all others
        self.place = np.empty(len(ids), np.int64)
        self.place[np.lexsort((self.ids, self.null))] = np.arange(len(ids))
        self.forward = []
        for own, size, data in zip(
            blocks.column("width").to_pylist(), sizes, blocks.column("forward"), strict=True
        ):
            rows = np.frombuffer(data.as_buffer(), np.int32).reshape(size, own)
            self.forward.append(np.pad(rows, ((0, 0), (0, self.width - own))))

    def largest(self) -> int:
        return int(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))

    def best(self, asked: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Rows of (query, place, score) with the ``k`` best of each query, and the pairs of query
        and block that were scored. ``own`` are the ids that a query must not find."""
        asked = np.pad(asked.astype(np.int64), ((0, 0), (0, self.width - asked.shape[1])))
        most = int(np.abs(asked).max(initial=0)) * self.largest() * max(self.width, 1)
        if most >= 1 << 62:
            raise OverflowError("an inner product may not fit 64 bits")
        # whole numbers below 2^53 are exact in doubles, whose products are much faster
        kind = np.float64 if most < 1 << 53 else np.int64
        asked = asked.astype(kind)
        bounds = np.maximum(asked, 0) @ self.high.astype(kind).T + np.minimum(asked, 0) @ self.low.astype(kind).T
        order = np.argsort(-bounds, axis=1, kind="stable")
        top = _Best(len(asked), k)
        at, step, scored = 0, 1, 0
        while at < bounds.shape[1]:
            taken = order[:, at : at + step]
            live = np.take_along_axis(bounds, taken, axis=1) >= top.least[:, None]
            query, column = np.nonzero(live)
            if not len(query):
                break
            block = taken[query, column]
            by_block = np.argsort(block, kind="stable")
            query, block = query[by_block], block[by_block]
            blocks, first = np.unique(block, return_index=True)
            for b, who in zip(blocks.tolist(), np.split(query, first[1:]), strict=True):
                who = who[bounds[who, b] >= top.least[who]]  # it may have risen in this round
                scored += len(who)
                rows = slice(self.starts[b], self.starts[b + 1])
                scores = asked[who] @ self.forward[b].astype(kind).T
                wanted = (scores >= top.least[who, None]) & (self.ids[None, rows] != own[who, None])
                i, j = np.nonzero(wanted)
                top.add(who[i], self.place[rows][j], scores[i, j].astype(np.int64))
            top.merge()
            at, step = at + step, step * 2
        return *top.rows(), scored


class _Best:
    """The best rows of each query; ``least`` is the k-th best score so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, _NO_SCORE, np.int64)
        self.kept = (np.zeros(0, np.int64),) * 3
        self.new: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        if len(query):
            self.new.append((query, place, score))
            self.held += len(query)
            if self.held > HELD:
                self.merge()

    def merge(self) -> None:
        if not self.new:
            return
        query, place, score = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((place, -score, query))
        query, place, score = query[order], place[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        good = rank < self.k
        self.kept = query[good], place[good], score[good]
        last = rank == self.k - 1
        self.least[query[last]] = score[last]
        self.new, self.held = [], 0

    def rows(self) -> tuple[np.ndarray, ...]:
        self.merge()
        return self.kept


def search_pair(blocks: pa.Table, asked: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    """The ``k`` best of one segment for the queries of one group."""
    out = []
    width = int(np.diff(asked.column("vector").combine_chunks().offsets.to_numpy()).max(initial=0))
    segment = Segment(blocks, width)
    by_place = np.argsort(segment.place)
    for start in range(0, asked.num_rows, CHUNK):
        part = asked.slice(start, CHUNK)
        own = part.column("query_id").to_numpy()
        query, place, score, _ = segment.best(matrix(part.column("vector")), own, k)
        row = by_place[place]
        found = pa.array(segment.ids[row], mask=segment.null[row])
        columns = [part.column("q").to_numpy()[query], own[query], found, score]
        made = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
        out.append(pa.Table.from_arrays(made, schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def best_products(
    df: DataFrame,
    queries: Column | None = None,
    k: int = 5,
    factor: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    staging: Staging | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query.

    Queries are the rows for which ``queries`` holds (by default: id divisible by 50); all rows
    are candidates, but those with the query's own id. Ids are whole numbers. Vectors become
    whole numbers as :func:`vectors.scaled` says: null ones, and those with null or non-finite
    components, take no part. Of vectors of different lengths the shorter ends in zeros. Equal
    scores go to the smaller id, a null id last. Repeated rows are candidates as often as they
    stand, and ask once; rows that share an id but not the vector each ask. A query without
    other rows gets no row; an empty table gives none. Other columns are not read.

    Every query meets every segment, the bounds decide what is scored there. Sizes of segments,
    groups and chunks change the work, never the result.
    """
    spark = df.sparkSession
    staging = staging or Staging(spark)
    asks = F.col("id") % 50 == 0 if queries is None else queries
    vectors = staging.write(scaled(df, factor, id_col, vector_col), "vectors")
    vectors = vectors.select(F.col("id").cast("long"), "vector")
    n = vectors.count()
    least, most = SEGMENT
    rows = min(most, max(least, n // (4 * spark.sparkContext.defaultParallelism)))
    segments = max(1, math.ceil(n / rows))
    blocks = build_index(vectors, segments, staging)

    asked = vectors.where(asks & F.col("id").isNotNull()).dropDuplicates(["id", "vector"])
    asked = asked.select(F.monotonically_increasing_id().alias("q"), F.col("id").alias("query_id"), "vector")
    asked = staging.write(asked, "queries")
    groups = max(1, math.ceil(asked.count() / GROUP))
    group = F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int")
    # each side once for every part of the other: a stated query set against all rows, in blocks
    number = blocks.agg(F.max("segment")).first()[0]
    every = F.sequence(F.lit(0), F.lit(number or 0))
    asked = asked.select("*", group.alias("group"), F.explode(every).alias("segment"))
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    pairs = min(20_000, 2 * segments * groups)
    keys = ["segment", "group"]
    schema = arrow_schema(FOUND)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_pair(left, right, k, schema)

    found = (
        blocks.repartition(pairs, *keys).groupBy(*keys)
        .cogroup(asked.repartition(pairs, *keys).groupBy(*keys))
        .applyInArrow(search, FOUND)
    )
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
