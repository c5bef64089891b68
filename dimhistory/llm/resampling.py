"""Importance resampling towards a target: documents whose words are likelier in a benchmark.

Words fall into hashed buckets; a bucket's gain is the log ratio of its share in the target to its
share in the documents. A document's weight is the sum of its words' gains, looked up in one array.
Gumbel noise of the document's id turns the weights into a draw without replacement: the highest
scores are drawn.

Ranks come from a parallel sort by regular sampling. Tasks sort their rows into runs, every
so-many-th row of a run is a sample, the sorted samples give splitters at regular places, rows go
to the segment between their splitters and are merged there, and the rows of the segments before
give each segment its first rank. Segments beyond the draw are neither exchanged nor merged.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.contamination import words_of
from dimhistory.llm.frames import arrow_schema

#: Rows of a segment that one task should merge.
SEGMENT_ROWS = 1_000_000
#: Fewest segments, and the samples taken for each; more samples make segments more even.
SEGMENTS, SAMPLES = 16, 64
#: Samples that the driver sorts at most, whatever the number of rows.
MOST_SAMPLES = 200_000
#: Words whose buckets a task remembers.
REMEMBERED = 200_000

COUNTS = "bucket int, n long"
#: The low bits of a row's number count it within its run.
_RUN_BITS = 33


class Buckets:
    """The buckets of a text's features: runs of ``1`` to ``longest`` words, joined by one space."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest = buckets, longest
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> list[int]:
        features = chain(words, *(self._runs(words, n) for n in range(2, self.longest + 1)))
        known, found = self.known, []
        for feature in features:
            bucket = known.get(feature)
            if bucket is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                bucket = zlib.crc32(feature) % self.buckets
                if len(feature) <= 64:
                    known[feature] = bucket
            found.append(bucket)
        return found

    @staticmethod
    def _runs(words: list[bytes], n: int) -> Iterator[bytes]:
        return (b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """Features of all texts by bucket. A task returns one row per bucket that it met."""
    schema = arrow_schema(COUNTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = Buckets(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = hashed.of(words_of(text.as_py()))
                if found:
                    total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        columns = [pa.array(met.astype(np.int32)), pa.array(total[met])]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    found = texts.select(text_col).mapInArrow(run, COUNTS)
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one per bucket
    counts = np.zeros(buckets, np.int64)
    for row in rows:
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln)`` of the smoothed shares' ratio, by bucket."""
    buckets = len(source)
    all_source, all_target = int(source.sum()) + buckets, int(target.sum()) + buckets
    ratios = (
        float((t + 1) * all_source) / float((s + 1) * all_target)
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    )
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: object, seed: int) -> int:
    """Gumbel noise in thousandths, from the id alone; a null id counts as an empty one."""
    text = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{text}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(
    docs: DataFrame, gains: np.ndarray, longest: int, least_words: int, seed: int, id_col: str, text_col: str
) -> DataFrame:
    """``(id, n_features, weight, score, eligible)`` of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {id_type}, n_features long, weight long, score long, eligible boolean"
    schema = arrow_schema(ddl)
    weights = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, hashed = weights.value, Buckets(len(weights.value), longest)
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(text.as_py())
                found = hashed.of(words)
                weight = int(gain[found].sum()) if found else 0
                out.append((len(found), weight, weight + noise(key.as_py(), seed), len(words) >= least_words))
            columns = list(zip(*out, strict=True)) or [()] * 4
            made = [pa.array(c, type=f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema.field(0).type), *made], schema=schema)

    return docs.select(id_col, text_col).mapInArrow(run, ddl)


# -- the sort ------------------------------------------------------------------------------


def _order() -> list[Column]:
    return [F.desc("score"), F.col("id").asc_nulls_last(), F.col("row").asc()]


def _key(score: int, key: object, row: int) -> tuple:
    """A row's place as a tuple that Python orders as ``_order`` does."""
    return (-score, key is None, 0 if key is None else key, row)


def sorted_runs(rows: DataFrame, staging: Staging) -> DataFrame:
    """``rows`` sorted within each task and written, with a number that tells run and place.

    Rows that cannot be drawn follow the others of their run.
    """
    runs = rows.sortWithinPartitions(F.desc("eligible"), F.desc("score"), F.col("id").asc_nulls_last())
    return staging.write(runs.withColumn("row", F.monotonically_increasing_id()), "runs")


def splitters(runs: DataFrame, n: int, segments: int) -> list[tuple]:
    """At most ``segments - 1`` places that part the ``n`` rows of ``runs`` regularly.

    Every ``step``-th row of a run is a sample, so between neighbouring samples lie at most
    ``step`` rows of each run. The row's number is part of a place: rows that tie, even a third
    of all, are parted like any others.
    """
    step = max(1, math.ceil(n / min(MOST_SAMPLES, segments * SAMPLES)))
    at = F.col("row").bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    sampled = runs.where(at % step == step - 1).select("score", "id", "row").collect()
    places = sorted(_key(*r) for r in sampled)
    cuts = (len(places) * i // segments for i in range(1, segments))
    return sorted({places[c] for c in cuts if c < len(places)})


def to_segments(runs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """``runs`` with the number of the splitters at or before each row's place."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", segment int"
    schema = arrow_schema(ddl)
    names = runs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(names.index(c)).to_pylist() for c in ("score", "id", "row")]
            segment = [bisect_right(cuts, _key(*place)) for place in zip(*columns, strict=True)]
            made = [c.cast(f.type) for c, f in zip(batch.columns, list(schema)[:-1], strict=True)]
            yield pa.RecordBatch.from_arrays([*made, pa.array(segment, pa.int32())], schema=schema)

    return runs.mapInArrow(run, ddl)


def ranked(runs: DataFrame, n: int, drawn: int, staging: Staging) -> DataFrame:
    """``runs`` with ``rank`` 1 to ``drawn`` for the first of its ``n`` rows that may be drawn."""
    able = F.col("eligible")
    segments = max(SEGMENTS, math.ceil(n / SEGMENT_ROWS))
    cuts = splitters(runs.where(able), n, segments) if drawn else []
    dealt = staging.write(to_segments(runs.where(able), cuts), "segments")
    sizes = {r["segment"]: r["n"] for r in dealt.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    before = list(accumulate((sizes.get(s, 0) for s in range(len(cuts) + 1)), initial=0))
    reached = [s for s in range(len(cuts) + 1) if before[s] < drawn]
    none = F.lit(None).cast("long")
    rest = runs.where(~able).withColumn("rank", none)
    if not reached:
        return rest.unionByName(dealt.drop("segment").withColumn("rank", none))
    last = reached[-1]
    merged = dealt.where(F.col("segment") <= last).withColumn(
        "place", F.row_number().over(Window.partitionBy("segment").orderBy(*_order()))
    )
    offsets = F.array(*[F.lit(b).cast("long") for b in before[: last + 1]])
    rank = F.get(offsets, F.col("segment")) + F.col("place")
    merged = merged.withColumn("rank", F.when(rank <= drawn, rank)).drop("segment", "place")
    beyond = dealt.where(F.col("segment") > last).drop("segment").withColumn("rank", none)
    return merged.unionByName(beyond).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    buckets: int = 10_000,
    longest: int = 1,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    staging: Staging | None = None,
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every document; ``rank`` is null if it is not drawn.

    Drawn are the ``floor(percent * N / 100)`` highest scores of the ``N`` documents with at least
    ``least_words`` words, ties to the smaller id, a null id last. A null or empty text has no
    words, weight 0 and is never drawn. Repeated rows are rows of their own, that tie; they get
    neighbouring ranks. Without target texts the gains are those of an empty target; an empty
    table gives no rows. Ids may have any type that orders; other columns are not read.

    The driver holds one count per bucket and at most ``MOST_SAMPLES`` samples and one row per
    segment. The scored rows are written twice in narrow form, whatever the texts' length.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    source = bucket_counts(docs, text_col, buckets, longest)
    gains = bucket_gains(source, bucket_counts(target, text_col, buckets, longest))
    runs = sorted_runs(scores(docs, gains, longest, least_words, seed, id_col, text_col), staging)
    n = runs.where("eligible").count()
    found = ranked(runs, n, percent * n // 100, staging)
    return found.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
