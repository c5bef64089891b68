"""Small helpers that the text operators share."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import dimhistory
from dimhistory import Staging


_SHIPPED: set[str] = set()


#: Rows of a batch between Spark and Python, where the session has Spark's own number. Texts
#: are long, and several copies of a batch are in memory at once.
BATCH_ROWS = 2_000


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the Python workers, which may lack its folder."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(dimhistory.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="dimhistory-code-")) / "dimhistory.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_KEPT: list[Callable] = []


def kept(load: Callable) -> Callable:
    """``load``, whose last results stay in the Python worker for its next tasks, until ``release``."""
    held = lru_cache(maxsize=2)(load)
    _KEPT.append(held)
    return held


def release() -> None:
    """Give back what operators before keep in this Python worker, which Spark uses again.

    A task that needs much memory itself calls it first.
    """
    if not any(held.cache_info().currsize for held in _KEPT):
        return
    for held in _KEPT:
        held.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than glibc


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of rows that nothing may be learned from."""
    text = F.col(doc_id).cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % 4 == 2, F.lit(False))


#: Ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def by_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """Semi or anti join of ``docs`` with the values of ``key`` in ``ids``, written once and counted.

    Up to ``BROADCAST_IDS`` ids are broadcast, which spares the texts a shuffle.
    """
    ids = Staging(docs.sparkSession).write(ids.select(key).distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    joined = docs.join(F.broadcast(ids) if few else ids, key, how)
    return joined.select(*docs.columns)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled(df: DataFrame, key: str, size: int, total: int) -> DataFrame:
    """About ``size`` of the ``total`` rows of ``df``, chosen by a hash of ``key``; all if fewer.

    Copies of a key are chosen together. No order and no single task are needed.
    """
    cells = 1 << 30
    cut = math.ceil(cells * min(1.0, size / max(total, 1)))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(cells)) < cut)


def map_texts(
    df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., tuple]]
) -> DataFrame:
    """One output row per input row, worked out by Python over Arrow batches.

    ``columns`` are the inputs; ``make`` is called once in each task and returns a function
    from their values to the values of ``schema``. Nothing is kept between batches but what
    that function keeps itself.
    """
    target = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                values = [part.column(i).to_pylist() for i in range(len(columns))]
                out = [row(*v) for v in zip(*values, strict=True)]
                made = [
                    pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), target, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(made, schema=target)

    return df.select(*columns).mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a DDL schema; needs a session, so call it on the driver."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
