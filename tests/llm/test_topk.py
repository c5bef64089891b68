import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimhistory.llm import topk
from dimhistory.llm.frames import arrow_schema
from dimhistory.llm.oracles import OP12_TOPK
from dimhistory.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def plain(rows, k=5, factor=256, every=50):
    """Every product, sorted; rows of (id, vector)."""
    kept = [
        (i, [int(np.floor(factor * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, v in {(i, tuple(v)) for i, v in kept if i is not None and i % every == 0}:
        found = [(-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i or 0, i) for i, w in kept if i != q]
        out += [(q, n, f[3], -f[0]) for n, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(map(tuple, topk.best_products(df, **options).collect()), key=repr)


@pytest.fixture()
def small_parts(monkeypatch):
    """Many small segments, groups, chunks and blocks."""
    for name, value in {"BLOCK": 3, "SEGMENT": (20, 20), "GROUP": 4, "CHUNK": 2, "HELD": 5}.items():
        monkeypatch.setattr(topk, name, value)


def some(n, dimensions, seed):
    rng = random.Random(seed)
    return [(i * 5, [rng.gauss(0, 1) for _ in range(dimensions)]) for i in range(n)]


def test_random_vectors_like_every_product(spark, small_parts):
    rows = some(150, 6, 1)
    assert run(spark, rows) == plain(rows)


def test_sizes_of_parts_change_nothing(spark):
    rows = some(150, 6, 1)
    assert run(spark, rows) == plain(rows)


def test_ties_copies_nulls_and_lengths(spark, small_parts):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 130)]  # all tie
    rows += [(None, [1.0, 0.0]), (50, [2.0, -1.0]), (300, None), (301, [nan, 1.0]), (302, [inf]), (303, [None])]
    rows += [(400, []), (401, [3.0]), (402, [1.0, 2.0, 3.0]), (450, [-1.0, -1.0, 5.0]), (500, [0.0, 0.0])]
    assert run(spark, rows) == plain(rows)
    twice = rows + rows
    assert run(spark, twice) == plain(twice)


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(None, [1.0]), (3, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (None, [2.0])]) == [(0, 1, None, 256 * 512)]
    assert len(run(spark, [(0, [1.0]), (1, [2.0]), (2, [3.0])])) == 2


def test_stated_queries_and_clashing_columns(spark):
    rows = some(40, 3, 2)
    df = spark.createDataFrame(rows, VECTORS)
    for name in "id vector q group segment rank score query_id".split():
        df = df.selectExpr("*", f"'clash' AS {name}")
    got = topk.best_products(df, F.col("id") % 20 == 0, k=2).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 2, every=20)


def blocks_of(vectors, size):
    schema = arrow_schema(topk.BLOCKS)
    rows = []
    for at in range(0, len(vectors), size):
        part = vectors[at : at + size].astype(np.int32)
        ids = list(range(at, at + len(part)))
        rows.append((0, ids, part.min(axis=0), part.max(axis=0), part.shape[1], part.tobytes()))
    columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.Table.from_arrays(columns, schema=schema)


def test_blocks_below_the_bound_are_not_scored(spark):
    """Vectors in far groups: a query scores its own group's blocks and few others."""
    rng = np.random.default_rng(3)
    far = np.repeat(np.eye(10, 32) * 1000, 40, axis=0) + rng.integers(-5, 5, (400, 32))
    segment = topk.Segment(blocks_of(far, 10), 32)
    query, place, score, scored = segment.best(far[::40], np.arange(0, 400, 40), 5)
    every = far[::40].astype(int) @ far.astype(int).T
    every[np.arange(10), np.arange(0, 400, 40)] = -(10**9)
    assert np.array_equal(score.reshape(10, 5), -np.sort(-every, axis=1)[:, :5])
    assert scored <= 10 * 6  # of 10 * 40 pairs


def test_products_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(4)
    big = rng.integers(-(1 << 27), 1 << 27, (60, 20))
    segment = topk.Segment(blocks_of(big, 7), 20)
    _, _, score, _ = segment.best(big[:3], np.arange(3), 4)
    every = [[sum(map(lambda a, b: int(a) * int(b), q, v)) for v in big] for q in big[:3]]
    want = [sorted((s for j, s in enumerate(row) if j != i), reverse=True)[:4] for i, row in enumerate(every)]
    assert score.reshape(3, 4).tolist() == want


def test_query_is_its_sql(spark, db, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op12_topk"](spark, sf_dir).collect())
    assert got == sorted(db.execute(OP12_TOPK).fetchall())
