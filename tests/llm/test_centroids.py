import hashlib
import random

import numpy as np
import pytest

from dimhistory.llm import centroids, vectors
from dimhistory.llm.oracles import OP11_CENTROIDS
from dimhistory.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>"
SMALL = {"k": 3, "rounds": 4, "factor": 8, "dimensions": 2}


def plain(rows, k, rounds, factor, dimensions, salt="3"):
    """The clustering with plain numbers; rows of (id, vector)."""
    kept = [
        (i, [int(np.floor(factor * x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted((i is None, hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v) for i, v in kept)
    middle = [v for _, _, v in order][:k]

    def nearest(v):
        found = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        members = [[] for _ in middle]
        for _, v in kept:
            members[nearest(v)[0]].append(v)
        middle = [
            [sum(column) // len(m) for column in zip(*m, strict=True)] if m else c
            for m, c in zip(members, middle, strict=True)
        ]
    found = [(i, *nearest(v)) for i, v in kept]
    by = {c: sum(d for _, x, d in found if x == c) for _, c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    total = sum(by.values())
    return sorted(((i, c, d, by[c], total, digest[c]) for i, c, d in found), key=repr)


def run(spark, rows, **options):
    got = centroids.cluster(spark.createDataFrame(rows, VECTORS), **(SMALL | options)).collect()
    return sorted(map(tuple, got), key=repr)


def test_random_vectors_like_plain_numbers(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows = [(i, [rng.gauss(0, 1) + 3 * (i % 3), rng.gauss(0, 1)]) for i in range(60)]
        assert run(spark, rows) == plain(rows, 3, 4, 8, 2)


def test_ties_copies_and_empty_clusters(spark):
    # equal vectors start several centroids, of which the first takes all rows
    rows = [(i, [1.0, -1.0]) for i in range(6)] + [(9, [1.5, -1.0])]
    assert run(spark, rows) == plain(rows, 3, 4, 8, 2)
    twice = rows + rows
    assert run(spark, twice, rounds=1) == plain(twice, 3, 1, 8, 2)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [0.0, -inf]),
        (7, [0.5, 0.25]), (8, [-0.01, 4.0]), (None, [9.0, 9.0]),
    ]
    got = run(spark, rows)
    assert [r[0] for r in got] == [7, 8, None]
    assert got == plain(rows, 3, 4, 8, 2)  # the null id starts the last centroid
    assert run(spark, rows[:6]) == []
    assert run(spark, []) == []


def test_large_numbers_stay_exact_and_too_large_ones_are_refused(spark):
    rows = [(i, [(-1) ** i * (2.0**23 - i), i / 8]) for i in range(8)]
    assert run(spark, rows) == plain(rows, 3, 4, 8, 2)
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [2.0**25, 0.0])])


def test_other_columns_may_clash(spark):
    rows = [(i, [float(i % 4), 1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, VECTORS)
    for name in "id vector cluster distance n sums inertia".split():
        df = df.selectExpr("*", f"'clash' AS {name}")
    got = sorted(map(tuple, centroids.cluster(df, **SMALL).collect()), key=repr)
    assert got == run(spark, rows)


@pytest.mark.parametrize("wide", [False, True])
def test_tables_are_distances(wide):
    rng = np.random.default_rng(2)
    rows = rng.integers(-(1 << 27) if wide else -9, 1 << 27 if wide else 9, (50, 5))
    middle = rng.integers(-9, 9, (4, 5))
    want = ((rows[:, None, :] - middle[None, :, :]) ** 2).sum(axis=2)
    assert np.array_equal(centroids.distances(rows, middle), want)


def test_numbers_follow_the_contract(spark):
    df = spark.createDataFrame([(1, [-0.0001, 0.9999, 1.0])], VECTORS)
    assert vectors.scaled(df, 1024).first()["vector"] == [-1, 1023, 1024]


def test_query_is_its_sql(spark, db, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op11_centroids"](spark, sf_dir).collect())
    assert got == sorted(db.execute(OP11_CENTROIDS).fetchall())
