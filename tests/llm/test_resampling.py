import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimhistory.llm import resampling
from dimhistory.llm.oracles import OP13_RESAMPLING
from dimhistory.llm.queries import QUERIES

TEXTS = "doc_id long, text string"


def plain(docs, target, percent=10, least=20, buckets=10_000, longest=1, seed=2024):
    """The definition, document by document; rows of (id, text)."""

    def features(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        runs = [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f) % buckets for f in runs]

    source = Counter(b for _, t in docs for b in features(t)[1])
    wanted = Counter(b for t in target for b in features(t)[1])
    all_s, all_t = source.total() + buckets, wanted.total() + buckets

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * all_s / ((source[b] + 1) * all_t)))

    rows = []
    for key, text in docs:
        words, found = features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([key, len(found), weight, score, None, words >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def run(spark, docs, target, **options):
    found = resampling.resample(
        spark.createDataFrame(docs, TEXTS).repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"),
        **options,
    )
    return sorted(map(tuple, found.collect()), key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma9", "Ä", "É-delta", "x_y", "one", "two", "three"]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]


TARGET = ["alpha beta gamma9", None, "", "delta one two one"]


@pytest.mark.parametrize("options", [{}, {"percent": 100}, {"percent": 0}, {"longest": 3, "buckets": 50}])
def test_like_the_definition(spark, options):
    docs = texts(300)
    assert run(spark, docs, TARGET, **options) == plain(docs, TARGET, **options)


def test_many_segments(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 7)
    docs = texts(400, seed=2)
    assert run(spark, docs, TARGET, percent=60) == plain(docs, TARGET, percent=60)


def test_a_third_of_all_rows_is_one_row(spark):
    docs = texts(200, seed=3) + [(7, "alpha " * 30)] * 100
    got = run(spark, docs, TARGET, percent=80)
    want = plain(docs, TARGET, percent=80)
    assert got == want
    runs = resampling.sorted_runs(
        spark.createDataFrame([(7, 5, 1, 2, True)] * 1000, "id long, n_features long, weight long, score long, eligible boolean").repartition(4),
        resampling.Staging(spark),
    )
    cuts = resampling.splitters(runs, 1000, 10)
    sizes = resampling.to_segments(runs, cuts).groupBy("segment").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 250


def test_awkward_documents(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "word " * 100_000), (None, "alpha " * 25), (None, "beta " * 25)]
    docs += [(5, "x" * 300_000), (6, "alpha " * 20), (8, "beta " * 19)]
    for percent in (10, 100):
        assert run(spark, docs, TARGET, percent=percent) == plain(docs, TARGET, percent=percent)
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, [], TARGET) == []
    assert run(spark, docs[:3], TARGET) == plain(docs[:3], TARGET)


def test_text_ids_and_clashing_columns(spark):
    docs = texts(60, seed=4)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    df = spark.createDataFrame([(f"d{i:03}", t) for i, t in docs], "doc_id string, text string")
    for name in "id row segment place rank score eligible weight bucket".split():
        df = df.selectExpr("*", f"'clash' AS {name}")
    got = resampling.resample(df, target, percent=50)
    named = plain([(f"d{i:03}", t) for i, t in docs], TARGET, percent=0)
    assert {r["doc_id"]: r["score"] for r in got.collect()} == {r[0]: r[3] for r in named}
    drawn = got.where(F.col("rank").isNotNull()).orderBy("rank").collect()
    assert [(-r["score"], r["doc_id"]) for r in drawn] == sorted((-r["score"], r["doc_id"]) for r in drawn)


def test_query_is_its_sql(spark, db, sf_dir):
    got = sorted((tuple(r) for r in QUERIES["op13_resampling"](spark, sf_dir).collect()), key=repr)
    assert got == sorted(db.execute(OP13_RESAMPLING).fetchall(), key=repr)
