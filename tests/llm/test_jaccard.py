import random
from itertools import combinations
from pathlib import Path

import pytest

from dimhistory import Staging
from dimhistory.llm import frames, graph, jaccard
from dimhistory.llm.oracles import OP6_NGRAM_JACCARD
from dimhistory.llm.queries import QUERIES


def brute(texts, width=4, percent=85):
    """Component of each text by comparing all pairs."""
    sets = [jaccard.shingles(t, width) for t in texts]
    group = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
    return [len(s) for s in sets], group


def near_copies(rng, n):
    """Families of texts with a few words changed, so that similarities straddle the limit."""
    out = []
    while len(out) < n:
        base = rng.choices([f"w{i}" for i in range(400)], k=rng.choice([3, 6, 9, 14, 40, 90, 150]))
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            cut = rng.choice([0, 0, 0, 1, 4])
            out.append(" ".join(words[cut:]))
    return out[:n]


@pytest.mark.parametrize("frequent", [48, 2])
def test_components_of_all_pairs(frame, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    monkeypatch.setattr(jaccard, "COMMON_SHARE", 0.02)
    texts = near_copies(random.Random(frequent), 350)
    sizes, group = brute(texts)
    got = {r["doc_id"]: r for r in jaccard.similar_documents(frame(texts), frequent=frequent).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == group


def test_pairs_alone_find_every_link(frame, monkeypatch):
    """Without any comparison against hubs the joined lists must still lose nothing."""
    real, calls = jaccard._narrowed, []

    def none_at_first(pairs, sets, percent, staging):
        calls.append(1)
        return real(pairs, sets, percent, staging) if len(calls) > 1 else pairs.limit(0)

    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    monkeypatch.setattr(jaccard, "_narrowed", none_at_first)
    texts = near_copies(random.Random(3), 250)
    _, group = brute(texts)
    got = {r["doc_id"]: r for r in jaccard.similar_documents(frame(texts), frequent=3).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == group


def with_a_passage(rng, n, own, passage, near=0):
    """Texts of ``own`` words each that all hold one passage, and ``near`` near copies of some."""
    shared = [f"p{i}" for i in range(passage)]
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(own)] for _ in range(n)]
    texts = [words[: own // 2] + shared + words[own // 2 :] for words in texts]
    for words in rng.sample(texts, near):
        changed = list(words)
        for _ in range(2):
            changed[rng.randrange(len(changed))] = f"x{rng.randrange(10**9)}"
        texts.append(changed)
    return [" ".join(words) for words in texts]


@pytest.fixture()
def looked_at(monkeypatch):
    """Pairs of rows that lie in one list, each time pairs are made."""
    seen, real = [], jaccard._pairs

    def counted(open_, percent, frequent):
        sizes = open_.groupBy("token").count()
        seen.append(sizes.selectExpr("coalesce(sum(count * count), 0) AS n").first()["n"])
        return real(open_, percent, frequent)

    monkeypatch.setattr(jaccard, "_pairs", counted)
    monkeypatch.setattr(jaccard, "COMMON_SHARE", 10)  # the passage is not among the common ones
    return seen


def test_a_passage_in_many_documents_makes_no_square_of_pairs(frame, looked_at, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG", 60)
    for n in (150, 300):
        texts = with_a_passage(random.Random(n), n, 100, 40, near=20)
        _, group = brute(texts)
        got = {r["doc_id"]: r for r in jaccard.similar_documents(frame(texts)).collect()}
        assert [got[i]["component_id"] for i in range(len(texts))] == group
        assert len(set(group)) < len(texts)
    small, large = looked_at
    assert large <= 2.5 * max(small, 500)
    # without moving them, every list of the passage's tokens meets itself
    monkeypatch.setattr(jaccard, "MOVES", 0)
    jaccard.similar_documents(frame(texts)).collect()
    assert looked_at[-1] > 100 * max(large, 1000)


@pytest.mark.parametrize("long_,moves", [(4, 1), (4, 3), (15, 3)])
def test_moving_tokens_loses_no_link(frame, monkeypatch, long_, moves):
    """Any tokens may be moved: the links are those of all pairs."""
    monkeypatch.setattr(jaccard, "COMMON_SHARE", 0.1)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    monkeypatch.setattr(jaccard, "LONG", long_)
    monkeypatch.setattr(jaccard, "MOVES", moves)
    real, calls = jaccard._narrowed, []

    def none_at_first(pairs, sets, percent, staging):
        calls.append(1)
        return real(pairs, sets, percent, staging) if len(calls) > 1 else pairs.limit(0)

    monkeypatch.setattr(jaccard, "_narrowed", none_at_first)
    rng = random.Random(long_)
    texts = near_copies(rng, 150) + with_a_passage(rng, 60, 60, 25, near=25)
    _, group = brute(texts)
    got = {r["doc_id"]: r for r in jaccard.similar_documents(frame(texts), frequent=3).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == group


def test_odd_documents(odd):
    got = jaccard.similar_documents(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["n_shingles"] == by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == 0
    assert [by_id[i]["component_id"] for i in (0, 1, 2, 4, 5)] == [0, 1, 2, 4, 4]
    assert by_id[None]["component_id"] is None
    assert jaccard.similar_documents(odd.limit(0)).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for _ in range(3):
        links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 120)]
        group = {}
        for a, b in links:
            low, high = sorted((group.setdefault(a, a), group.setdefault(b, b)))
            group = {k: low if g == high else g for k, g in group.items()}
        frame = spark.createDataFrame(links, "a long, b long")
        with Staging(spark) as staging:
            got = {r["node"]: r["component"] for r in graph.components(frame, staging).collect()}
        linked = {n for a, b in links if a != b for n in (a, b)}
        assert got == {n: group[n] for n in linked}


def test_query_is_its_sql(spark, db, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op6_ngram_jaccard"](spark, sf_dir).collect())
    assert got == sorted(db.execute(OP6_NGRAM_JACCARD).fetchall())


def test_components_grow_by_new_links(spark, staging):
    rng = random.Random(5)
    for size in (4, 30):
        old, new = ([(rng.randint(0, 2 * size), rng.randint(0, 2 * size)) for _ in range(size)] for _ in range(2))
        links = [spark.createDataFrame(rows, "a long, b long") for rows in (old, new, old + new)]
        found = graph.components(links[0], staging)
        got = graph.grown(found, links[1], staging)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, graph.components(links[2], staging).collect()))
        assert graph.grown(found, links[1].limit(0), staging) is found


def test_components_are_worked_out_again_only_for_new_links(frame, monkeypatch):
    calls, real = [], graph.components
    monkeypatch.setattr(graph, "components", lambda links, staging: calls.append(1) or real(links, staging))
    words = [f"w{i}" for i in range(200)]
    docs = frame([" ".join(words), " ".join([*words, "x"]), "some other text of six words"])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2} and len(calls) == 1


def test_what_other_operators_keep_is_released():
    held = frames.kept(lambda path: [path])
    first = held("a")
    assert held("a") is first
    frames.release()
    assert held("a") is not first


def test_few_links_are_few_files(spark, staging, monkeypatch):
    first, more = (
        staging.write(spark.createDataFrame([(i, i + 1) for i in ids], "a long, b long"), "given")
        for ids in (range(200), range(200, 300))
    )

    def files(of):
        return [len([*folder.glob("part-*")]) for folder in Path(staging.path).glob(f"{of}-*")]

    conf = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        found = graph.grown(graph.components(first, staging), more, staging)
        assert dict(map(tuple, found.collect())) == dict.fromkeys(range(301), 0)
        assert set(files("links")) == {1}
        assert not files("more")  # what is staged is not written again
        monkeypatch.setattr(graph, "LINKS", 50)
        graph.components(first, staging)
        assert max(files("links")) == 4  # 200 links
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
