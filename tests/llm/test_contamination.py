import random

import pytest

from dimhistory.llm import contamination as c
from dimhistory.llm.oracles import OP7_DECONTAMINATION
from dimhistory.llm.queries import QUERIES


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string")


def brute(texts, bench, width):
    out = []
    for text in texts:
        words, hit, names = c.words_of(text), set(), set()
        for item, phrase in bench:
            for window in c.windows(c.words_of(phrase), width) if item else []:
                for i in range(len(words) - len(window) + 1):
                    if tuple(words[i : i + len(window)]) == window:
                        hit.update(range(i, i + len(window)))
                        names.add(item)
        out.append((len(words), len(hit), ",".join(sorted(names))))
    return out


@pytest.mark.parametrize("block,segment", [(10**6, 10**6), (20, 30)])
def test_hits_against_all_positions(spark, frame, monkeypatch, block, segment):
    monkeypatch.setattr(c, "BLOCK_WORDS", block)
    monkeypatch.setattr(c, "SEGMENT_WORDS", segment)
    rng = random.Random(block)
    word = lambda: rng.choice(["A", "b.", "ç", "d9", "-"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None]
    bench = [(f"i{k}", " ".join(word() for _ in range(rng.randint(0, 9)))) for k in range(12)]
    bench += [(None, "a b"), ("null", None), ("i3", "b b")]
    rows = {r["doc_id"]: r for r in c.contamination(frame(texts), items(spark, bench), width=4).collect()}
    import hashlib

    for i, (n, hit, names) in enumerate(brute(texts, bench, 4)):
        assert (rows[i]["n_words"], rows[i]["n_hit"]) == (n, hit)
        assert rows[i]["items_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert rows[i]["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_near_finds_unordered_words():
    rng = random.Random(4)
    docs = [[rng.choice("abcdef").encode() for _ in range(rng.randint(0, 25))] for _ in range(30)]
    part = c._Building(None)
    for i, words in enumerate(docs):
        part.add(i, words)
    from pyarrow import binary, field, int32, int64, list_, schema, string

    types = [string(), list_(int64()), list_(int32()), list_(int32()), list_(binary()), list_(int32()), binary()]
    names = [f.split()[0] for f in c.INDEX.split(", ")]
    row = part.record("s", schema([field(n, t) for n, t in zip(names, types, strict=True)])).to_pylist()[0]
    segment = c.Segment(row)
    for terms in ((b"a", b"b"), (b"a", b"c", b"e"), (b"f", b"z"), (b"d",), (b"a", b"a", b"b")):
        for distance in (0, 3):
            want = [
                row["starts"][i] + p
                for i, d in enumerate(docs)
                for p, w in enumerate(d)
                if w in terms and all(t in d[p : p + distance + 1] for t in terms)
            ]
            assert segment.near(terms, distance).tolist() == want


@pytest.mark.parametrize("block,segment", [(10**6, 10**6), (20, 30)])
def test_proximity_matches_against_all_positions(spark, frame, monkeypatch, block, segment):
    monkeypatch.setattr(c, "BLOCK_WORDS", block)
    monkeypatch.setattr(c, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(c, "ROWS", 7)
    rng = random.Random(block)
    word = lambda: rng.choice(["A", "b.", "ç", "d9", "-", "e"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(50)] + [None, "a b c"]
    bench = [(f"i{k}", " ".join(word() for _ in range(rng.randint(0, 7)))) for k in range(9)]
    bench += [(None, "a b"), ("null", None), ("i3", "b b"), ("i4", "e ç")]
    for distance in (1, 5):
        want = {
            (i, item, p)
            for i, text in enumerate(texts)
            for item, phrase in bench
            for window in (c.windows(c.words_of(phrase), 4) if item else [])
            for words in [c.words_of(text)]
            for p, w in enumerate(words)
            if w in window and all(t in words[p : p + distance + 1] for t in window)
        }
        got = [tuple(r) for r in c.find_near(frame(texts), items(spark, bench), distance, width=4).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want


def test_ids_of_any_type(spark, frame):
    docs = frame(["same text here", "other", None]).selectExpr("concat('d', doc_id) AS doc_id", "text")
    bench = items(spark, [("x", "same text here")])
    got = {r["doc_id"]: r["n_hit"] for r in c.contamination(docs, bench).collect()}
    assert got == {"d0": 3, "d1": 0, "d2": 0}
    assert [tuple(r) for r in c.find_near(docs, bench, 2).collect()] == [("d0", "x", 0)]
    assert c.find_near(docs.limit(0), bench, 2).collect() == []


def test_a_segment_only_looks_at_windows_whose_term_it_has():
    lookup = c.by_rarest_term([("x", "the cat sat"), ("y", "the dog sat"), ("z", "the cat sat")], 3)
    assert {t: [(b" ".join(w), names) for w, names in found] for t, found in lookup.items()} == {
        b"cat": [(b"the cat sat", ["x", "z"])],
        b"dog": [(b"the dog sat", ["y"])],
    }


def test_odd_documents(odd, spark):
    bench = items(spark, [("x", "same text here"), ("y", ""), ("x", "same text here")])
    got = c.contamination(odd, bench).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[0]["n_words"], by_id[0]["contaminated"]) == (0, False)
    assert (by_id[4]["n_hit"], by_id[4]["n_items"], by_id[4]["contaminated"]) == (3, 1, True)
    assert c.contamination(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert c.contamination(odd.limit(0), bench).count() == 0


def test_query_is_its_sql(spark, db, sf_dir):
    frame = QUERIES["op7_decontamination"](spark, sf_dir)
    names = sorted(frame.columns)
    want = db.execute(OP7_DECONTAMINATION).df()[names]
    got = frame.toPandas()[names]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(map(tuple, want.to_numpy().tolist()))
    assert (got["n_hit"] > 0).any()
