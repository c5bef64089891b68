import pytest
from pyspark.sql import functions as F

from dimhistory.llm import lines
from dimhistory.llm.oracles import OP9_LINE_DEDUP
from dimhistory.llm.queries import QUERIES


def test_frequent_lines_of_a_host_go(frame):
    own = [f"line {i} of its own\n  shared line \nmore {i}" for i in range(8)]
    docs = frame(own, source="a").union(frame(own[:3], ids=[20, 21, 22], source="b"))
    got = {r["doc_id"]: r for r in lines.drop_boilerplate(docs, ratio=0.5, least_pages=5).collect()}
    assert got[0]["text"] == "line 0 of its own\nmore 0"
    assert (got[0]["n_lines"], got[0]["n_dropped"]) == (3, 1)
    assert got[20]["text"] == own[0]  # fewer pages than the least


def test_the_share_falls_with_the_length_of_a_line(frame):
    passage = "a passage of many words that comes back on a few pages of its host " * 5
    docs = frame([f"page {i}\nshort" + f"\n{passage}" * (i < 6) for i in range(100)])
    docs = docs.union(frame([f"own {i}" + "\ntiny" * (i < 6) for i in range(100)], range(200, 300), source="b"))
    same = lines.drop_boilerplate(docs, full_length=None)
    assert same.where(F.col("text").contains(passage.strip())).count() == 6
    got = lines.drop_boilerplate(docs)
    assert {r["text"] for r in got.where("source = 's'").collect()} == {f"page {i}" for i in range(100)}
    assert got.where("source = 'b' AND n_dropped > 0").count() == 0  # six short lines are no boilerplate
    # four pages of one host are below a least of five
    few = frame([f"page {i}" + f"\n{passage}" * (i < 4) for i in range(100)])
    assert lines.drop_boilerplate(few, least_pages=5).where("n_dropped > 0").count() == 0
    assert lines.drop_boilerplate(few).where("n_dropped > 0").count() == 4
    # a passage that one page holds is no boilerplate, however long
    once = frame([f"page {i}" + f"\n{passage}" * (i < 1) for i in range(10_000)])
    assert lines.drop_boilerplate(once).where("n_dropped > 0").count() == 0


def test_small_hosts_are_cleaned(frame):
    docs = frame([f"page {i}\nfoot" for i in range(2)])
    assert sorted(r["text"] for r in lines.drop_boilerplate(docs).collect()) == ["page 0", "page 1"]
    assert lines.drop_boilerplate(docs, least_pages=5).where("n_dropped > 0").count() == 0
    # a host of one page has nothing that repeats
    assert lines.drop_boilerplate(docs.limit(1)).where("n_dropped > 0").count() == 0


def test_copies_count_once(frame):
    docs = frame(["article line\nsecond line"] * 30 + [f"other {i}" for i in range(30)])
    assert lines.drop_boilerplate(docs).where("n_dropped > 0").count() == 0


def test_join_by_host_gives_the_same(frame, monkeypatch):
    docs = frame([f"{i}\nfoot" for i in range(20)], source=None).union(frame(["foot", None], ids=[90, 91]))
    one = sorted(map(repr, lines.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(lines, "BROADCAST_LINES", -1)
    assert sorted(map(repr, lines.drop_boilerplate(docs).collect())) == one
    assert any("n_dropped=1" in r for r in one)


def test_working_columns_may_clash(frame):
    docs = frame([f"page {i}\nfoot" for i in range(9)])
    want = sorted(r["text"] for r in lines.drop_boilerplate(docs).collect())
    for name in "__keys __kept __host __HOST_ keys".split():
        docs = docs.selectExpr("*", f"'clash' AS {name}")
    got = lines.drop_boilerplate(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert sorted(r["text"] for r in got.where("__keys = 'clash' AND __host = 'clash'").collect()) == want


def test_many_lines_of_one_host_are_all_found(frame):
    shared = [f"a long line that the pages of this host have in common, number {i}" for i in range(300)]
    docs = frame([f"page {i}\n" + "\n".join(shared) for i in range(12)])
    assert sorted(r["text"] for r in lines.drop_boilerplate(docs).collect()) == sorted(f"page {i}" for i in range(12))


def test_odd_documents(odd):
    got = lines.drop_boilerplate(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["text"] is None and by_id[1]["text"] == "" and by_id[2]["text"] == " \n\t "
    assert by_id[0]["n_lines"] == by_id[1]["n_lines"] == 0
    assert by_id[3]["key"] == "clash"
    assert lines.drop_boilerplate(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op9_line_dedup"])
def test_query_is_its_sql(spark, db, sf_dir, name):
    got = sorted(tuple(r) for r in QUERIES[name](spark, sf_dir).collect())
    assert got == sorted(db.execute(OP9_LINE_DEDUP).fetchall())
