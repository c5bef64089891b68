import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from dimhistory.llm import contamination, jaccard, quality
from dimhistory.llm.oracles import ORACLES
from dimhistory.llm.queries import QUERIES
from dimhistory.sources import files
from dimhistory.sources.staging import shared_folder

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_run(docs, labels, bench):
    """The stages one after the other over Python rows, but for the learned list's verdicts."""
    kept = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    rows = [r.asDict() for r in docs.collect() if r["doc_id"] in kept]
    pages, totals = {}, {}
    for r in rows:
        if r["text"]:
            totals.setdefault(r["source"], set()).add(r["text"])
            for line in {x.strip(" \t\r\v\f") for x in r["text"].split("\n")} - {""}:
                pages.setdefault((r["source"], line), set()).add(r["text"])
    bad = {
        (host, line) for (host, line), texts in pages.items()
        if len(texts) >= 2 and len(texts) > 0.1 * min(1.0, 32 / len(line)) * len(totals[host])
    }
    for r in rows:
        lines = r["text"].split("\n")
        r["text"] = "\n".join(x for x in lines if (r["source"], x.strip(" \t\r\v\f")) not in bad)
    rows.sort(key=lambda r: r["doc_id"])
    sets = [jaccard.shingles(r["text"], 4) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    windows = {w for item in bench.collect() for w in contamination.windows(contamination.words_of(item["text"]), 13)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = set()
    for r in rows:
        words, hit = contamination.words_of(r["text"]), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        if not (hit and 20 * len(hit) >= len(words)):
            ids = library.encode(r["text"], add_special_tokens=False).ids
            out.add((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    return out


def test_run_against_plain_stages(spark, sf_dir, documents):
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got} == plain_run(documents, labels, bench)
    assert len(got) < documents.count()


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir, odd):
    docs = odd.select(*DOCUMENT)
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, sf_dir)
            if name != "bpe":
                assert out.columns == DOCUMENT
            assert out.count() <= some.count()
    clash = docs.selectExpr("*", "'x' AS __row", "'y' AS __keys")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clash, sf_dir).columns == clash.columns
    dedup = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, sf_dir)
    ids = sorted(r["doc_id"] for r in dedup.where("doc_id IS NOT NULL").collect())
    assert ids == [0, 1, 2, 3, 4, 7, 8]  # 5 is a copy, and 4 was there twice
    assert dedup.where("doc_id IS NULL").count() == 1


def test_verdicts_go_by_row(spark, sf_dir, frame):
    stages = dict(corpus_pipeline.STAGES)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 100").first()["text"]
    good = " ".join(f"word{i}" for i in range(60))
    # an id with two texts, and rows without id: the bad text goes, the good one stays
    for name, bad in (("quality_rules", "few words"), ("decontamination", item)):
        out = stages[name](spark, frame([good, bad, good + " x", bad], ids=[1, 1, None, None]), sf_dir)
        assert sorted(r["text"] for r in out.collect()) == [good, good + " x"]
    other = " ".join(f"other{i}" for i in range(60))
    docs = frame([good, other, other, good + " y", None, ""], ids=[1, 1, None, None, None, 7])
    out = stages["ngram_jaccard"](spark, docs.union(frame([good], ids=[2])), sf_dir).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out if r["text"] and r["text"].startswith("word"))) == [(2, good)]
    assert sum(r["text"] == other for r in out) == 1
    assert sum(not r["text"] for r in out) == 2


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES)


def test_what_stages_stage_is_dropped(spark, sf_dir, monkeypatch):
    """Beside the last stage's input nothing that ``run`` wrote is left when it returns."""
    before = set(files.list_names(spark, shared_folder(spark)))
    out = corpus_pipeline.run(spark, sf_dir)
    new = set(files.list_names(spark, shared_folder(spark))) - before
    left = [f"{folder}/{name}" for folder in new for name in files.list_names(spark, f"{shared_folder(spark)}/{folder}")]
    assert len(left) == 1 and "decontamination" in left[0]
    assert out.count() > 0


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard", "decontamination", "bpe",
    ]
