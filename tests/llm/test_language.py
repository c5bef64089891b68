import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimhistory.llm import language
from dimhistory.llm.frames import held_out
from dimhistory.llm.queries import QUERIES


def test_held_out_languages_are_found(spark, documents, sf_dir):
    found = QUERIES["op1_language"](spark, sf_dir)
    rows = found.join(documents, "doc_id").where("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 20 and right >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_teach_nothing(documents):
    poisoned = documents.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang")))
    assert "xx" not in language.learn(poisoned).languages


def test_unseen_words_back_off(frame, spark):
    texts = ["schnell gehen gehend"] * 4 + ["quick running runner"] * 4
    docs = frame(texts, ids=range(0, 80, 10)).withColumn("lang", F.expr("if(doc_id < 40, 'de', 'en')"))
    docs = docs.where(~held_out())
    model = language.learn(docs)
    score = language.Scorer(model)
    assert "gehens" not in model.words
    assert score("gehens")[0] == "de" and score("runned")[0] == "en"


def test_long_words_are_read_whole(frame):
    same = "ab" * 40
    texts = ["schnell gehen", same + "schnell"] * 4 + ["quick running", same + "running"] * 4
    docs = frame(texts, ids=range(0, 160, 10)).withColumn("lang", F.expr("if(doc_id < 80, 'de', 'en')"))
    docs = docs.where(~held_out())
    model = language.learn(docs)
    score = language.Scorer(model)
    assert score(same + "schnell")[0] == "de" and score(same + "running")[0] == "en"  # learned
    assert score("schnell" * 10 + "running" * 60)[0] == "en"  # by n-grams, of which 70 letters are de
    assert score("running" * 10 + "schnell" * 60)[0] == "de"
    assert not any(len(word) > language.LONGEST for word in score.at)
    # as many n-grams of a long word as of a short one are learned
    counted = {(r["kind"], r["token"]): r["n"] for r in language._counts(docs).where("lang = 'de'").collect()}
    assert counted[5, "ababa"] == 38 * counted[0, language.long_key(same + "schnell")]
    assert counted[5, "nell "] == counted[0, "schnell"] + counted[0, language.long_key(same + "schnell")]


def test_odd_documents(odd, spark):
    model = language.learn(odd)
    got = language.identify(odd, model).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (0, 1, 2, 7))
    assert by_id[3]["lang_pred"] == "en"
    assert language.identify(odd.limit(0), model).count() == 0
    empty = language.learn(odd.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}


@pytest.mark.parametrize("text,words", [("Ab c1d é_²x", ["ab", "c", "d", "é", "²x"]), ("² 12 _", []), (None, [])])
def test_words(text, words):
    assert language.words_of(text) == words


def plain_model(rows):
    """Counts by language out of (lang, text), and what is kept of them, in plain dictionaries."""
    words, grams = {}, {n: {} for n in language.LENGTHS}
    languages = sorted({lang for lang, _ in rows})
    for lang, text in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            words.setdefault(word, Counter())[lang] += 1
            padded = f" {word} "
            for n in language.LENGTHS:
                for i in range(max(1, len(padded) - n + 1)):
                    grams[n].setdefault(padded[i : i + n], Counter())[lang] += 1

    def logs(table):
        table = {t: c for t, c in table.items() if sum(c.values()) >= language.LEAST}
        totals = {x: sum(c[x] for c in table.values()) + 0.5 * len(table) + 1 for x in languages}
        return {t: [math.log((c[x] + 0.5) / totals[x]) for x in languages] for t, c in table.items()}

    sizes = Counter(lang for lang, _ in rows)
    prior = [math.log(sizes[x] / len(rows)) for x in languages]
    return languages, prior, logs(words), {n: logs(t) for n, t in grams.items()}


def plain_scores(model, text):
    languages, prior, words, grams = model
    found = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not found:
        return "und", 0.0
    total = list(prior)
    for word in found:
        rows = [words[word]] if word in words else []
        for n in language.LENGTHS:
            if rows:
                break
            padded = f" {word} "
            parts = [padded[i : i + n] for i in range(max(1, len(padded) - n + 1))]
            rows = [grams[n][p] for p in parts if p in grams[n]]
        rows = rows or [[0.0] * len(languages)]
        means = [sum(column) / len(rows) for column in zip(*rows, strict=True)]
        total = [t + max(m - max(means), -8.0) for t, m in zip(total, means, strict=True)]
    odds = [math.exp((t - max(total)) / math.sqrt(len(found))) for t in total]
    best = odds.index(max(odds))
    return languages[best], odds[best] / sum(odds)


def test_like_a_plain_scorer(documents):
    rows = documents.select("doc_id", "lang", "text", held_out().alias("out")).collect()
    model = plain_model([(r["lang"], r["text"]) for r in rows if r["lang"] and r["text"] is not None and not r["out"]])
    got = {r["doc_id"]: r for r in language.identify(documents, language.learn(documents)).collect()}
    unseen = 0
    for r in rows:
        lang, score = plain_scores(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == lang
        assert got[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-9)
        unseen += any(w not in model[2] for w in language.words_of(r["text"]))
    assert unseen > 20  # words that only n-grams tell


def test_equal_scores_go_to_the_first_language(frame):
    docs = frame(["same words here"] * 8, ids=range(0, 80, 10))
    docs = docs.withColumn("lang", F.expr("if(doc_id % 20 = 0, 'zz', 'aa')")).where(~held_out())
    balanced = docs.where("lang = 'aa'").limit(1).union(docs.where("lang = 'zz'").limit(1))
    balanced = balanced.union(balanced).union(balanced)
    got = language.identify(frame(["same words", "others"]), language.learn(balanced)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("aa", 0.5)}
