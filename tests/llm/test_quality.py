import random

import numpy as np
import pytest

from dimhistory.llm import quality


def plain_counts(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_counts_against_the_definition():
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(rng.choices(["a ", "b ", "\n", "é|", " #", "\x0b", "\x1c", "c d e f g h i j k "], k=40))
        assert quality.text_counts(text)[:5] == plain_counts(text)


def test_odd_documents(odd, spark):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    judged = quality.judge(odd, labels).collect()
    assert len(judged) == odd.count()
    by_id = {r["doc_id"]: r for r in judged}
    assert by_id[0]["n_words"] == 0 and by_id[0]["base_failed"] and not by_id[0]["kept"]
    assert by_id[3]["base_failed"]  # repeats itself
    assert quality.judge(odd, labels.limit(0)).count() == odd.count()
    assert quality.judge(odd.limit(0), labels).count() == 0


def test_list_learns_thresholds_and_keeps_clean_rows():
    rng = np.random.default_rng(0)
    n = 3000
    x = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    low = ((x["a"] > 0.8) & (x["b"] > 0.5)) | (x["c"] < 0.05)
    rules = quality.learn_rules(x, low, rng.random(n) < 0.33)
    found = np.zeros(n, bool)
    for rule in rules:
        assert 1 <= len(rule.conditions) <= 3
        found |= rule.holds(x, n)
    assert (found & low).sum() > 0.8 * low.sum()
    assert (found & ~low).sum() < 0.03 * (~low).sum()


@pytest.mark.parametrize("low", [np.zeros(50, bool), np.ones(50, bool), np.zeros(0, bool)])
def test_one_class_or_none(low):
    x = {"a": np.arange(len(low), dtype=float)}
    rules = quality.learn_rules(x, low, np.arange(len(low)) % 3 == 0)
    assert not rules or low.all()


def test_expression_is_the_list(spark, documents):
    c = quality.Condition
    rules = [
        quality.Rule((c("n_words", False, 60.0), c("upper_per_char", True, 0.02)), 1.0),
        quality.Rule((c("symbols_per_word", True, 0.1),), 1.0),
    ]
    rows = quality.with_counts(documents).withColumn("kept", quality.kept_expression(rules)).collect()
    for r in rows:
        words = max(r["n_words"], 1)
        first = r["n_words"] <= 60 and r["n_upper"] / max(r["word_chars"], 1) > 0.02
        assert r["kept"] == (not first and not r["n_symbols"] / words > 0.1)


def plain_rules(x, low, apart, precision=0.8, least=5, steps=48, max_conditions=3):
    """The covering by trying every threshold of every statistic, row by row."""
    rows = range(len(low))
    prior, left, rules = sum(low) / len(low), set(rows), []

    def share(some):
        bad = sum(low[i] for i in some)
        return (bad + 2 * prior) / (len(some) + 2), bad

    def meets(i, condition):
        name, above, cut = condition
        return x[name][i] > cut if above else x[name][i] <= cut

    while len(rules) < 12:
        grow, prune = {i for i in left if not apart[i]}, {i for i in left if apart[i]}
        if sum(low[i] for i in grow) < least:
            break
        tried = []
        for name in x:
            values = sorted(x[name][i] for i in grow)
            seen = sorted({values[int((len(values) - 1) * q / steps)] for q in range(steps + 1)})
            for a, b in zip(seen, seen[1:], strict=False):
                tried += [(name, above, (a + b) / 2) for above in (True, False)]
        inside, rule = set(grow), []
        while len(rule) < max_conditions:
            base = np.log2(share(inside)[0])
            best, gain = None, 0.0
            for condition in tried:
                some = {i for i in inside if meets(i, condition)}
                chance, bad = share(some)
                won = bad * (np.log2(chance) - base) if bad >= least else 0
                if won > gain + 1e-9:
                    best, gain, covered = condition, won, some
            if best is None:
                break
            rule.append(best)
            inside = covered
            if all(low[i] for i in inside):
                break
        if not rule:
            break

        def judged(conditions, prune=prune):
            return share({i for i in prune if all(meets(i, c) for c in conditions)})

        while len(rule) > 1:
            shorter = max((rule[:i] + rule[i + 1 :] for i in range(len(rule))), key=lambda r: judged(r)[0])
            if judged(shorter)[0] < judged(rule)[0]:
                break
            rule = shorter
        if judged(rule)[0] < precision or not judged(rule)[1]:
            break
        rules.append(rule)
        left -= {i for i in left if all(meets(i, c) for c in rule)}
    return rules


@pytest.mark.parametrize("seed", [0, 1, 3, 5])
def test_covering_against_every_threshold(seed):
    rng = np.random.default_rng(seed)
    n = 240
    x = {name: rng.random(n).round(3) for name in "abc"}
    low = ((x["a"] > 0.7) & (x["b"] > 0.4)) | (x["c"] < 0.15) | (rng.random(n) < 0.03)
    apart = rng.random(n) < 0.33
    got = quality.learn_rules(x, low, apart)
    want = plain_rules({k: v.tolist() for k, v in x.items()}, low.tolist(), apart.tolist())
    assert [[(c.statistic, c.above, pytest.approx(c.threshold)) for c in r.conditions] for r in got] == want
    assert got
