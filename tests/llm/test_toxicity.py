import numpy as np
import pytest

from dimhistory.llm import toxicity
from dimhistory.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def larger():
    from pathlib import Path

    path = "/root/testdata/sf0.1"
    if not Path(path).exists():
        pytest.skip("no test data")
    return path


def test_held_out_rows_are_told_apart(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    rows = QUERIES["op4_toxicity"](spark, larger).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit >= 0.85 * sum(r["toxic"] for r in rows)
    assert hit >= 0.9 * sum(r["predicted"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_label_model_finds_accuracies_and_echoes():
    rng = np.random.default_rng(1)
    n = 6000
    truth = rng.random(n) < 0.15
    votes = np.zeros((n, 6), int)
    for v, (hit, miss) in enumerate([(0.9, 0.02), (0.6, 0.05), (0.4, 0.02), (0.7, 0.04)]):
        votes[:, v] = rng.random(n) < np.where(truth, hit, miss)
    votes[:, 4] = votes[:, 1]  # an echo
    votes[:, 5] = -(rng.random(n) < np.where(truth, 0.05, 0.8)).astype(int)
    model = toxicity.fit_label_model(votes, prior=0.15)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.97
    # the echo and what it repeats share one say; no other two voters do
    assert model.correlations[1, 4] > 0.85 and np.sort(model.correlations[np.triu_indices(6, 1)])[-2] < 0.4
    assert max(model.weights[[1, 4]]) < 0.55 < min(model.weights[[0, 2, 3, 5]])
    assert np.allclose(model.rates[:, 0], [0.02, 0.9], atol=0.06)
    assert np.allclose(model.rates[:, 5], [0.8, 0.05], atol=0.06)
    # no voter may be taken for its opposite
    assert (model.rates[1, :5] >= model.rates[0, :5]).all() and model.rates[1, 5] <= model.rates[0, 5]


def learned(spark, sf_dir, monkeypatch, change=lambda model: model, **options):
    """The classifier and what its label model said, which ``change`` may alter."""
    seen = {}
    fit = toxicity.fit_label_model

    def watched(votes, prior):
        model = change(fit(votes, prior))
        seen.update(votes=votes, model=model, soft=model.posterior(votes))
        return model

    train = toxicity._train

    def trained(rows, target, size):
        seen["target"] = target
        return train(rows, target, size)

    with monkeypatch.context() as patch:
        patch.setattr(toxicity, "fit_label_model", watched)
        patch.setattr(toxicity, "_train", trained)
        docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
        classifier = toxicity.learn(docs, labels, **options)
    return classifier, seen


def test_the_voters_decide_and_labels_do_not_vote(spark, larger, monkeypatch):
    classifier, seen = learned(spark, larger, monkeypatch)
    # rows without a label are among those that the model is fitted on
    labelled = spark.read.parquet(f"{larger}/labels.parquet").count()
    assert len(seen["votes"]) > 1.2 * labelled
    # the classifier is trained on the posterior of the votes alone
    soft = seen["soft"]
    assert np.array_equal(seen["target"], soft)
    assert seen["votes"].shape[1] == len(toxicity.PATTERNS) + 5 * len(toxicity.BEGINNINGS) + 1

    # what is known of the voters moves what is learned
    def blunt(model):
        strong = np.argsort(-np.abs(np.log(model.rates[1] / model.rates[0])) * model.weights)[:6]
        model.rates[:, strong] = model.rates[:, strong].mean(axis=0)
        return model

    other, blunted = learned(spark, larger, monkeypatch, blunt)
    assert other.tokens == classifier.tokens
    assert np.abs(blunted["soft"] - soft).max() > 0.3
    assert np.abs(other.weights - classifier.weights).max() > 0.1


def test_long_words_that_begin_alike_are_told_apart():
    twins = ["x" * 40 + "a", "x" * 40 + "b"]
    assert toxicity.tokens_of(twins[:1]) ^ toxicity.tokens_of(twins[1:]) == {f"0{w}" for w in twins}


def test_odd_documents(odd, spark):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 1), (None, 0, 1), (5, 0, None)], LABELS)
    for some in (labels, labels.limit(0)):
        got = toxicity.score(odd, toxicity.learn(odd, some)).collect()
        assert len(got) == odd.count()
        assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(odd.limit(0), toxicity.Classifier()).count() == 0
    assert toxicity.learn(odd.limit(0), labels).tokens == {}


def test_without_labels_the_lexicon_speaks(frame, spark):
    texts = [f"you are a stupid idiot and a moron {i}" for i in range(12)] + [f"a quiet walk {i}" for i in range(80)]
    docs = frame(texts)
    model = toxicity.learn(docs, spark.createDataFrame([], LABELS))
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert min(rows[i] for i in range(12)) > max(rows[i] for i in range(12, 92))


def test_rows_that_repeat_an_id_count_once(frame, spark, monkeypatch):
    texts = [f"a quiet walk by the river {i}" for i in range(20)]
    docs = frame(texts).union(frame([texts[0]] * 50, ids=[0] * 50))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], LABELS)
    seen = []
    monkeypatch.setattr(toxicity, "_mined", lambda rows: seen.append(rows.groupBy("doc_id").count().collect()) or [])
    toxicity.learn(docs, labels)
    assert seen[0] and all(r["count"] == 1 for r in seen[0])
