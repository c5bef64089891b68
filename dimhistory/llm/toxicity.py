"""Toxicity by weak supervision.

Many voters look at a text: lexicons (a written one and words and word beginnings mined from
labelled rows, dealt into groups), patterns, and voters for "nothing suspicious here". A
generative label model estimates from their agreements, over rows with and without a label, how
accurate each voter is and which of them repeat each other. Its posterior labels train a linear
classifier over the mined words and patterns, which scores the texts.

Given labels are no voters and no targets. They serve to mine the lexicons, to tell how common the
label is, and to calibrate the score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory.llm.bpe import Remembered
from dimhistory.llm.frames import arrow_schema, held_out, map_texts, sampled

#: About so many rows are learned from; up to two thirds of them are labelled ones.
SAMPLE = 30_000
#: Lengths of word beginnings that are mined beside whole words (0).
BEGINNINGS = (0, 4, 5, 6)
#: A mined token is in at least so many toxic rows, and its log odds, less two standard errors,
#: are at least so large; and at most one row in eight that holds it isn't toxic. (The floor of
#: four was chosen over three and five on folds of the rows that may be learned from.)
LEAST, ODDS, PURE = 4, 1.0, 0.87
#: Groups into which the mined tokens of a length are dealt.
GROUPS = 4
#: Share of toxic rows without labels, and fits of the label model.
PRIOR = 0.1
FITS = 5

#: Common insults in four languages; fixed values.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash filth pathetic worthless "
    "disgusting clown clowns vermin parasite retard scumbag bastard bitch asshole "
    "dumm dummkopf trottel vollidiot arschloch abschaum widerlich erbärmlich wertlos schlampe "
    "imbécile crétin débile connard connasse salope ordure minable pourriture abruti "
    "imbécil estúpido estúpida idiota basura asqueroso asquerosa patético inútil escoria cabrón".split()
)
PATTERNS = ("insults", "several_insults", "shouting", "exclaiming", "accusing")
_WORD = re.compile(r"[^\W\d_]+")
_ACCUSING = re.compile(
    r"\b(?:you|u|du|ihr|tu|vous|t[uú]|vosotros)\b\W+(?:\w+\W+){0,4}?(?:"
    + "|".join(sorted(INSULTS))
    + r")\b",
    re.I,
)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def tokens_of(words: Iterable[str]) -> set[str]:
    """Whole words, and the beginnings of longer ones after their length."""
    out = set()
    for word in words:
        out.add(f"0{word}")
        out.update(f"{n}{word[:n]}" for n in BEGINNINGS if n and len(word) > n)
    return out


def patterns_of(text: str | None, words: list[str]) -> list[bool]:
    text = text or ""
    insults = sum(map(INSULTS.__contains__, words))
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, text)) if letters else 0
    marks = text.count("!")
    return [
        insults > 0,
        insults > 1,
        upper > 0.5 * letters > 0,
        marks > 0.3 * len(words) > 0,
        insults > 0 and _ACCUSING.search(text) is not None,
    ]


# -- mining ------------------------------------------------------------------------------


def _mined(rows: DataFrame) -> list[str]:
    """Tokens that labelled toxic rows hold far more often than others, in a fixed order."""
    ddl = "token string, toxic long, other long"
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(batch.column(0), batch.column(1), strict=True):
                counts[0 if label.as_py() else 1].update(tokens_of(set(words_of(text.as_py()))))
            every = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(every), *[pa.array([c[t] for t in every], pa.int64()) for c in counts]],
                schema=schema,
            )

    n = rows.agg(F.sum(F.col("label").cast("long")).alias("t"), F.count("*").alias("n")).first()
    toxic, other = n["t"] or 0, n["n"] - (n["t"] or 0)
    if not toxic or not other:
        return []
    odds = F.expr(f"ln((toxic + 0.5) / {toxic + 1}) - ln((other + 0.5) / {other + 1})")
    error = F.expr("sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))")
    found = (
        rows.select("label", "text")
        .mapInArrow(run, ddl)
        .groupBy("token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= LEAST) & (odds - 2 * error >= ODDS))
        .where((F.col("toxic") + 0.5) / (F.col("toxic") + F.col("other") + 1) >= PURE)
    )
    return sorted(r["token"] for r in found.select("token").collect())


# -- the label model ---------------------------------------------------------------------


@dataclass
class LabelModel:
    """Votes of -1, 0 and 1 explained by a hidden label.

    ``rates[y, v]`` is the chance that voter v votes, rather than abstains, under label y. A
    voter votes one way only; what it says by a vote, and by abstaining, follows from its rates.
    ``weights`` is how much of a voter is its own: voters that err together share one say.
    """

    prior: float
    rates: np.ndarray
    weights: np.ndarray
    correlations: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of votes."""
        return 1 / (1 + np.exp(-np.clip(self.says(votes != 0).sum(axis=1) + self.base, -35, 35)))

    @property
    def base(self) -> float:
        return float(np.log(self.prior / (1 - self.prior)))

    def says(self, voted: np.ndarray) -> np.ndarray:
        """The log odds that each voter adds to a row."""
        vote = np.log(self.rates[1] / self.rates[0])
        silence = np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        return np.where(voted, vote, silence) * self.weights


def fit_label_model(votes: np.ndarray, prior: float = PRIOR, rounds: int = 25) -> LabelModel:
    """Expectation maximisation from agreements, each time with the echoes that were found before.

    A voter starts, and stays, better than chance. ``prior`` is the share of label 1, which votes
    that are left out cannot tell. The first fit takes all voters for their own; the fits after it
    begin anew, with the correlations under the labels of the last.
    """
    m = votes.shape[1]
    voted = (votes != 0).astype(np.float64)
    side = np.where((votes > 0).any(axis=0), 1.0, -1.0)
    share = np.clip(voted.mean(axis=0), 1e-3, 0.999)
    tilt = np.where(side > 0, 4.0, 1 / 4.0)
    start = np.clip(np.stack([share / np.sqrt(tilt), share * np.sqrt(tilt)]), 1e-3, 0.999)
    model = LabelModel(prior, start, np.ones(m), np.eye(m))
    for fit in range(FITS):
        if fit:
            model.correlations = _correlations(model, voted, side)
            model.weights = 1 / np.maximum(1, np.clip(model.correlations, 0, 1).sum(axis=1))
        model.rates = start
        for _ in range(rounds):
            p = model.posterior(votes)
            no, yes = (1 - p).sum() + 2, p.sum() + 2
            rates = np.stack([((1 - p) @ voted + 2 * share) / no, (p @ voted + 2 * share) / yes])
            middle = np.sqrt(rates[0] * rates[1])
            wrong = (rates[1] - rates[0]) * side < 0
            rates[:, wrong] = middle[wrong]
            model.rates = np.clip(rates, 1e-5, 1 - 1e-5)
    return model


def _correlations(model: LabelModel, voted: np.ndarray, side: np.ndarray) -> np.ndarray:
    """How much each two voters repeat each other, beyond what the label makes them share.

    The label is taken from all voters but the two: with them, one that is followed would count
    as the label itself, and its echo as right.
    """
    says = model.says(voted > 0)
    total = says.sum(axis=1) + model.base
    found = np.eye(voted.shape[1])
    for u in range(voted.shape[1]):
        for v in range(u):
            pair = voted[:, [u, v]]
            p = 1 / (1 + np.exp(-np.clip(total - says[:, u] - says[:, v], -35, 35)))
            yes = (p @ pair) / max(p.sum(), 1e-9)
            no = ((1 - p) @ pair) / max((1 - p).sum(), 1e-9)
            rest = (pair - p[:, None] * yes - (1 - p)[:, None] * no) * side[[u, v]]
            spread = np.sqrt((rest**2).mean(axis=0))
            # two good voters agree where the label is in doubt, without repeating each other
            doubt = (p * (1 - p)).mean() * ((yes - no) * side[[u, v]]).prod()
            if spread.min() > 1e-6:
                shared = (rest[:, 0] * rest[:, 1]).mean() - doubt
                found[u, v] = found[v, u] = shared / spread.prod()
    return found


def votes_of(features: list[np.ndarray], tokens: list[str]) -> np.ndarray:
    """A row of votes per row of feature numbers (patterns first, mined tokens after them)."""
    n_patterns = len(PATTERNS)
    voter = np.array(
        [
            BEGINNINGS.index(int(t[0])) * GROUPS + zlib.crc32(t.encode()) % GROUPS for t in tokens
        ],
        np.int64,
    )
    n_groups = len(BEGINNINGS) * GROUPS
    votes = np.zeros((len(features), n_patterns + n_groups + len(BEGINNINGS) + 1), np.int64)
    for row, numbers in zip(votes, features, strict=True):
        row[numbers[numbers < n_patterns]] = 1
        hit = voter[numbers[numbers >= n_patterns] - n_patterns]
        row[n_patterns + hit] = 1
        clean = np.ones(len(BEGINNINGS), bool)
        clean[hit // GROUPS] = False
        row[n_patterns + n_groups :][: len(BEGINNINGS)] = np.where(clean, -1, 0)
        row[-1] = 0 if 0 in numbers else -1
    return votes


# -- the classifier ----------------------------------------------------------------------


@dataclass
class Classifier:
    tokens: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = -3.0

    def features(self) -> Remembered:
        """From a word to the numbers of its tokens among the features."""
        get = self.tokens.get

        def numbers(word: str) -> tuple[int, ...]:
            return tuple(n for t in tokens_of([word]) if (n := get(t)) is not None)

        return Remembered(numbers)


def _features(text: str | None, known: Remembered) -> set[int]:
    words = words_of(text)
    found = {i for i, hit in enumerate(patterns_of(text, words)) if hit}
    for word in set(words):
        found.update(known[word])
    return found


def _train(rows: list[np.ndarray], target: np.ndarray, size: int, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, over binary features given by their numbers."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64) if len(row) else np.empty(0, np.int64)
    w, b = np.zeros(size), float(np.log((target.mean() + 1e-3) / (1.001 - target.mean())))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, 401):
        z = np.bincount(row, w[column], len(rows)) + b
        miss = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - target
        grad = np.append(np.bincount(column, miss[row], size) / len(rows) + ridge * w, miss.mean())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _calibrate(z: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the score a chance, by labelled rows."""
    a, b = 1.0, 0.0
    target = np.where(label, 1 - 1 / (label.sum() + 2), 1 / ((~label).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        grad = np.array([((p - target) * z).mean(), (p - target).mean()])
        s = p * (1 - p) + 1e-6
        hess = np.array([[(s * z * z).mean(), (s * z).mean()], [(s * z).mean(), s.mean()]])
        step = np.linalg.solve(hess + 1e-4 * np.eye(2), grad)
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE) -> Classifier:
    """A classifier from about ``sample`` rows that are not held out, with and without a label.

    Several labels of an id count by their mean. Rows are chosen by a hash of their id, or of the
    text where there is none; of several rows with one id the first text counts. Without labels
    nothing is mined, and written lexicon, patterns and label model stand alone.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg(label_col) >= 0.5).alias("label"))
    )
    total = known.count()
    # bounded by two thirds of ``sample`` rows of two narrow columns
    chosen = sampled(known, "doc_id", sample * 2 // 3, total)
    labelled = min(total, sample * 2 // 3)
    key = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.col("text").cast("binary"), 256))
    rows = docs.where(~held_out()).select("doc_id", key.alias("key"), "text")
    share = (sample - labelled) / max(rows.count(), 1)
    cells = 1 << 30
    place = F.pmod(F.xxhash64("key", F.lit("unlabelled")), F.lit(cells))
    rows = rows.join(F.broadcast(chosen), "doc_id", "left")
    rows = rows.where(F.col("label").isNotNull() | (place < int(cells * min(1.0, share))))
    # one row of an id, the same one each time the rows are read
    rows = rows.groupBy(F.col("key").alias("doc_id"))
    rows = rows.agg(F.min("text").alias("text"), F.first("label").alias("label"))
    tokens = _mined(rows.where("label IS NOT NULL")) if total else []
    model = Classifier({t: i + len(PATTERNS) for i, t in enumerate(tokens)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        numbers = shared.value.features()
        return lambda label, text: (label, sorted(_features(text, numbers)))

    found = map_texts(rows, ["label", "text"], "label boolean, found array<int>", make).collect()
    if not found:
        return model
    features = [np.array(r["found"], np.int64) for r in found]
    label = np.array([bool(r["label"]) for r in found])
    has = np.array([r["label"] is not None for r in found])
    prior = float((label.sum() + 10 * PRIOR) / (has.sum() + 10))
    votes = votes_of(features, tokens)
    soft = fit_label_model(votes, prior).posterior(votes)
    weights, bias = _train(features, soft, len(PATTERNS) + len(tokens))
    if label.any() and not label[has].all():
        z = np.array([weights[f].sum() for f in features]) + bias
        a, b = _calibrate(z[has], label[has])
        weights, bias = a * weights, a * bias + b
    return Classifier(model.tokens, weights, bias)


def score(docs: DataFrame, classifier: Classifier, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of each row of ``docs`` (doc_id, text).

    Only the text is read. Null and empty texts have no features and score what the bias says;
    repeated rows stay; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def make():
        model = shared.value
        numbers, weights = model.features(), model.weights

        def row(key, text):
            z = sum(weights[i] for i in sorted(_features(text, numbers))) + model.bias
            chance = float(1 / (1 + np.exp(-np.clip(z, -35, 35))))
            return key, chance, int(chance >= threshold)

        return row

    return map_texts(docs, ["doc_id", "text"], f"doc_id {kind}, score double, predicted int", make)
