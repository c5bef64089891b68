"""Language of a text by its words, with character n-grams for words never seen.

A word of the model scores its log frequency in each language. Any other word is cut into
character n-grams of the longest length of which the model knows some; those score their mean log
frequency. The scores of all words add up, and the best language wins.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory.llm.frames import arrow_schema, held_out, map_texts

UNKNOWN = "und"
#: Lengths of the n-grams, from the longest down; a blank stands for the ends of a word.
LENGTHS = (5, 4, 3, 2, 1)
#: Rows a language is learned from, by expectation. They bound the model.
SAMPLE = 5_000
#: Words and n-grams seen less often in the sample are left out. (A language of a handful of rows
#: is then told by its frequent words and short n-grams alone.)
LEAST = 3
REMEMBERED = 200_000
#: Letters of a word that is remembered and learned as it is. Longer ones, such as sentences
#: without blanks, are known by a digest, and their n-grams are taken one after the other.
LONGEST = 64
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    words = _WORD.findall((text or "").lower())
    return words if all(map(str.isalpha, words)) else [w for w in words if any(map(str.isalpha, w))]


def grams(word: str, length: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + length] for i in range(max(1, len(padded) - length + 1))]


def long_grams(word: str, length: int) -> Iterator[str]:
    """The same n-grams in constant memory."""
    padded = f" {word} "
    return (padded[i : i + length] for i in range(max(1, len(padded) - length + 1)))


def long_key(word: str) -> str:
    """What a word of more than ``LONGEST`` letters is known by; no word has a #."""
    return "#" + hashlib.blake2b(word.encode(), digest_size=16).hexdigest()


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    #: From words, and from n-grams of each length, to their rows of ``logs``.
    words: dict[str, int]
    grams: list[dict[str, int]]
    #: Log frequencies, one column per language; the last row is for words without any match.
    logs: np.ndarray


def _counts(docs: DataFrame) -> DataFrame:
    """``(lang, kind, token, n)`` of a sample: kind 0 for words, else the length of n-grams.

    Tasks add up their own words; n-grams come from the distinct words with their counts, those
    of words over ``LONGEST`` letters from the tasks.
    """
    ddl = "lang string, kind int, token string, n long"
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                by_lang.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            rows = []
            for lang, counted in by_lang.items():
                parts: Counter = Counter()
                for word, n in counted.items():
                    if len(word) <= LONGEST:
                        rows.append((lang, 0, word, n))
                        continue
                    rows.append((lang, 0, long_key(word), n))
                    for length in LENGTHS:
                        for gram in long_grams(word, length):
                            parts[length, gram] += n
                rows += [(lang, length, gram, n) for (length, gram), n in parts.items()]
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    words = docs.select("lang", "text").mapInArrow(run, ddl)
    words = words.groupBy("lang", "kind", "token").agg(F.sum("n").alias("n"))
    whole = (F.col("kind") > 0) | F.col("token").startswith("#")
    kinds = F.when(whole, F.array("kind")).otherwise(F.array(*map(F.lit, (0, *LENGTHS))))
    padded = F.concat(F.lit(" "), "token", F.lit(" "))
    last = F.greatest(F.lit(1), F.length("padded") - F.col("kind") + 1)
    at = F.when(F.col("whole"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), last))
    every = (
        words.select("lang", "token", "n", padded.alias("padded"), whole.alias("whole"), F.explode(kinds).alias("kind"))
        .withColumn("whole", F.col("whole") | (F.col("kind") == 0))
        .select("lang", "kind", "token", "n", "padded", F.explode(at).alias("at"))
        .withColumn("token", F.expr("if(at = 0, token, substring(padded, at, kind))"))
    )
    return every.groupBy("lang", "kind", "token").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the rows that are not held out and have a language and a text.

    About ``sample`` rows of each language are used, by a hash of the id, all where there are
    fewer; the share of each language in all rows is its prior.
    """
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), {}, [{} for _ in LENGTHS], np.zeros((1, 0)))
    cells = 1 << 20
    cut = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, math.ceil(cells * min(1, sample / sizes[lang])))]
    )
    cell = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(cells))
    counted = _counts(rows.where(cell < cut[F.col("lang")]))
    kept = (
        counted.groupBy("kind", "token")
        .agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
        .where(F.col("total") >= LEAST)
        .select("kind", "token", *[F.coalesce(F.col("by")[x], F.lit(0)).cast("double") for x in languages])
        .toPandas()
    )
    counts = kept.iloc[:, 2:].to_numpy(float)
    tables, logs = [], np.zeros((len(kept) + 1, len(languages)))
    for kind in (0, *LENGTHS):
        chosen = np.flatnonzero(kept["kind"].to_numpy() == kind)
        n = counts[chosen]
        logs[chosen] = np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * len(n) + 1))
        tables.append(dict(zip(kept["token"].iloc[chosen], chosen.tolist(), strict=True)))
    prior = np.array([sizes[x] for x in languages], float)
    return Model(languages, np.log(prior / prior.sum()), tables[0], tables[1:], logs)


class Scorer:
    """Scores texts, remembering the words it has looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.rows = np.empty((REMEMBERED, len(model.languages)))
        self.at: dict[str, int] = {}

    def _look_up(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word, the best language of a word at 0."""
        rows: list[int] = []
        starts: list[int] = []
        known, nothing = self.model.words.get, len(self.model.logs) - 1
        backoff = [(n, table.get) for n, table in zip(LENGTHS, self.model.grams, strict=True)]
        for word in words:
            starts.append(len(rows))
            row = known(word)
            if row is not None:
                rows.append(row)
                continue
            for length, get in backoff:
                found = [r for g in grams(word, length) if (r := get(g)) is not None]
                if found:
                    rows += found
                    break
            else:
                rows.append(nothing)
        sums = np.add.reduceat(self.model.logs[rows], starts, axis=0)
        means = sums / np.diff(starts, append=len(rows))[:, None]
        # no word decides alone
        return np.maximum(means - means.max(axis=1, keepdims=True), -8.0)

    def _long(self, word: str) -> np.ndarray:
        """The row of a word of more than ``LONGEST`` letters, in memory bounded by the model."""
        row = self.model.words.get(long_key(word))
        found = Counter() if row is None else Counter([row])
        for length, table in zip(LENGTHS, self.model.grams, strict=True):
            if found:
                break
            found.update(r for g in long_grams(word, length) if (r := table.get(g)) is not None)
        rows = [*found] or [len(self.model.logs) - 1]
        mean = np.average(self.model.logs[rows], axis=0, weights=[*found.values()] or None)
        return np.maximum(mean - mean.max(), -8.0)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        counted = Counter(words)
        total = self.model.prior.copy()
        keys = [word for word in counted if len(word) <= LONGEST]
        if len(keys) < len(counted):
            total += sum(n * self._long(word) for word, n in counted.items() if len(word) > LONGEST)
        for start in range(0, len(keys), REMEMBERED // 2):
            part = keys[start : start + REMEMBERED // 2]
            if len(self.at) + len(part) > REMEMBERED:
                self.at.clear()
            fresh = [word for word in part if word not in self.at]
            if fresh:
                end = len(self.at) + len(fresh)
                self.rows[len(self.at) : end] = self._look_up(fresh)
                self.at.update(zip(fresh, range(len(self.at), end), strict=True))
            rows = np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))
            total += np.array([counted[w] for w in part], float) @ self.rows[rows]
        # neighbouring words are not independent: evidence grows with the root of their number
        total = (total - total.max()) / math.sqrt(len(words))
        odds = np.exp(total)
        best = int(np.argmax(odds))
        return self.model.languages[best], float(odds[best] / odds.sum())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of each row of ``docs`` (doc_id, text).

    Only the text is read. A text that is null or has no letter is ``und`` with score 0, and so
    is every text where nothing could be learned; equal scores go to the first language by name;
    repeated rows stay; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = Scorer(shared.value)
        return lambda key, text: (key, *score(text))

    return map_texts(docs, ["doc_id", "text"], f"doc_id {kind}, lang_pred string, score double", make)
