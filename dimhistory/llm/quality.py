"""Quality rules learned as a decision list.

Each text gets a few statistics. Sequential covering grows one conjunction of thresholds at a
time from labelled statistics (the condition with the largest information gain first), prunes it
on rows kept apart, and keeps it while it is precise enough; then it goes on with the rows not
yet covered. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimhistory.llm.frames import map_texts, sampled

WINDOW = 8
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
_MARKS = b"!?"

#: Statistics that conditions may use, as SQL over the counted columns.
STATISTICS = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_per_char": "n_upper / greatest(word_chars, 1)",
    "digits_per_char": "n_digits / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "ended_line_share": "n_ended_lines / greatest(n_lines, 1)",
    "echo_share": "n_echoes / greatest(n_words, 1)",
}
COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_digits long, n_marks long, n_distinct_words long, "
    "n_ended_lines long, n_echoes long"
)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that the text holds twice or more.

    Windows are first numbered by a 64-bit mix of their words' numbers. Only where two agree
    are the windows' words compared, so the mix decides nothing by itself.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    odd = np.uint64(0x9E3779B97F4A7C15)
    mixed = ids.astype(np.uint64) * odd
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    window = np.zeros(n, np.uint64)
    for i in range(width):
        window = window * odd + mixed[i : i + n]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    seen: dict[bytes, int] = {}
    again = np.zeros(n, bool)
    alike = np.zeros(n, bool)
    alike[1:] |= same
    alike[:-1] |= same
    for at in np.sort(order[alike]).tolist():
        first = seen.setdefault(ids[at : at + width].tobytes(), at)
        if first != at:
            again[at] = again[first] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[width : width + n] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple:
    """The counted columns of one text; a null text counts as empty."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    chars = len(raw.translate(None, SPACES + _CONTINUATION))
    return (
        len(words),
        chars,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _DIGITS)),
        len(raw) - len(raw.translate(None, _MARKS)),
        len(set(words)),
        sum(line.rstrip(SPACES)[-1:] in (b".", b"!", b"?", b":", b'"') for line in lines),
        sum(map(operator.eq, words, words[1:])),
    )


def with_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, counts)``, one row per row: see ``COUNTS``. Null and empty texts count 0."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        return lambda key, text: (key, *text_counts(text))

    return map_texts(df, [id_col, text_col], f"{id_col} {kind}, {COUNTS}", make)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        values = x[self.statistic]
        return values > self.threshold if self.above else values <= self.threshold

    def expression(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the text is rejected. ``precision`` is that of the pruning rows."""

    conditions: tuple[Condition, ...]
    precision: float

    def holds(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        out = np.ones(n, bool)
        for condition in self.conditions:
            out &= condition.holds(x)
        return out

    def expression(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.expression()
        return out


def _candidates(x: dict[str, np.ndarray], steps: int) -> list[Condition]:
    out = []
    for name, values in x.items():
        seen = np.unique(np.quantile(values, np.linspace(0, 1, steps + 1), method="lower"))
        # halfway between values, so that a row near one side isn't judged by the other
        cuts = (seen[1:] + seen[:-1]) / 2
        out += [Condition(name, above, float(c)) for c in cuts for above in (True, False)]
    return out


def _smoothed(bad: float, good: float, prior: float) -> float:
    return (bad + 2 * prior) / (bad + good + 2)


def learn_rules(
    x: dict[str, np.ndarray],
    low: np.ndarray,
    apart: np.ndarray,
    precision: float = 0.8,
    max_rules: int = 12,
    max_conditions: int = 3,
    least: int = 5,
    steps: int = 48,
) -> list[Rule]:
    """An ordered list of rules for ``low`` rows. Rows ``apart`` prune and judge, others grow."""
    rules: list[Rule] = []
    left = np.ones(len(low), bool)
    prior = float(low.mean()) if len(low) else 0.0
    while len(rules) < max_rules:
        grow, prune = left & ~apart, left & apart
        bad, good = (grow & low).sum(), (grow & ~low).sum()
        if bad < least:
            break
        conditions: list[Condition] = []
        inside = grow.copy()
        tried = _candidates({k: v[grow] for k, v in x.items()}, steps)
        masks = [(c, c.holds(x)) for c in tried]
        for _ in range(max_conditions):
            base = np.log2(max(_smoothed(bad, good, prior), 1e-12))
            best, gain = None, 0.0
            for condition, mask in masks:
                covered = inside & mask
                b = int((covered & low).sum())
                if b < least:
                    continue
                g = int(covered.sum()) - b
                won = b * (np.log2(max(_smoothed(b, g, prior), 1e-12)) - base)
                if won > gain + 1e-9:
                    best, gain = (condition, covered, b, g), won
            if best is None:
                break
            conditions.append(best[0])
            inside, bad, good = best[1:]
            if not good:
                break
        if not conditions:
            break

        def judged(some: list[Condition], among: np.ndarray) -> tuple[float, int]:
            covered = among & Rule(tuple(some), 0).holds(x, len(low))
            b = int((covered & low).sum())
            return _smoothed(b, int(covered.sum()) - b, prior), b

        while len(conditions) > 1:
            options = [conditions[:i] + conditions[i + 1 :] for i in range(len(conditions))]
            shorter = max(options, key=lambda o: judged(o, prune)[0])
            if judged(shorter, prune)[0] < judged(conditions, prune)[0]:
                break
            conditions = shorter
        sure, found = judged(conditions, prune)
        rule = Rule(tuple(conditions), sure)
        covered = rule.holds(x, len(low))
        if sure < precision or not found:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def kept_expression(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression over the counted columns."""
    if not rules:
        return F.lit(True)
    out = F.when(rules[0].expression(), False)
    for rule in rules[1:]:
        out = out.when(rule.expression(), False)
    return out.otherwise(True)


def base_failed() -> Column:
    few = F.col("n_words") < 20
    return few | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, label_col: str = "quality"
) -> list[Rule]:
    """Rules from about ``sample`` labelled rows, chosen by a hash of the id; all if fewer.

    Rows without label or id are left out; several labels of one id count by their mean, and of
    several texts of an id the first in order is read. No labels give no rules, and all texts are kept. Rows that fail the base rules teach nothing.
    """
    labelled = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        sampled(labelled, "doc_id", sample, labelled.count())
        .groupBy("doc_id")
        .agg((F.avg(label_col) < 0.5).alias("low"))
    )
    # bounded by ``sample`` rows of two narrow columns
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    counted = with_counts(texts).where(~base_failed())
    rows = (
        counted.join(F.broadcast(chosen), "doc_id")
        .select(
            "low",
            (F.xxhash64("doc_id", F.lit("prune")) % 3 == 0).alias("apart"),
            *[F.expr(sql).cast("double").alias(name) for name, sql in STATISTICS.items()],
        )
        .toPandas()
    )
    x = {name: rows[name].to_numpy(float) for name in STATISTICS}
    return learn_rules(x, rows["low"].to_numpy(bool), rows["apart"].to_numpy(bool))


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of each row of ``docs`` (doc_id, text), by ``id_col``.

    Null and empty texts have no words and fail the base rules; repeated rows get the same
    verdict; an empty table gives no rows; other columns are not read.
    """
    rules = fit(docs, labels, sample)
    return (
        with_counts(docs, id_col)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & kept_expression(rules))
    )
