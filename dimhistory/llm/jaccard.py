"""Documents whose sets of word shingles are nearly equal, with prefixes of token combinations.

A token is a shingle. Tokens have one order for all documents: the others by hash, then those
found in many documents. Two sets that are similar enough share a token in their prefixes, the
first tokens in that order; of the smaller set, a shorter prefix does. Prefixes are one token
longer than that needs; then two similar sets share a token of a rare class or two tokens of the
frequent class. So rare tokens are indexed singly and frequent ones in pairs, which splits
their long lists.

Equal sets are one class from the start. Long lists mostly come from groups of near copies, so
before any pairs are made every document is compared with two members of each list it is in, and
with others of the lists that two components still meet in while those are long. Lists within one
component need no pairs. Other long lists come from passages in documents that are not alike: the
tokens of such passages are moved behind all others, in all documents, and the prefixes that held
one are taken anew. The rest is joined; sizes, positions and bitmaps of the sets, which
bound the difference of two sets from below, narrow the pairs, and the words verify them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm import graph
from dimhistory.llm.frames import BROADCAST_IDS, by_ids, release

#: A token in more than this share of the documents comes last in the order. At most
#: (mean tokens a document / share) tokens are, whatever the number of documents.
COMMON_SHARE = 2e-4
#: Tokens that a task counts at a time.
COUNTED = 4_000_000
#: A list of more documents than this belongs to the frequent class.
FREQUENT = 48
#: A list of more documents than this that lies across components is a passage's, and the most
#: rounds in which passages are moved back.
LONG, MOVES = 1_000, 3
#: Words whose hash a task remembers.
REMEMBERED = 100_000
#: 64-bit words of a set's bitmap, and of the wide one that sets of more tokens than ``SMALL``
#: have as well. A bit says whether an odd number of tokens falls on it.
BITS, WIDE, SMALL = 2, 64, 150
#: Most rounds in which documents are compared with members of their lists.
ROUNDS = 2

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles(text: str | None, width: int) -> set:
    """The distinct shingles; all words as one if they are fewer; none without words."""
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


class Hasher:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - self.width + 1)
        out = np.full(n, min(len(words), self.width), np.uint64)
        for i in range(min(self.width, len(words))):
            out = (out ^ h[i : i + n]) * _M1
            out = (out ^ (out >> np.uint64(31))) * _M2
        return np.unique(out ^ (out >> np.uint64(29)))


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _summaries(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (n, fingerprint), and rows of tokens that a task has met often."""

    def often(tokens: np.ndarray, documents: int) -> pa.RecordBatch:
        values, counts = _repeated(tokens, max(2, COMMON_SHARE * documents / 2))
        lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (values.view(np.int64), counts)]
        head = [pa.array([None], pa.int64()), pa.array([-1], pa.int32()), pa.array([b""], pa.binary())]
        return pa.RecordBatch.from_arrays([*head, *lists], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hasher = Hasher(width)
        seen: set[bytes] = set()
        # one block of memory for the whole task, rather than many small ones
        counted = np.empty(COUNTED, np.uint64)
        held = 0
        for batch in batches:
            sizes, prints = [], []
            for text in batch.column(1):
                tokens = hasher(text.as_py())
                sizes.append(len(tokens))
                prints.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                if prints[-1] in seen or len(tokens) > COUNTED:
                    continue  # a copy, or a set that would be alone; no token repeats in a set
                if held + len(tokens) > COUNTED:
                    yield often(counted[:held], len(seen))
                    seen, held = set(), 0
                seen.add(prints[-1])
                counted[held : held + len(tokens)] = tokens
                held += len(tokens)
            none = pa.nulls(len(sizes), pa.list_(pa.int64()))
            columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, none, none], names=names)
        if held:
            yield often(counted[:held], len(seen))

    names = ["doc_id", "n", "print", "tokens", "counts"]
    schema = "doc_id long, n int, print binary, tokens array<long>, counts array<long>"
    return docs.mapInArrow(run, schema)


def _repeated(tokens: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur at least so often, twice or more. Sorts ``tokens`` in place."""
    tokens.sort()
    same = np.append(tokens[1:] == tokens[:-1], False)
    before = np.append(False, same[:-1])
    first, last = np.flatnonzero(same & ~before), np.flatnonzero(~same & before)
    counts = last - first + 1
    often = counts >= least
    return tokens[first[often]], counts[often]


def _prefixes(docs: DataFrame, common: np.ndarray, width: int, percent: int) -> DataFrame:
    """``(doc_id, n, tokens, wide, b0, b1, ...)``: prefix, one token longer than needed, bitmaps.

    ``common`` tokens come last. ``docs`` may have a third column, the tokens of a row that come
    just before those.
    """
    spread = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hasher, last = Hasher(width), spread.value
        for batch in batches:
            ids, sizes, lengths, found, bitmaps, wide = [], [], [], [], [], []
            moved = batch.column(2) if batch.num_columns > 2 else repeat(None)
            for key, text, back in zip(batch.column(0), batch.column(1), moved):  # noqa: B905
                tokens = hasher(text.as_py())
                n = len(tokens)
                size = _prefix_size(n, percent) + 1
                if size > n:
                    continue  # so small that only equal sets are similar enough
                if back is not None:
                    tokens = _behind(tokens, np.sort(back.values.to_numpy().view(np.uint64)))
                tokens = _behind(tokens, last)
                ids.append(key.as_py())
                sizes.append(n)
                lengths.append(size)
                found.append(tokens[:size].view(np.int64))
                bitmaps.append(_bitmap(tokens, BITS))
                wide.append(_bitmap(tokens, WIDE) if n > SMALL else None)
            ends = np.cumsum([0, *lengths]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            bits = np.array(bitmaps, np.int64).reshape(len(ids), BITS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array(wide, pa.list_(pa.int64())),
                    *[pa.array(bits[:, i]) for i in range(BITS)],
                ],
                names=["doc_id", "n", "tokens", "wide", *_bits()],
            )

    ddl = "doc_id long, n int, tokens array<long>, wide array<long>, "
    ddl += ", ".join(f"{b} long" for b in _bits())
    return docs.mapInArrow(run, ddl)


def _behind(tokens: np.ndarray, late: np.ndarray) -> np.ndarray:
    """``tokens`` with those among the sorted ``late`` after all others."""
    if not len(late):
        return tokens
    at = np.minimum(np.searchsorted(late, tokens), len(late) - 1)
    is_late = late[at] == tokens
    return np.concatenate([tokens[~is_late], tokens[is_late]])


def _token_rows(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, token)`` of all tokens of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(width)
        for batch in batches:
            sets = [hasher(text.as_py()).view(np.int64) for text in batch.column(1)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "tokens"])

    sets = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, tokens array<long>")
    return sets.select("doc_id", F.explode("tokens").alias("token"))


def _passages_behind(
    open_: DataFrame,
    prefixes: DataFrame,
    found: DataFrame,
    docs: DataFrame,
    common: np.ndarray,
    width: int,
    percent: int,
    staging: Staging,
) -> tuple[DataFrame, DataFrame]:
    """``open_`` and ``prefixes`` with the tokens of passages behind all but the common ones.

    A passage shows by lists of more than ``LONG`` documents that lie across components. All
    tokens that so many of these documents have are moved, also those that no prefix held. Then
    every prefix that holds one is taken anew; others stay as they are, so that all follow one
    order. Nothing is moved by these rules below ``LONG`` documents, and the links are the same
    in any order: only fewer pairs are looked at.
    """
    placed = found.withColumnRenamed("node", "doc_id")
    last = docs.sparkSession.createDataFrame(pa.table({"token": pa.array(common.view(np.int64))}))
    moved = None
    for _ in range(MOVES):
        long_ = open_.where(F.col("docs") > LONG).join(F.broadcast(last), "token", "left_anti")
        if moved is not None:
            long_ = long_.join(moved, "token", "left_anti")
        if long_.isEmpty():
            break
        holders = staging.write(by_ids(docs, long_.select("doc_id"), "left_semi"), "holders")
        more = _token_rows(holders, width).groupBy("token").agg(F.count("*").alias("n"))
        more = more.where(F.col("n") > LONG // 2).select("token").union(long_.select("token"))
        more = more if moved is None else more.union(moved)
        moved = more.distinct().join(F.broadcast(last), "token", "left_anti")
        moved = staging.write(moved, "moved")
        held = prefixes.select("doc_id", F.explode("tokens").alias("token")).join(moved, "token", "left_semi")
        held = staging.write(held.select("doc_id").distinct(), "held")
        texts = staging.write(by_ids(docs, held, "left_semi"), "texts")
        own = _token_rows(texts, width).join(moved, "token", "left_semi")
        own = own.groupBy("doc_id").agg(F.collect_list("token").alias("back"))
        anew = _prefixes(texts.join(own, "doc_id").select("doc_id", "text", "back"), common, width, percent)
        prefixes = prefixes.join(held, "doc_id", "left_anti").union(anew)
        prefixes = staging.write(prefixes, "prefixes")
        rows = prefixes.select("doc_id", "n", F.posexplode("tokens").alias("at", "token"))
        rows = rows.join(placed, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        lists = rows.groupBy("token").agg(
            F.count("*").alias("docs"), F.min("component").alias("low"), F.max("component").alias("high")
        )
        lists = lists.where("low <> high").select("token", "docs")
        open_ = staging.write(rows.join(lists, "token"), "open")
    return open_, prefixes


def _bitmap(tokens: np.ndarray, words: int) -> np.ndarray:
    fallen = np.bincount((tokens % np.uint64(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits((fallen & 1).astype(np.uint8)).view(np.int64)


def _bits(prefix: str = "") -> list[str]:
    return [f"{prefix}b{i}" for i in range(BITS)]


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, staging: Staging) -> DataFrame:
    """The ``(a, b)`` whose texts are similar enough, by their words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ours = None, set()
        for batch in batches:
            out = []
            for a, b, one, other in zip(*batch.columns, strict=True):
                if b != last:
                    last, ours = b, shingles(other.as_py(), width)
                theirs = shingles(one.as_py(), width)
                shared = len(ours & theirs)
                if 100 * shared >= percent * (len(ours) + len(theirs) - shared):
                    out.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = staging.write(by_ids(docs, ids, "left_semi"), "texts")
    joined = (
        pairs.select("a", "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other")), "b")
        .select("a", "b", "one", "other")
    )
    return staging.write(joined.mapInArrow(run, "a long, b long"), "verified")


def _may_be_similar(a: str, b: str, percent: int) -> Column:
    """False only where sizes or bitmaps rule it out; ``a`` and ``b`` prefix the columns' names."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum(
        (F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(_bits(a), _bits(b), strict=True)),
        F.lit(0),
    )
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return sizes & _little(apart, n, m, percent)


def _little(apart: Column, n: Column, m: Column, percent: int) -> Column:
    """|a xor b| = n + m - 2 |a and b| <= (n + m) (100 - percent) / (100 + percent)."""
    return apart * (100 + percent) <= (n + m) * (100 - percent)


def similar_documents(
    docs: DataFrame, width: int = 4, percent: int = 85, frequent: int = FREQUENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id that links reach. Documents without words, null
    texts included, have an empty set and no links. Rows that share a doc_id must share the
    text; all are returned. A row without doc_id is returned without component and takes no
    part. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summaries = staging.write(_summaries(docs, width), "summaries")
    own = summaries.where("n >= 0").select("doc_id", "n", "print")
    part = own.where("n > 0 AND doc_id IS NOT NULL")

    # equal sets are one class, known by its smallest document
    classes = staging.write(part.groupBy("print", "n").agg(F.min("doc_id").alias("rep")), "classes")
    copies = part.join(classes.select("print", "rep"), "print").where("doc_id <> rep")
    copies = staging.write(copies.select("doc_id"), "copies")
    n_docs = part.count()
    common = (
        summaries.where("n < 0")
        .select(F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
        .groupBy(F.col("t.tokens").alias("token"))
        .agg(F.sum("t.counts").alias("count"))
        .where(F.col("count") > F.lit(max(COMMON_SHARE * n_docs, frequent)))
        .select("token")
        .toPandas()["token"]
        .to_numpy(np.int64)
        .view(np.uint64)
    )
    found = _linked(docs, copies, np.sort(common), width, percent, frequent, staging)
    named = classes.join(found, classes["rep"] == found["node"], "left").select(
        "print", F.coalesce("component", "rep").alias("component_id")
    )
    return own.join(named, "print", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def _linked(
    docs: DataFrame,
    copies: DataFrame,
    common: np.ndarray,
    width: int,
    percent: int,
    frequent: int,
    staging: Staging,
) -> DataFrame:
    """The components of all links between documents that aren't ``copies``."""
    docs = docs.where("doc_id IS NOT NULL")
    if copies.count() <= BROADCAST_IDS:
        prefixes = _prefixes(docs.join(F.broadcast(copies), "doc_id", "left_anti"), common, width, percent)
    else:  # a shuffle of prefixes is smaller than one of texts
        prefixes = _prefixes(docs, common, width, percent).join(copies, "doc_id", "left_anti")
    prefixes = staging.write(prefixes, "prefixes")
    rows = prefixes.select("doc_id", "n", F.posexplode("tokens").alias("at", "token"))
    ends = [F.min("doc_id").alias("first"), F.max("doc_id").alias("last")]
    lists = rows.groupBy("token").agg(F.count("*").alias("docs"), *ends).where("docs > 1")
    open_ = staging.write(rows.join(lists, "token"), "shared")

    found = tried = None
    for number in range(ROUNDS):
        # each document against two members of its lists, other ones in each round
        hubs = open_.select(F.col("doc_id").alias("a"), F.explode(F.array("first", "last")).alias("b"))
        hubs = hubs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        hubs = _narrowed(hubs.distinct(), prefixes, percent, staging)
        if tried is not None:
            hubs = hubs.join(tried, ["a", "b"], "left_anti")
        hubs = staging.write(hubs, "tried")
        more = _verified(hubs, docs, width, percent, staging)
        tried = hubs if tried is None else tried.union(hubs)
        found = graph.components(more, staging) if found is None else graph.grown(found, more, staging)
        placed = open_.drop("component", "first", "last")
        placed = placed.join(found, placed["doc_id"] == found["node"], "left")
        placed = placed.drop("node").withColumn("component", F.coalesce("component", "doc_id"))
        member = F.struct(F.xxhash64("doc_id", F.lit(number)).alias("h"), F.col("doc_id").alias("d"))
        still = placed.groupBy("token").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min(member)["d"].alias("first"),
            F.max(member)["d"].alias("last"),
        )
        still = still.where("low <> high").drop("low", "high")
        open_ = staging.write(placed.join(still, "token"), "open")
        # the list that a row is in, on the average of rows
        length = open_.agg(F.avg("docs")).first()[0]
        if not length or length <= frequent:
            break
    open_, prefixes = _passages_behind(open_, prefixes, found, docs, common, width, percent, staging)
    pairs = _pairs(open_.join(prefixes.select("doc_id", *_bits()), "doc_id"), percent, frequent)
    pairs = staging.write(pairs.join(tried, ["a", "b"], "left_anti"), "met")
    pairs = staging.write(_narrowed(pairs, prefixes, percent, staging), "pairs")
    return graph.grown(found, _verified(pairs, docs, width, percent, staging), staging)


def _narrowed(pairs: DataFrame, sets: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """The pairs that sizes and bitmaps don't rule out, the wide ones only where they are needed."""

    def with_sides(pairs: DataFrame, columns: list[str]) -> DataFrame:
        for side in ("a", "b"):
            own = [F.col(c).alias(f"{side}_{c}") for c in columns]
            pairs = pairs.join(sets.select(F.col("doc_id").alias(side), *own), side)
        return pairs

    near = with_sides(pairs, ["n", *_bits()]).where(_may_be_similar("a_", "b_", percent))
    near = staging.write(near.select("a", "b"), "near")
    apart = F.aggregate(
        F.zip_with("a_wide", "b_wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    fits = apart.isNull() | _little(apart, F.col("a_n"), F.col("b_n"), percent)
    return with_sides(near, ["n", "wide"]).where(fits).select("a", "b")


def _pairs(open_: DataFrame, percent: int, frequent: int) -> DataFrame:
    """Pairs ``(a, b)`` across components that may be similar, from the lists of ``open_``.

    With sizes n <= m, similar sets share at least s = percent / (100 + percent) (n + m) tokens.
    So n lacks at most n - 2 percent / (100 + percent) n, and the first two tokens that they
    share are among as many first tokens of it and two more.
    """
    n = F.col("n")
    short = F.col("at") < n - F.ceil(2 * percent * n / (100 + percent)) + 2
    side = ["doc_id", "n", "component", *_bits()]
    single = open_.where(F.col("docs") <= frequent)
    single = single.select(F.col("token").alias("key"), short.alias("short"), *side, "at")
    one = F.struct("token", "at", short.alias("short"))
    doubled = (
        open_.where(F.col("docs") > frequent)
        .groupBy(*side)
        .agg(F.sort_array(F.collect_list(one)).alias("tokens"))
        .select(*side, F.posexplode("tokens").alias("place", "one"), "tokens")
        .select(*side, "one", F.explode(F.expr("slice(tokens, place + 2, size(tokens))")).alias("two"))
        .select(
            F.struct("one.token", F.col("two.token").alias("other")).alias("key"),
            F.expr("one.short AND two.short").alias("short"),
            *side,
            # the first two shared: the bound below then counts from the later one
            F.greatest("one.at", "two.at").alias("at"),
        )
    )
    return _met(single, percent).union(_met(doubled, percent)).distinct()


def _met(index: DataFrame, percent: int) -> DataFrame:
    """Pairs in a list, the smaller set by its short prefix, that may be similar."""
    rest = [c for c in index.columns if c not in ("key", "short")]
    a = index.where("short").select("key", *[F.col(c).alias(f"a_{c}") for c in rest])
    b = index.select("key", *[F.col(c).alias(f"b_{c}") for c in rest])
    most = 2 + F.least(F.expr("a_n - a_at - 1"), F.expr("b_n - b_at - 1"))
    return (
        a.join(b, "key")
        .where("a_component <> b_component")
        .where("a_n < b_n OR (a_n = b_n AND a_doc_id < b_doc_id)")
        .where(most * (100 + percent) >= percent * F.expr("a_n + b_n"))
        .where(_may_be_similar("a_", "b_", percent))
        .select(
            F.least("a_doc_id", "b_doc_id").alias("a"), F.greatest("a_doc_id", "b_doc_id").alias("b")
        )
    )
