"""Benchmark phrases in training texts, from a positional inverted index.

The index holds, for each bounded run of documents (a segment), the positions of every word that
a benchmark uses, as one list per word; it is written to the shared folder and read
from there. A phrase is looked up from its rarest word in the segment: that list, moved by the
word's offset, is intersected with the lists of the next rarest words until it is empty or all
words agree. Words near each other are found from the same lists. Segments are independent, so
nothing is shuffled to search.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.frames import arrow_schema

#: A segment ends with the document that brings it to so many words.
SEGMENT_WORDS = 500_000
#: Benchmark words in one block of the search. Blocks are searched one after the other, so
#: what is broadcast at once keeps this size whatever the benchmark's.
BLOCK_WORDS = 2_000_000

#: Rows of a batch that a segment returns.
ROWS = 10_000

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(
    b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(_TABLE).split()


def windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    """Each run of ``width`` words once; all words as one if they are fewer; none without."""
    if not words:
        return []
    last = max(1, len(words) - width + 1)
    return list(dict.fromkeys(tuple(words[i : i + width]) for i in range(last)))


# -- the index ---------------------------------------------------------------------------

INDEX = (
    "segment string, doc_ids array<{id}>, starts array<int>, sizes array<int>, "
    "terms array<binary>, ends array<int>, steps binary"
)


def build_index(docs: DataFrame, terms: set[bytes] | None = None) -> DataFrame:
    """Segments of ``docs`` (doc_id, text) with the positions of ``terms``, or of every word.

    Documents of a segment follow each other with a gap of one position, so no phrase crosses
    from one to the next. Ids may have any type. ``steps`` holds the distances between positions, term after term. A
    document without words, null texts included, has size 0; no document is split.
    """
    ddl = INDEX.format(id=docs.schema["doc_id"].dataType.simpleString())
    schema = arrow_schema(ddl)
    fixed = None
    if terms is not None:
        fixed = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(sorted(terms))})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        part = _Building(fixed and fixed.value)
        n = 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                part.add(key.as_py(), words_of(text.as_py()))
                if part.total >= SEGMENT_WORDS:
                    yield part.record(f"{task}-{n}", schema)
                    part, n = _Building(fixed and fixed.value), n + 1
        if part.ids:
            yield part.record(f"{task}-{n}", schema)

    return docs.select("doc_id", "text").mapInArrow(run, ddl)


class _Building:
    """A segment while documents are added to it."""

    def __init__(self, numbers: dict[bytes, int] | None):
        self.all = numbers is None
        self.numbers = {} if numbers is None else numbers
        self.ids: list = []
        self.sizes: list[int] = []
        self.found: list[np.ndarray] = []
        self.total = 0

    def add(self, key: object, words: list[bytes]) -> None:
        numbers, size = self.numbers, len(words)
        if self.all:
            for word in words:
                numbers.setdefault(word, len(numbers))
        row = np.full(size + 1, -1, np.int32)  # one position beyond the last word
        row[:size] = np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, size)
        self.ids.append(key)
        self.sizes.append(size)
        self.found.append(row)
        self.total += size + 1

    def record(self, name: str, schema: pa.Schema) -> pa.RecordBatch:
        size = np.array(self.sizes, np.int64)
        starts = np.cumsum(size + 1) - size - 1
        numbered = np.concatenate(self.found)
        at = np.flatnonzero(numbered >= 0)
        at = at[np.argsort(numbered[at], kind="stable")]
        term, first = np.unique(numbered[at], return_index=True)
        steps = np.diff(at, prepend=0)
        steps[first] = at[first]
        words = list(self.numbers)
        row = [
            name,
            self.ids,
            starts.tolist(),
            self.sizes,
            [words[t] for t in term.tolist()],
            [*first[1:].tolist(), len(at)] if len(term) else [],
            steps.astype(np.int32).tobytes(),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema
        )


class Segment:
    """One row of the index, for looking up phrases."""

    def __init__(self, row: dict):
        self.name = row["segment"]
        self.starts = np.array(row["starts"], np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        steps = np.frombuffer(row["steps"], np.int32).astype(np.int64)
        ends = row["ends"]
        self.lists = {
            term: np.cumsum(steps[a:b])
            for term, a, b in zip(row["terms"], [0, *ends], ends, strict=False)
        }

    def phrase(self, terms: tuple[bytes, ...]) -> np.ndarray:
        """The positions at which ``terms`` stand one after the other."""
        lists = []
        for offset, term in enumerate(terms):
            positions = self.lists.get(term)
            if positions is None:
                return _NOTHING
            lists.append((len(positions), offset, positions))
        lists.sort(key=lambda x: x[:2])
        starts = lists[0][2] - lists[0][1]
        for _, offset, positions in lists[1:]:
            at = np.searchsorted(positions, starts + offset)
            at[at == len(positions)] = 0
            starts = starts[positions[at] == starts + offset]
            if not len(starts):
                break
        return starts

    def slots(self, positions: np.ndarray) -> np.ndarray:
        """The documents that positions lie in, by their number in the segment."""
        return np.searchsorted(self.starts, positions, "right") - 1

    def near(self, terms: Iterable[bytes], distance: int) -> np.ndarray:
        """Positions of a term with all others at the same place or up to ``distance`` words on.

        Terms are told apart but not ordered, and none counts twice. The rarest term's list says
        where to look; the others narrow what it found, the rarest first.
        """
        lists = [self.lists.get(term) for term in set(terms)]
        if not lists or any(positions is None for positions in lists):
            return _NOTHING
        lists.sort(key=len)
        rare = lists[0]
        found = [rare]
        for positions in lists[1:]:
            low, high = np.searchsorted(positions, rare - distance), np.searchsorted(positions, rare, "right")
            sizes = high - low
            first = np.repeat(low - np.cumsum(sizes) + sizes, sizes)
            found.append(positions[first + np.arange(sizes.sum())])
        start = np.unique(np.concatenate(found))
        slot = self.slots(start)
        last = np.minimum(start + distance, self.starts[slot] + self.sizes[slot] - 1)
        for positions in lists:
            some = np.searchsorted(positions, last, "right") > np.searchsorted(positions, start)
            start, last = start[some], last[some]
        return start


_NOTHING = np.empty(0, np.int64)


# -- the search --------------------------------------------------------------------------

MATCHES = "segment string, slot int, item_id string, froms array<int>, tos array<int>"
NEAR = "segment string, slot int, item_id string, position int"

#: From a term to the windows that are looked up where it stands, each with its items.
Lookup = dict[bytes, list[tuple[tuple[bytes, ...], list[str]]]]


def by_rarest_term(block: list[tuple[str, str]], width: int) -> Lookup:
    """The windows of a block of items under the term of each that fewest other windows have.

    A segment only looks at windows whose term it holds.
    """
    items: dict[tuple[bytes, ...], dict[str, None]] = {}
    for item, text in block:
        for window in windows(words_of(text), width):
            items.setdefault(window, {})[item] = None
    common = Counter(term for window in items for term in set(window))
    found: Lookup = {}
    for window, names in items.items():
        rarest = min(window, key=lambda term: (common[term], term))
        found.setdefault(rarest, []).append((window, list(names)))
    return found


def _looked_up(
    index: DataFrame, block: list[tuple[str, str]], width: int, ddl: str, find: Callable[..., Iterator[tuple]]
) -> DataFrame:
    """Rows of ``find(segment, windows with items)`` for each segment of the index."""
    schema = arrow_schema(ddl)
    lookup = index.sparkSession.sparkContext.broadcast(by_rarest_term(block, width))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = Segment(batch.slice(i, 1).to_pylist()[0])
                some = (w for term in part.lists for w in lookup.value.get(term, ()))
                rows = find(part, some)
                while out := list(islice(rows, ROWS)):
                    columns = zip(*out, strict=True)
                    made = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(made, schema=schema)

    return index.mapInArrow(run, ddl)


def _spans(part: Segment, some: Iterable[tuple[tuple[bytes, ...], list[str]]]) -> Iterator[tuple]:
    """``MATCHES``: words of a document, as spans, that windows of an item cover."""
    spans: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for window, names in some:
        starts = part.phrase(window)
        for start, slot in zip(starts.tolist(), part.slots(starts).tolist(), strict=True):
            for item in names:
                spans.setdefault((item, slot), []).append((start, start + len(window)))
    for (item, slot), pairs in spans.items():
        base = int(part.starts[slot])
        froms, tos = zip(*merged(sorted(pairs)), strict=True)
        yield part.name, slot, item, [a - base for a in froms], [b - base for b in tos]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps, of the same positions."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _against_all(
    docs: DataFrame, benchmark: DataFrame, width: int, ddl: str, find: Callable[..., Iterator[tuple]]
) -> tuple[DataFrame, DataFrame]:
    """``(rows, found)``: documents by segment and slot, and what the blocks of items find there.

    The benchmark is a stated query set; it is taken in blocks, each against all documents, so
    its size is no limit. With one block only its words are indexed, else every word.
    """
    staging = Staging(docs.sparkSession)
    blocks = _blocks(benchmark)
    block, more = next(blocks, []), next(blocks, None)
    terms = None if more else {w for _, text in block for w in words_of(text)}
    index = staging.write(build_index(docs, terms), "index")
    found = staging.write(_looked_up(index, block, width, ddl, find), "matches")
    while more:
        found = found.union(staging.write(_looked_up(index, more, width, ddl, find), "matches"))
        more = next(blocks, None)
    slots = F.explode(F.arrays_zip("doc_ids", "sizes", F.sequence(F.lit(0), F.size("sizes") - 1)))
    rows = index.select("segment", slots.alias("d")).select(
        "segment",
        F.col("d.2").cast("int").alias("slot"),
        F.col("d.doc_ids").alias("doc_id"),
        F.col("d.sizes").cast("long").alias("n_words"),
    )
    return rows, found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``BLOCK_WORDS`` words (or one longer item)."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    block, total = [], 0
    for item, text in rows.toLocalIterator():
        n = len(words_of(text))
        if block and total + n > BLOCK_WORDS:
            yield block
            block, total = [], 0
        block.append((item, text))
        total += n
    if block:
        yield block


def find_matches(
    docs: DataFrame, benchmark: DataFrame, width: int = 13
) -> tuple[DataFrame, DataFrame]:
    """``(rows, matches)``: the documents by segment and slot, and the spans in them.

    An item's text is looked up by its windows of ``width`` words; an item of fewer words, but
    not none, is one window. Items without id or text find nothing; items that share an id count
    as one.
    """
    return _against_all(docs, benchmark, width, MATCHES, _spans)


def find_near(docs: DataFrame, benchmark: DataFrame, distance: int, width: int = 13) -> DataFrame:
    """``(doc_id, item_id, position)``: where all words of an item's window stand near each other.

    Windows are those of :func:`find_matches`, without regard to the order of their words, and a
    word that a window repeats counts once. ``position`` counts a document's words from 0: one of
    the window's words stands there, and all others stand there or at most ``distance`` words
    on. A position that several windows of an item give comes once. A null or empty text has no
    words, an item without id or text finds nothing, repeated rows of documents each give their
    matches, an empty table gives none; other columns are not read. Ids may have any type.
    """

    def find(part: Segment, some: Iterable[tuple[tuple[bytes, ...], list[str]]]) -> Iterator[tuple]:
        found: dict[str, list[np.ndarray]] = {}
        for window, names in some:
            positions = part.near(window, distance)
            for item in names if len(positions) else ():
                found.setdefault(item, []).append(positions)
        for item, lists in found.items():
            positions = np.unique(np.concatenate(lists))
            slots = part.slots(positions)
            for slot, place in zip(slots.tolist(), (positions - part.starts[slots]).tolist(), strict=True):
                yield part.name, slot, item, place

    rows, found = _against_all(docs, benchmark, width, NEAR, find)
    # items of several blocks may share an id
    found = found.distinct()
    return found.join(rows, ["segment", "slot"]).select("doc_id", "item_id", "position")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of each row of ``docs``.

    A word inside any occurrence of an item's window is hit. Contaminated: words are hit, and
    20 * n_hit >= n_words. A null or empty text has no words; repeated rows stay; an empty
    table gives no rows, an empty benchmark no hits; other columns are not read.
    """
    rows, matches = find_matches(docs, benchmark, width)
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("froms", "tos"))))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["tos"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["tos"] - F.greatest(acc["end"], s["froms"])))
            .cast("long")
            .alias("n"),
        ),
        lambda acc: acc["n"],
    )
    hit = matches.groupBy("segment", "slot").agg(
        covered.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",")
    return rows.join(hit, ["segment", "slot"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
