"""Byte-pair encoding and decoding with a contiguous array of ranks.

The words of a text are short, so a word holds its part boundaries in one list and the rank
of each pair of neighbours in another. The lowest rank is found by scanning; its boundary is
deleted and the two ranks beside it are refreshed. Words of over ``SHORT`` bytes (a text without
white space) would make the scans quadratic; those take the same merges from a heap.

The vocabulary file is a parameter; results are those of the tokenizers library for it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame

from dimhistory.llm.frames import kept, map_texts

SHORT = 256
#: Words remembered by a task with what they encode to, and the longest of these.
REMEMBERED = 300_000
REMEMBERED_CHARS = 48
_NONE = 1 << 60

Ranks = dict[tuple[bytes, bytes] | bytes, int]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, to that byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def to_bytes(token: str, alphabet: dict[str, int]) -> bytes:
    return bytes(alphabet[c] for c in token)


def rank_table(pairs: dict[tuple[bytes, bytes], int], last: int = 1) -> Ranks:
    """Ranks by pair, and of the pairs that a word starts with by their bytes as well."""
    starts = {a + b: rank for (a, b), rank in pairs.items() if len(a) == 1 and len(b) in (1, last)}
    return pairs | starts


def split_word(word: bytes, ranks: Ranks, last: int = 1) -> list[bytes]:
    """The parts of ``word`` once no neighbours can merge; ``last`` bytes end it as one part."""
    size = len(word)
    if size <= last:
        return [word] if word else []
    if size > SHORT:
        return _split_long(word, ranks, last)
    get = ranks.get
    cut = [*range(size - last + 1), size]
    rank = [get(word[i : i + 2], _NONE) for i in range(size - last)]
    if last > 1 and rank:
        rank[-1] = get(word[-last - 1 :], _NONE)
    while rank:
        low = min(rank)
        if low == _NONE:
            break
        at = rank.index(low)
        del cut[at + 1]
        del rank[at]
        if at < len(rank):
            rank[at] = get((word[cut[at] : cut[at + 1]], word[cut[at + 1] : cut[at + 2]]), _NONE)
        if at:
            rank[at - 1] = get((word[cut[at - 1] : cut[at]], word[cut[at] : cut[at + 1]]), _NONE)
    return [word[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _split_long(word: bytes, ranks: Ranks, last: int) -> list[bytes]:
    starts = range(len(word) - last + 1)
    end = {s: s + 1 for s in starts}
    end[starts[-1]] = len(word)
    before = {s: s - 1 for s in starts}
    heap = []

    def push(left: int) -> None:
        middle = end.get(left)
        if left >= 0 and middle is not None and middle < len(word):
            rank = ranks.get((word[left:middle], word[middle : end[middle]]))
            if rank is not None:
                heapq.heappush(heap, (rank, left, middle, end[middle]))

    for s in starts:
        push(s)
    while heap:
        _, left, middle, right = heapq.heappop(heap)
        if end.get(left) != middle or end.get(middle) != right:
            continue  # one of the two has merged since
        end[left] = right
        del end[middle]
        if right in before:
            before[right] = left
        push(before[left])
        push(left)
    return [word[s:e] for s, e in sorted(end.items())]


#: Letters, numbers and white space among the first 256 code points, for character classes.
LATIN = "".join(map(chr, range(256)))
LETTERS = re.escape("".join(c for c in LATIN if unicodedata.category(c)[0] == "L"))
NUMBERS = re.escape("".join(c for c in LATIN if unicodedata.category(c)[0] == "N"))
SPACES = r"\t-\r \x85\xa0"


class Remembered(dict):
    """What words map to, worked out when first asked for.

    When half full, the words become the old half, from which those that are asked for again
    come back; the old half before them is forgotten.
    """

    def __init__(self, work: Callable, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.work = work
        self.fixed = fixed or {}
        self.old: dict = {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.work(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED // 2 + len(self.fixed):
                self.old = dict(self)
                self.clear()
                self.update(self.fixed)
            self[word] = value
        return value


class ByteBpe:
    """Encodes and decodes as the tokenizers library does with a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        model = json.load(open(path, encoding="utf-8"))
        alphabet = byte_alphabet()
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.alphabet = alphabet
        self.ids = {to_bytes(t, alphabet): i for t, i in model["model"]["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.ranks = rank_table(
            {(to_bytes(a, alphabet), to_bytes(b, alphabet)): n for n, (a, b) in enumerate(merges)}
        )
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.added = added
        self.specials = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.tokens = {str(i): t for t, i in self.ids.items()}
        self.tokens |= {str(i): t.encode() for t, i in added.items()}
        self.words = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+"
            f"| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        )
        self.known = Remembered(self._word)

    def _word(self, word: str) -> str:
        return ",".join(str(self.ids[p]) for p in split_word(word.encode(), self.ranks))

    def _plain(self, text: str) -> str:
        """Ids of a text without special tokens, as decimal numbers joined by commas."""
        try:
            text.encode("latin-1")
            words = self.words.findall(text)
        except UnicodeEncodeError:  # the library knows the classes of its own Unicode version
            words = [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]
        return ",".join(map(self.known.__getitem__, words))

    def encode(self, text: str) -> str:
        if not self.specials or not self.specials.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [self._plain(text[at : found.start()]), str(self.added[found[0]])]
            at = found.end()
        return ",".join(p for p in [*out, self._plain(text[at:])] if p)

    def decode(self, ids: str) -> str:
        if not ids:
            return ""
        return b"".join(map(self.tokens.__getitem__, ids.split(","))).decode("utf-8", "replace")


@kept
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the ids of each whole text as decimal numbers joined by commas.

    A null text counts as empty and has no ids; repeated rows stay; an empty table gives no
    rows; other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        bpe = load(path)
        return lambda key, text: (key, bpe.encode(text or ""))

    return map_texts(df, [id_col, text_col], f"{id_col} {kind}, ids string", make)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``: the text of each list of ids; null and empty lists give an empty text."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        bpe = load(path)
        return lambda key, ids: (key, bpe.decode(ids or ""))

    return map_texts(df, [id_col, ids_col], f"{id_col} {kind}, text string", make)


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count and SHA-256 of the ids and of the text decoded from them, for each row.

    A null text counts as empty: no ids, and the digests of empty texts. Repeated rows stay, ids
    of rows may be null or of any type; an empty table gives no rows; other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def make():
        bpe = load(path)

        def row(key, text):
            ids = bpe.encode(text or "")
            return key, ids.count(",") + 1 if ids else 0, digest(ids), digest(bpe.decode(ids))

        return row

    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(df, [id_col, text_col], schema, make)
