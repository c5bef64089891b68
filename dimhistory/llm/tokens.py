"""Token counts with a shortcut for words that are one token.

Before the job the driver proves which strings of the vocabulary come out of the whole encoding as
exactly themselves: split off as one word, and merged to one token. A word of a text that is
among them counts one at once; only the other words are merged.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame

from dimhistory.llm.bpe import (
    LETTERS,
    NUMBERS,
    SPACES,
    Remembered,
    byte_alphabet,
    rank_table,
    split_word,
    to_bytes,
)
from dimhistory.llm.frames import kept, map_texts

#: Ends a word in the merge table; no UTF-8 text holds this byte.
_END = b"\xff"


class WordBpe:
    """Counts tokens as the tokenizers library does with a word-end BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = json.load(open(path, encoding="utf-8"))
        model, suffix = whole["model"], whole["model"]["end_of_word_suffix"]
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.alphabet = byte_alphabet()

        def part(token: str) -> bytes:
            ends = token.endswith(suffix)
            return to_bytes(token.removesuffix(suffix), self.alphabet) + (_END if ends else b"")

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = rank_table({(part(a), part(b)): n for n, (a, b) in enumerate(merges)}, last=2)
        self.ends = [t.removesuffix(suffix) for t in model["vocab"] if t.endswith(suffix)]
        added = sorted((t["content"] for t in whole["added_tokens"]), key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
        )

    def merged(self, word: bytes) -> int:
        return len(split_word(word + _END, self.ranks, last=2))

    def split(self, text: str) -> list[bytes] | list[str]:
        """The words of a text without special tokens, as texts or, off Latin-1, as bytes."""
        try:
            text.encode("latin-1")
            return self.words.findall(text.lower())
        except UnicodeEncodeError:
            words = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))
            return [to_bytes(w, self.alphabet).decode() for w, _ in words]


@kept
def load(path: str) -> WordBpe:
    return WordBpe(path)


def whole_tokens(path: str) -> set[str]:
    """The words that encode alone as one token; at most as many as the vocabulary holds."""
    bpe, proven = load(path), set()
    for token in bpe.ends:
        try:
            word = to_bytes(token, bpe.alphabet).decode()
        except UnicodeDecodeError:
            continue
        if bpe.split(word) == [word] and bpe.merged(word.encode()) == 1:
            proven.add(word)
    return proven


def count_tokens(
    df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of each whole text.

    Special tokens written in a text count as one token each, as the library's default has
    it. A null text counts as empty (0, 0, false); repeated rows stay; an empty table gives no
    rows; other columns are not read. The proven words travel to the tasks as a broadcast
    bounded by the vocabulary.
    """
    kind = df.schema[id_col].dataType.simpleString()
    proven = df.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def make():
        bpe = load(path)
        known = Remembered(lambda w: bpe.merged(w.encode()), dict.fromkeys(proven.value, 1))

        def row(key, text):
            text = text or ""
            parts = bpe.specials.split(text) if bpe.specials else [text]
            n = len(parts) - 1 + sum(sum(map(known.__getitem__, bpe.split(p))) for p in parts)
            return key, len(text.encode()), n, n > limit

        return row

    schema = f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_texts(df, [id_col, text_col], schema, make)
