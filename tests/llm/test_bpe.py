import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dimhistory.llm import bpe, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abc'd s12 \n\t\x1c\x85\xa0é'lİſΑあ你ß²½̀é🙂​,.!|<|endoftext|>"
FIXED = [
    "",
    "<|endoftext|>a<|endoftext|><|startoftext|> x",
    "  x  \n\n y ",
    "'s'LL don't DON'T we're",
    " " * 1000 + "a",
    "a" * 3000,
    "é" * 700 + "the" * 900,
    "ͅx ͅֈĀ 𞤀 𐓐 ΑΣ Σ",
    "<|END<|endoftext|>",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    made = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(1500)]
    return FIXED + made


def test_ids_and_decoded_texts_are_the_library_s(texts):
    library, ours = Tokenizer.from_file(BYTES), bpe.load(BYTES)
    for text, made in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = ours.encode(text)
        assert ids == ",".join(map(str, made.ids)), text
        assert ours.decode(ids) == library.decode(made.ids, skip_special_tokens=False)


def test_long_words_merge_as_short_ones():
    ours, rng = bpe.load(BYTES), random.Random(1)
    for _ in range(200):
        word = "".join(rng.choices("theraning", k=rng.randint(1, bpe.SHORT))).encode()
        assert bpe._split_long(word, ours.ranks, 1) == bpe.split_word(word, ours.ranks)


def test_counts_are_the_library_s(texts, frame):
    library = Tokenizer.from_file(WORDS)
    made = library.encode_batch(texts, add_special_tokens=False)
    got = {r["doc_id"]: r for r in tokens.count_tokens(frame(texts), WORDS).collect()}
    assert [got[i]["n_tokens"] for i in range(len(texts))] == [len(m.ids) for m in made]
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len(t.encode()) for t in texts]


def test_proven_words_are_one_token_and_no_provable_word_is_missing():
    library, proven = Tokenizer.from_file(WORDS), tokens.whole_tokens(WORDS)
    ends = [t.removesuffix("</w>") for t in library.get_vocab() if t.endswith("</w>")]
    plain = [t for t in ends if t.isascii() and t.isalpha()]
    made = library.encode_batch(plain, add_special_tokens=False)
    assert {t for t, m in zip(plain, made, strict=True) if m.tokens == [f"{t}</w>"]} == {
        t for t in plain if t in proven
    }


def test_odd_documents(odd, spark):
    counted = tokens.count_tokens(odd, WORDS, limit=10).collect()
    assert len(counted) == odd.count()
    by_id = {r["doc_id"]: r for r in counted}
    assert (by_id[0]["n_tokens"], by_id[0]["n_bytes"], by_id[0]["over_limit"]) == (0, 0, False)
    assert by_id[3]["over_limit"] and not by_id[4]["over_limit"]
    ids = bpe.encode(odd, BYTES)
    assert {r["doc_id"]: r["text"] for r in bpe.decode(ids, BYTES).collect()}[3].startswith("word and")
    digests = bpe.encode_digests(odd, BYTES)
    assert digests.count() == odd.count()
    assert digests.limit(0).count() == bpe.encode_digests(odd.limit(0), BYTES).count() == 0
