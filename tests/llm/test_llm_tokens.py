"""Both byte-pair operators against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillvault.llm.bpe import WordCodec, encode_documents, encoding_digests
from quillvault.llm.token_counts import PrefixCounter, count_tokens

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")

SIGNS = list("abXYZ 's'll\t\n\r  \x1c\x1f\x85\xa0 éΣσςİıẞ中文한🙂²½٣_-.,!?'\"<|>\x00ﬁ") + [
    "<|endoftext|>", "<|startoftext|>", "<|end", "'LL", "​", "Å", "ẛ̣", "the ", "ing",
]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    made = ["".join(rnd.choices(SIGNS, k=rnd.randint(0, 50))) for _ in range(1500)]
    return [*made, "", "a" * 3000, "ab" * 2000, "!" * 700, " " * 500, "é" * 600]


def test_words_as_the_library(texts):
    library, own = Tokenizer.from_file(WORD), WordCodec(WORD)
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert ids == want and own.shown(ids) == " ".join(map(str, want))
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_readable_text_comes_back():
    own = WordCodec(WORD)
    ids = own.encode("Über  die Straße, 42!")
    assert own.text_of(ids) == "über die straße , 4 2 !"


def test_counts_as_the_library(texts):
    library, own = Tokenizer.from_file(BYTE), PrefixCounter(BYTE)
    for text in texts:
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_and_budget(texts):
    library, own = Tokenizer.from_file(BYTE), PrefixCounter(BYTE)
    for text in texts[:300]:
        counts = [
            len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)
        ]
        assert [own.count_at(text, k) for k in range(len(text) + 1)] == counts
        for budget in {0, 1, counts[-1] // 2, counts[-1]}:
            assert own.fit(text, budget) == max(k for k, n in enumerate(counts) if n <= budget)


def test_table_ends_with_the_total():
    own = PrefixCounter(BYTE)
    text = "One two <|endoftext|> three"
    assert own.table(text)[-1] == (len(text), own.count(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows(documents, rows_of):
    df = documents([(1, "Hello there"), (1, "Hello there"), (2, None), (3, ""), (None, "x" * 40000)])
    got = rows_of(encoding_digests(df, WORD))
    assert got.count(got[0]) == 2 and len(got) == 5
    assert (2, 0, sha(""), sha("")) in got and (3, 0, sha(""), sha("")) in got
    assert [r for r in got if r[0] is None]
    counted = rows_of(count_tokens(df, BYTE, limit=1))
    assert (2, 0, 0, False, 0) in counted
    assert (1, 11, 2, True, 5) in counted
    assert next(r for r in counted if r[0] is None)[1] == 40000
    assert rows_of(encode_documents(documents([(5, "A b")]), WORD))[0][3] == "a</w> b</w>"


def test_empty_tables(documents):
    assert count_tokens(documents([]), BYTE).count() == 0
    assert encoding_digests(documents([]), WORD).count() == 0


def test_the_text_is_decoded_from_the_ids():
    """A wrong token for an id shows in the text, not in the ids."""
    right, wrong = WordCodec(WORD), WordCodec(WORD)
    ids = right.encode("the cat sat")
    wrong.tokens = right.tokens | {ids[1]: "dog</w>"}
    assert wrong.encode("the cat sat") == ids
    assert wrong.decode(ids) == right.decode(ids).replace("cat", "dog")
