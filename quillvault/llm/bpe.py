"""Byte-pair encoding and decoding with a contiguous rank array per word.

A word is held as its part boundaries and the rank of every adjacent pair of parts. The smallest
rank is found by a scan, its inner boundary is deleted and the two neighbouring ranks are looked up
again. Words are short, so the scans are cheaper than a heap; a run of letters beyond
``SCANNED`` parts goes through a heap with the same order (rank, then position) and result.

Spark splits the texts; every Python worker keeps the encodings of recent words in a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from quillvault.llm.byte_level import SPACE, alphabet, visible, vocabulary
from quillvault.llm.tables import map_rows

SCANNED = 192
NO_RANK = 1 << 60
#: Words kept by a Python worker, about half a kilobyte each. More of them save time where the
#: workers have no other tables to hold.
WORDS = 100_000
KEPT_CHARS = 64
END = "</w>"

#: Fixed value: how the vocabulary cuts normalised text into words.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+", regex.V0
)


def merged_bounds(word: str, parts: list[str], ranks: dict[tuple[str, str], int]) -> list[int]:
    """Part boundaries of ``word`` after all merges.

    ``parts`` are its smallest parts: single characters, but that the last may be longer.
    """
    bounds = [*range(len(parts)), len(word)]
    if len(parts) > SCANNED:
        return _merged_long(word, bounds, ranks)
    rank_of = ranks.get
    adjacent = [rank_of(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
    while adjacent:
        least = min(adjacent)
        if least == NO_RANK:
            break
        i = adjacent.index(least)
        del bounds[i + 1], adjacent[i]
        start, end = bounds[i], bounds[i + 1]
        part = word[start:end]
        if i < len(adjacent):
            adjacent[i] = rank_of((part, word[end : bounds[i + 2]]), NO_RANK)
        if i:
            adjacent[i - 1] = rank_of((word[bounds[i - 1] : start], part), NO_RANK)
    return bounds


def _merged_long(word: str, bounds: list[int], ranks: dict[tuple[str, str], int]) -> list[int]:
    end = dict(zip(bounds, bounds[1:], strict=False))
    before = dict(zip(bounds[1:], bounds, strict=False))
    last = bounds[-1]

    def pair(a: int) -> tuple[int, int, int, int] | None:
        b = end[a]
        if b == last:
            return None
        rank = ranks.get((word[a:b], word[b : end[b]]))
        return None if rank is None else (rank, a, b, end[b])

    heap = [p for a in bounds[:-1] if (p := pair(a))]
    heapq.heapify(heap)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end.get(a) != b or end.get(b) != c:
            continue
        end[a] = c
        del end[b], before[b]
        before[c] = a
        for start in ([before[a]] if a in before else []) + [a]:
            if p := pair(start):
                heapq.heappush(heap, p)
    out = [bounds[0]]
    while out[-1] != last:
        out.append(end[out[-1]])
    return out


class Recent:
    """A bounded table of recent entries. A full half becomes the old half, from which what is asked
    for again comes back, so frequent words stay."""

    def __init__(self, most: int):
        self.half = most // 2
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def get(self, key: str) -> tuple[int, ...] | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: tuple[int, ...]) -> None:
        if len(key) > KEPT_CHARS:  # too long to be met often
            return
        if len(self.new) >= self.half:
            self.old = self.new.copy()
            self.new.clear()
        self.new[key] = value


class WordCodec:
    """Encodes and decodes whole texts as the vocabulary file at ``path`` does."""

    def __init__(self, path: str, words: int = WORDS):
        self.ids, merges, added = vocabulary(path)
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.added = dict(added)
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in added}
        self.shown_id = {i: str(i) for i in self.tokens}
        self.special = regex.compile("|".join(regex.escape(t) for t, _ in added))
        self.words = Recent(words)

    def tokens_of(self, word: str) -> list[str]:
        shown = word if word.isascii() and word.isalpha() else visible(word)
        parts = list(shown)
        parts[-1] += END
        text = shown + END
        bounds = merged_bounds(text, parts, self.ranks)
        return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word of normalised text."""
        found = self.words.get(word)
        if found is None:
            ids = self.ids
            found = tuple([ids[t] for t in self.tokens_of(word)])
            self.words.put(word, found)
        return found

    def plain(self, text: str) -> list[tuple[int, ...]]:
        """The words of a text without special tokens."""
        # Lower case is taken character by character, so a final sigma is no special case.
        lower = text if text.isascii() else unicodedata.normalize("NFC", text)
        lower = lower.replace("Σ", "σ").lower()
        table, word = self.words.new.get, self.word
        return [table(w) or word(w) for w in WORD.findall(lower)]

    def encode(self, text: str) -> list[int]:
        if "<|" not in text or not self.special.search(text):
            found = self.plain(text)
        else:
            found, at = [], 0
            for m in self.special.finditer(text):
                found += self.plain(text[at : m.start()])
                found.append((self.added[m[0]],))
                at = m.end()
            found += self.plain(text[at:])
        return list(chain.from_iterable(found))

    def shown(self, ids: Iterable[int]) -> str:
        """Ids joined by a blank."""
        return " ".join(map(self.shown_id.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a blank: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def text_of(self, ids: Iterable[int]) -> str:
        """Readable text: bytes restored, word ends as blanks."""
        byte_of = {sign: b for b, sign in enumerate(alphabet())}
        words = "".join([self.tokens[i] for i in ids if i not in self.added.values()]).split(END)
        return " ".join(
            bytes(byte_of[c] for c in w).decode("utf-8", "replace") for w in words
        ).rstrip()


@lru_cache(maxsize=2)
def codec(path: str, words: int = WORDS) -> WordCodec:
    return WordCodec(path, words)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_documents(documents: DataFrame, path: str, words: int = WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row; ``path`` must exist on every executor.

    A null text counts as empty: no tokens, empty ids and text. Repeated rows stay repeated, a null
    doc_id stays null; other columns are not read.
    """
    return _encoded(documents, path, words, lambda *texts: texts, "ids string, decoded string")


def encoding_digests(documents: DataFrame, path: str, words: int = WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``; rows as in ``encode_documents``."""
    return _encoded(
        documents,
        path,
        words,
        lambda ids, decoded: (_digest(ids), _digest(decoded)),
        "ids_sha256 string, decoded_sha256 string",
    )


def _encoded(
    documents: DataFrame, path: str, words: int, shape: Callable, columns: str
) -> DataFrame:
    def make():
        known = codec(path, words)

        def one(doc_id, text):
            ids = known.encode(text or "")
            return [(doc_id, len(ids), *shape(known.shown(ids), known.decode(ids)))]

        return one

    return map_rows(
        documents.select("doc_id", "text"),
        make,
        f"doc_id bigint, n_tokens bigint, {columns}",
        rows=500,
    )
