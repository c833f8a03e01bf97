"""Benchmark passages in documents: item-sized windows, SimHash, multi-index Hamming, exact check.

For each item length, every window of that many words that holds at least one of the items' shingles
(others share nothing with any item) gets a SimHash. The index cuts fingerprints into four blocks; a
fingerprint within ``RADIUS`` bits agrees with the item's in some block up to ``RADIUS // 4`` bits, so
trying all such flips in every block finds them all. What is found is compared exactly: the
weighted Jaccard similarity of the two multisets of shingles, weights being occurrences. For items
with more words than the document, the whole document is the one window.

The benchmark is the stated query set. It goes to the tasks in blocks of bounded size, one pass over
the documents each.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault.llm.tables import keep_rows, map_rows, staged

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
PARTS = 4
#: Text of the items that one pass takes along.
PASS_BYTES = 8 << 20
#: Windows whose bit counts are held at once.
WINDOWS = 1 << 15
#: Hashes of words kept per task; a full table is emptied.
WORDS = 200_000

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PUNCTUATION, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(PUNCTUATION)
)
FACTORS = np.array(
    [xxhash.xxh64_intdigest(str(i), 7) | 1 for i in range(SHINGLE)], np.uint64
)


def words_of(text: str) -> list[bytes]:
    """Words without ASCII punctuation, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, 42)
        if len(word) <= 64:
            if len(self) >= WORDS:
                self.clear()
            self[word] = found
        return found


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """One hash per shingle from the hashes of its words; a short text is one shingle."""
    n = hashes.size
    if not n:
        return hashes
    size = min(SHINGLE, n)
    out = np.full(n - size + 1, np.uint64(size))
    for i in range(size):
        out += hashes[i : n - size + 1 + i] * FACTORS[i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def shingles(words: list[bytes]) -> Counter:
    size = min(SHINGLE, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Sum of least weights over sum of greatest weights; 0 if both are empty."""
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` consecutive shingle hashes, from running bit counts."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros((hashes.size + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=counts[1:])
    over = (counts[size:] - counts[:-size]) * 2 > size
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


class HammingIndex:
    """Fingerprints by each of four 16-bit blocks."""

    flips = np.array(
        [
            sum(1 << i for i in chosen)
            for n in range(RADIUS // PARTS + 1)
            for chosen in combinations(range(16), n)
        ],
        np.uint16,
    )

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.parts = prints.astype("<u8").view("<u2").reshape(-1, PARTS)
        self.order = [np.argsort(self.parts[:, p], kind="stable") for p in range(PARTS)]
        self.used = np.zeros((PARTS, 1 << 16), bool)
        for p in range(PARTS):
            self.used[p, self.parts[:, p]] = True

    def within(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position in ``prints``, entry) of all pairs at most ``RADIUS`` bits apart."""
        unique, back = np.unique(prints, return_inverse=True)
        near: dict[int, set[int]] = {}
        for at in range(0, unique.size, 256):
            some = unique[at : at + 256].astype("<u8").view("<u2").reshape(-1, PARTS)
            for p in range(PARTS):
                tried = some[:, p, None] ^ self.flips
                hit = self.used[p][tried]
                if not hit.any():
                    continue
                keys, order = self.parts[:, p][self.order[p]], self.order[p]
                for row, column in zip(*np.nonzero(hit), strict=True):
                    value = tried[row, column]
                    a, b = np.searchsorted(keys, value), np.searchsorted(keys, value, "right")
                    near.setdefault(at + int(row), set()).update(order[a:b].tolist())
        places: dict[int, list[int]] = {}
        for i, u in enumerate(back.tolist()):
            if u in near:
                places.setdefault(u, []).append(i)
        for u, entries in near.items():
            chosen = np.array(sorted(entries))
            close = chosen[np.bitwise_count(self.prints[chosen] ^ unique[u]) <= RADIUS]
            for i in places[u]:
                for e in close.tolist():
                    yield i, e


class Benchmark:
    """The items of one pass: shingles to items, and an index of fingerprints per item length."""

    def __init__(self, items: list[tuple[int, str]]):
        self.hash = WordHashes()
        lengths: dict[int, list[tuple[int, Counter, int]]] = {}
        anchors: dict[int, set[int]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            hashes = shingle_hashes(self.hashes(words))
            entry = (item_id, shingles(words), int(window_prints(hashes, hashes.size)[0]))
            lengths.setdefault(len(words), []).append(entry)
            for h in hashes.tolist():
                anchors.setdefault(h, set()).add(len(words))
        self.anchors = np.array(sorted(anchors), np.uint64)
        self.lengths_of = [anchors[h] for h in self.anchors.tolist()]
        self.short = sorted(n for n in lengths if n < SHINGLE)
        self.items = {
            n: (HammingIndex(np.array([e[2] for e in found], np.uint64)), found)
            for n, found in lengths.items()
        }

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hash.__getitem__, words), np.uint64, len(words))

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(item_id, first word, similarity) of the best window of every item found."""
        words = words_of(text)
        if not words or not self.anchors.size:
            return []
        hashes = self.hashes(words)
        found: dict[int, tuple[float, int]] = {}
        sh = shingle_hashes(hashes)
        place = np.minimum(np.searchsorted(self.anchors, sh), self.anchors.size - 1)
        anchored = np.flatnonzero(self.anchors[place] == sh)
        zones: dict[int, list[int]] = {}
        longer: set[int] = set()
        for position in anchored.tolist():
            for n in self.lengths_of[place[position]]:
                if SHINGLE <= n <= len(words):
                    zones.setdefault(n, []).append(position)
                elif n > len(words):
                    longer.add(n)
        for n, positions in zones.items():
            size = n - SHINGLE + 1
            last = len(words) - n
            for start, stop in runs(positions, size, last):
                for a in range(start, stop + 1, WINDOWS):
                    b = min(stop, a + WINDOWS - 1)
                    self._compare(words, n, a, sh[a : b + size], size, found)
        for n in sorted(longer):
            # No similarity is above the share of the sizes.
            if sh.size / (n - SHINGLE + 1) >= SIMILARITY:
                self._compare(words, n, 0, sh, sh.size, found)
        for n in self.short:  # windows shorter than a shingle are one shingle each
            if n <= len(words):
                index, entries = self.items[n]
                grams = hashes_of_length(hashes, n)
                self._check(words, n, 0, grams, index, entries, found)
        return [(item, start, share) for item, (share, start) in sorted(found.items())]

    def _compare(self, words, n, first, hashes, size, found):
        index, entries = self.items[n]
        self._check(words, n, first, window_prints(hashes, size), index, entries, found)

    def _check(self, words, n, first, prints, index, entries, found):
        for i, e in index.within(prints):
            item_id, wanted, _ = entries[e]
            share = similarity(shingles(words[first + i : first + i + n]), wanted)
            best, at = found.get(item_id, (0.0, 0))
            if share >= SIMILARITY and (share, at) > (best, first + i):
                found[item_id] = (share, first + i)


def hashes_of_length(hashes: np.ndarray, n: int) -> np.ndarray:
    """The one-shingle hash of every run of ``n`` words."""
    out = np.full(hashes.size - n + 1, np.uint64(n))
    for i in range(n):
        out += hashes[i : hashes.size - n + 1 + i] * FACTORS[i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def runs(positions: list[int], size: int, last: int) -> Iterator[tuple[int, int]]:
    """Ranges of window starts whose windows of ``size`` shingles hold one of ``positions``."""
    start = end = None
    for p in positions:
        a, b = max(0, p - size + 1), min(p, last)
        if a > b:
            continue
        if end is not None and a <= end + 1:
            end = max(end, b)
        else:
            if end is not None:
                yield start, end
            start, end = a, b
    if end is not None:
        yield start, end


def item_blocks(benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``pass_bytes``; equal rows once, rows without id or text left out."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // pass_bytes)
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [tuple(r) for r in block.distinct().collect()]


def contaminated(documents: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``doc_id, item_id, word, similarity``: every item found in every row of ``documents``.

    ``word`` is the number of the first word of the most similar window, the first such window on
    ties. Null and empty texts hold nothing; an empty benchmark finds nothing; repeated rows give
    repeated results, a null doc_id stays null. Repeated items with one id count as one by their
    best window. Other columns are not read.
    """
    schema = "doc_id bigint, digest string, item_id bigint, word bigint, similarity double"
    parts = []
    for items in item_blocks(benchmark, pass_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            index = Benchmark(shared.value)

            def found(doc_id, text):
                matches = index.matches(text or "")
                digest = hashlib.sha256((text or "").encode()).hexdigest() if matches else None
                return [(doc_id, digest, *m) for m in matches]

            return found

        part = staged(map_rows(documents.select("doc_id", "text"), make, schema), "matches")
        parts.append(part.withColumn("pass", F.lit(len(parts))))
    if not parts:
        return documents.sparkSession.createDataFrame([], schema).drop("digest")
    columns = ["doc_id", "item_id", "word", "similarity"]
    if len(parts) == 1:
        return parts[0].select(columns)
    # Texts of one item may have met in different passes. A row repeated k times has k equal results
    # in each of them.
    keys = ["doc_id", "digest", "item_id"]
    best = F.max_by("word", F.struct("similarity", -F.col("word"))).alias("word")
    once = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*keys, "pass")
        .agg(F.count("*").alias("copies"), best, F.max("similarity").alias("similarity"))
        .groupBy(*keys)
        .agg(F.max("copies").alias("copies"), best, F.max("similarity").alias("similarity"))
    )
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(columns)


def without_benchmark(documents: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of ``documents`` whose text holds no benchmark item, all columns unchanged.

    Null and empty texts hold none and stay, as does everything if the benchmark is empty. Repeated
    rows stay or go together.
    """
    out = documents
    for items in item_blocks(benchmark, pass_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            index = Benchmark(shared.value)
            return lambda text: not index.matches(text or "")

        out = keep_rows(out, "text", make)
    return out
