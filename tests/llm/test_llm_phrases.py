"""Phrase mining against plain Python, and quotient filters against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillvault.llm import phrases
from quillvault.llm.phrases import best_of, collocations
from quillvault.llm.quotient import (
    Entries,
    Shape,
    buckets,
    counted,
    merged,
    packed,
    permuted,
    shape_for,
    unpacked,
    words_of,
)

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least, explained, most):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        n = sum(f for w, f in c.items() if len(w) == 1)
        found = {w: f for w, f in c.items() if len(w) > 1 and f >= least}
        dropped = {
            part
            for w, f in found.items()
            if len(w) == 3
            for part in (w[:2], w[1:])
            if 100 * f >= explained * found[part]
        }
        scored = []
        for w, a in found.items():
            if w not in dropped:
                score, k = min(
                    (10**6 * a * a // (c[w[:k]] * c[w[k:]]), k) for k in range(1, len(w))
                )
                scored.append((-score, -a, " ".join(w).encode(), c[w[:k]], c[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out, key=repr)


def made(seed, texts):
    rnd = random.Random(seed)
    words = ["The", "of", "a", "État", "naïve", "x\x1fy", "中文", "B\xa0b", "don't", "q" * 40]
    signs = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\x85", "! ? "]
    langs = ["en", "de", None, ""]
    return [
        (rnd.choice(langs), "".join(rnd.choice(words) + rnd.choice(signs) for _ in range(rnd.randint(0, 60))))
        for _ in range(texts)
    ]


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, lang, text, "theirs", "theirs", 1) for i, (lang, text) in enumerate(rows)],
            "doc_id bigint, lang string, text string, word string, f string, id int",
        )

    return make


@pytest.mark.parametrize("least, explained, most", [(10, 50, 2000), (3, 80, 7)])
def test_as_plain_python(table, rows_of, least, explained, most):
    rows = [*made(least, 150), ("en", None), ("en", ""), (None, " \t"), *[("de", "Same words here")] * 12]
    got = rows_of(collocations(table(rows).repartition(5), least, explained, most))
    assert got == plain(rows, least, explained, most)


def test_small_chunks_slices_and_buckets(table, rows_of, monkeypatch):
    for name, size in [("CHUNK_BYTES", 300), ("OPEN_BYTES", 500), ("SLICE_BYTES", 16)]:
        monkeypatch.setattr(phrases, name, size)
    monkeypatch.setattr(phrases, "TASK_ENTRIES", 40)
    monkeypatch.setattr(phrases, "BUCKET_ENTRIES", 64)
    monkeypatch.setattr(phrases, "RANKED_ROWS", 30)
    rows = [*made(5, 120), ("en", "long " * 400 + "e" * 90)]
    got = rows_of(collocations(table(rows).repartition(3), 4, 50, 9))
    assert got == plain(rows, 4, 50, 9)


def test_nothing_to_count(table):
    assert collocations(table([])).count() == 0
    assert collocations(table([("en", "one two three"), (None, None)])).count() == 0


def test_ranks_of_a_large_group(spark):
    rows = spark.range(5000).selectExpr("'x' AS g", "id % 7 AS s", "cast(id AS string) AS t")
    got = best_of(rows, "g", [rows["s"].desc(), rows["t"]], "t", 20).collect()
    want = sorted(((-(i % 7), str(i)) for i in range(5000)))[:20]
    assert sorted((r["rank"], -r["s"], r["t"]) for r in got) == [
        (k, s, t) for k, (s, t) in enumerate(want, 1)
    ]


@pytest.mark.parametrize("shape", [Shape(16, 0), Shape(16, 5), Shape(22, 3), Shape(42, 9)])
def test_filters_lose_nothing(shape):
    rnd = random.Random(shape.width)
    most = (1 << shape.width) - 1
    pool = [(rnd.randint(1, most), rnd.randint(1, most), rnd.randint(0, most)) for _ in range(300)]
    pool += [(most, most, most), (1, 1, 0)]
    parts, want = [], Counter()
    for _ in range(4):
        some = rnd.choices(pool, k=400)
        want.update(some)
        high, low = permuted(*np.array(some, np.uint64).T, shape)
        parts.append(counted(high, low, np.ones(400, np.int64), shape))
    want[pool[0]] += 10**12
    high, low = permuted(*([x] for x in pool[0]), shape)
    parts.append(Entries(high, low, np.array([10**12])))
    stored = [
        (number, len(e.high), packed(e, shape)) for part in parts for number, e in buckets(part, shape)
    ]
    got = Counter()
    for number in {b for b, _, _ in stored}:
        total = merged([unpacked(raw, n, b, shape) for b, n, raw in stored if b == number], shape)
        words = zip(*(w.tolist() for w in words_of(total.high, total.low, shape)), strict=True)
        for key, count in zip(words, total.count.tolist(), strict=True):
            assert key not in got
            got[key] = count
    assert got == want


def test_filters_are_compact_and_even():
    shape = shape_for(100_000, 1 << 22, 1 << 18)
    rnd = np.random.default_rng(3)
    words = rnd.integers(1, 50, (3, 200_000), np.uint64)  # few words: keys close to each other
    words[2] = np.arange(200_000)
    high, low = permuted(*words, shape)
    entries = counted(high, low, np.ones(200_000, np.int64), shape)
    sizes = [len(e.high) for _, e in buckets(entries, shape)]
    assert len(sizes) == 1 << shape.bucket and max(sizes) < 1.1 * min(sizes)
    stored = sum(len(packed(e, shape)) for _, e in buckets(entries, shape))
    assert stored < 8 * len(entries.high)


def test_too_many_words_are_refused():
    with pytest.raises(ValueError):
        shape_for(1 << 42, 1, 1)


@pytest.mark.parametrize("shape", [Shape(16, 5), Shape(20, 0), Shape(42, 9)])
def test_filters_are_merged_range_by_range(shape, monkeypatch):
    """What merging takes beside the filters is bounded by a range, and nothing of them is lost."""
    from quillvault.llm import quotient

    rng = np.random.default_rng(5)
    parts = []
    for _ in range(6):
        high, low = permuted(*(rng.integers(1, 1 << 12, 5000) for _ in range(3)), shape)
        parts.append(counted(high, low, np.ones(5000, np.int64), shape))
    whole = merged(parts, shape)
    pieces = buckets(whole, shape)
    sizes = []
    plain = quotient.counted
    monkeypatch.setattr(quotient, "RANGE_ENTRIES", 500)
    monkeypatch.setattr(quotient, "counted", lambda *a: sizes.append(len(a[0])) or plain(*a))
    ranges = list(quotient.merged_ranges(parts, shape))
    found = [x for entries in ranges for x in buckets(entries, shape)]
    assert [b for b, _ in found] == [b for b, _ in pieces]  # no bucket is cut
    for a, b in zip(whole, (np.concatenate(x) for x in zip(*ranges, strict=True)), strict=True):
        assert np.array_equal(a, b)
    assert max(sizes) < 2 * max(500, 30_000 >> shape.bucket)
    for number, entries in pieces:
        del sizes[:]
        halves = [Entries(*(lane[i::2] for lane in entries)) for i in (0, 1)]
        within = list(quotient.merged_ranges(halves, shape, number))
        for a, b in zip(entries, (np.concatenate(x) for x in zip(*within, strict=True)), strict=True):
            assert np.array_equal(a, b)
        assert max(sizes) < 1000


def test_phrases_of_slices_as_of_the_whole(table, rows_of, monkeypatch):
    from quillvault.llm import phrases

    monkeypatch.setattr(phrases, "SLICE_WORDS", 3)
    test_as_plain_python(table, rows_of, 2, 50, 1000)
