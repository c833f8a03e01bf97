from __future__ import annotations

import random

import numpy as np
import pytest

from quillvault.llm import decontaminate as dc
from quillvault.llm.decontaminate import HammingIndex, contaminated, without_benchmark


def brute(text, items):
    """Best window of every item by exact similarity over all windows."""
    words, out = dc.words_of(text or ""), {}
    for item_id, item in items:
        wanted = dc.shingles(dc.words_of(item or ""))
        n = len(dc.words_of(item or ""))
        for s in range(len(words) - n + 1) if n else ():
            share = dc.similarity(dc.shingles(words[s : s + n]), wanted)
            if share >= 0.8 and share > out.get(item_id, (0, 0))[0]:
                out[item_id] = (share, s)
    return out


@pytest.fixture
def bench(spark):
    def make(items):
        return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")

    return make


def planted(prose):
    items = [(i, prose(50 + i, 18 + i * 5)) for i in range(12)] + [(90, "only three words"), (91, "single")]
    rows = [(i, prose(i, 60)) for i in range(20)]
    rnd = random.Random(2)
    for i, (_, text) in enumerate(items):
        words = text.split()
        changed = list(words)
        if len(changed) > 40:
            changed[len(changed) // 2] = "other"
        moved = words[: len(words) // 2] + ["put", "in"] + words[len(words) // 2 :]
        for k, version in enumerate((words, changed, moved, words[:-1])):
            around = prose(300 + i, 30).split()
            at = rnd.randint(0, 30)
            body = " ".join(around[:at]) + "\n" + ("  ".join(version)).upper() + ", " + " ".join(around[at:])
            rows.append((100 + i * 4 + k, body))
    return items, rows


def test_against_all_windows(documents, bench, prose):
    items, rows = planted(prose)
    got = {}
    for r in contaminated(documents(rows), bench(items)).collect():
        got[(r.doc_id, r.item_id)] = (r.similarity, r.word)
    want = {(i, item): v for i, t in rows for item, v in brute(t, items).items()}
    assert got == want and len(want) > 20
    in_two_passes = contaminated(documents(rows), bench(items), pass_bytes=400).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.word) for r in in_two_passes} == want
    assert len(in_two_passes) == len(want)


def test_texts_of_one_item_in_several_passes(documents, bench, prose):
    first, second = prose(1, 30), prose(2, 25)
    items = [(7, first), (7, second), (8, first), (9, prose(3, 20))]
    both = f"{prose(4, 10)} {second} {prose(5, 10)} {first}"
    rows = [(1, both), (1, both), (1, first), (None, second), (2, prose(6, 40)), (3, None)]
    want = [tuple(r) for r in contaminated(documents(rows), bench(items)).collect()]
    for pass_bytes in (60, 200, 400):
        got = contaminated(documents(rows), bench(items), pass_bytes=pass_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sorted(want, key=repr)[0][:2] == (1, 7) and len(want) == 7


def test_windows_in_parts(prose, monkeypatch):
    items, rows = planted(prose)
    whole = dc.Benchmark(items)
    want = [whole.matches(t) for _, t in rows]
    monkeypatch.setattr(dc, "WINDOWS", 5)
    assert [dc.Benchmark(items).matches(t) for _, t in rows] == want


def test_filter(documents, bench, prose):
    items, rows = planted(prose)
    df = documents([*rows, (None, items[3][1]), (999, None), (1000, "")])
    kept = without_benchmark(df, bench(items))
    assert kept.columns == df.columns
    want = [i for i, t in rows if not brute(t, items)] + [999, 1000]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_edges(documents, bench):
    df = documents([(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (None, "A, b! c d e f")])
    items = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (8, None), (9, ""), (10, "...")]
    got = contaminated(df, bench(items)).collect()
    assert sorted((repr(r.doc_id), r.item_id, r.word, r.similarity) for r in got) == [
        ("1", 7, 0, 1.0), ("1", 7, 0, 1.0), ("None", 7, 0, 1.0),
    ]
    assert contaminated(df, bench([])).count() == 0 and without_benchmark(df, bench([])).count() == 5
    assert contaminated(documents([]), bench(items)).count() == 0


def test_index_finds_every_print_within_the_radius():
    rnd = np.random.default_rng(1)
    prints = rnd.integers(0, 1 << 63, 300, np.uint64)
    asked = prints[:80].copy()
    for i in range(80):
        for b in rnd.choice(64, i % 24, replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    want = {
        (i, e) for i in range(80) for e in range(300) if int(asked[i] ^ prints[e]).bit_count() <= dc.RADIUS
    }
    assert set(HammingIndex(prints).within(asked)) == want and len(want) > 60


def test_items_longer_than_the_document(documents, bench, prose):
    items = [(i, prose(700 + i, n)) for i, n in enumerate((6, 9, 12, 20, 30, 45, 60, 100))]
    rows = [(0, "one two"), (1, "")]
    for i, item in items:
        words = item.split()
        for cut in range(0, min(len(words), 26)):
            rows.append((100 * (i + 1) + cut, " ".join(words[: len(words) - cut])))
            rows.append((100 * (i + 1) + 50 + cut, " ".join(words[cut:])))
    want = {}
    for doc_id, text in rows:
        words = dc.words_of(text)
        for item_id, item in items:
            wanted = dc.words_of(item)
            starts = range(max(1, len(words) - len(wanted) + 1))
            share, start = max((dc.similarity(dc.shingles(words[s : s + len(wanted)]), dc.shingles(wanted)), -s) for s in starts)
            if share >= dc.SIMILARITY:
                want[doc_id, item_id] = (share, -start)
    got = {(r.doc_id, r.item_id): (r.similarity, r.word) for r in contaminated(documents(rows), bench(items)).collect()}
    assert got == want and sum(v[0] < 1 for v in got.values()) > 50
    assert got[702, 6] == (54 / 56, 0)
    kept = {r.doc_id for r in without_benchmark(documents(rows), bench(items)).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}
