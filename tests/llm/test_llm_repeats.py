from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quillvault.llm import repeats
from quillvault.llm.repeats import SuffixArray, anchors, kept_bytes, remove_repeats, repeat_groups


def brute(rows, length=100):
    """Expected rows; documents in order of id, null last."""
    first = {}
    for doc_id, text in rows:
        doc = repeats.LAST if doc_id is None else doc_id
        raw = (text or "").encode()
        for s in range(len(raw) - length + 1):
            key = raw[s : s + length]
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for doc_id, text in rows:
        doc = repeats.LAST if doc_id is None else doc_id
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 2, bool)
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (doc, s):
                gone[s + 1 : s + 1 + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(raw, gone[1:], strict=False) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(prose):
    a, b, c = prose(1, 120), prose(2, 150), prose(3, 90)
    line = "This very line, of more than one hundred bytes, is met again in many of the documents of this corpus."
    rnd = random.Random(4)
    rows = [(5, a), (2, b), (9, a[50:400] + c + b[100:350]), (3, a), (None, b[10:200] + "é" * 80), (None, a)]
    rows += [(20 + i, prose(100 + i, 15) + line + prose(200 + i, 12)) for i in range(25)]
    rows += [(60, "ab" * 400), (61, "x" * 350), (62, "x" * 99), (63, None), (64, ""), (65, line * 3)]
    rows += [(70, c), (70, c), (71, c[:200] + "!" + c[201:])]
    for i in range(20):
        pieces = [rnd.choice([a, b, c]) for _ in range(3)]
        rows.append((80 + i, "".join(p[(s := rnd.randint(0, 300)) : s + rnd.randint(90, 250)] for p in pieces)))
    return rows


@pytest.mark.parametrize("most", [2000, 1, 3])
def test_against_brute_force(documents, prose, rows_of, monkeypatch, most):
    monkeypatch.setattr(repeats, "SORTED_SLICES", most)
    rows = corpus(prose)
    assert rows_of(remove_repeats(documents(rows))) == brute(rows)


def strings_with_anchors(raw):
    return {
        s: (int(h), int(p))
        for h, p, first, last in zip(*anchors(raw), strict=True)
        for s in range(first, last + 1)
    }


def test_segments_of_long_texts(prose, monkeypatch):
    raw = np.frombuffer(prose(9, 2000).encode(), np.uint8)
    want = strings_with_anchors(raw)
    monkeypatch.setattr(repeats, "SEGMENT", 256)
    assert strings_with_anchors(raw) == want and len(want) == raw.size - 99


def test_empty(documents):
    assert remove_repeats(documents([])).count() == 0
    assert repeat_groups(documents([(1, "short")])).count() == 0


def test_equal_strings_have_equal_anchors(prose):
    text = prose(5, 400).encode()
    a = np.frombuffer(b"left of it " + text, np.uint8)
    b = np.frombuffer(text + b" right of it", np.uint8)

    def of(raw):
        return {
            s: (int(h), int(p) - s)
            for h, p, first, last in zip(*anchors(raw), strict=True)
            for s in range(first, last + 1)
        }

    x, y = of(a), of(b)
    assert sorted(x) == list(range(len(a) - 99)) and sorted(y) == list(range(len(b) - 99))
    assert all(x[s + 11] == y[s] for s in range(len(text) - 99))
    assert all(0 <= d <= 68 for _, d in x.values())


def test_intervals_are_the_maximal_repeats():
    rnd = random.Random(2)
    slices = ["".join(rnd.choices("ab", k=rnd.randint(6, 14))).encode() for _ in range(25)]
    array = SuffixArray(slices, np.zeros(len(slices), np.int64), length=4)
    got = set()
    for a, b, size in array.maximal_repeats():
        members = array.order[a : b + 1]
        places = frozenset((int(array.owner[m]), int(array.offset[m])) for m in members)
        got.add((slices[array.owner[members[0]]][array.offset[members[0]] :][:size], places))
    want = set()
    suffixes = [(i, s) for i, x in enumerate(slices) for s in range(len(x) - 3)]
    for i, s in suffixes:
        for size in range(4, len(slices[i]) - s + 1):
            piece = slices[i][s : s + size]
            places = [(j, t) for j, t in suffixes if slices[j][t : t + size] == piece]
            after = {slices[j][t + size : t + size + 1] or (j, t) for j, t in places}
            before = {slices[j][t - 1] if t else (j, t) for j, t in places}
            if len(places) > 1 and len(after) > 1 and (len(before) > 1 or any(not t for _, t in places)):
                want.add((piece, frozenset(places)))
    assert got == want


def test_groups_hold_all_occurrences(documents, prose):
    rows = corpus(prose)[:12]
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    groups = {}
    for r in repeat_groups(documents([x for x in rows if x[0] is not None])).collect():
        groups.setdefault((r.repeat, r["size"]), set()).add((r.doc_id, r.start))
    assert groups
    for (name, size), places in groups.items():
        pieces = {texts[d][s : s + size] for d, s in places}
        assert len(pieces) == 1 and size >= 100
        assert hashlib.sha256(pieces.pop()).hexdigest() == name


def test_kept_bytes():
    assert kept_bytes(b"0123456789", [(2, 4), (3, 6), (6, 7), (9, 10)]) == (b"0178", 6, 2)
    assert kept_bytes(b"abc", []) == (b"abc", 0, 0)


def groups_of(df):
    groups = {}
    for r in repeat_groups(df).collect():
        groups.setdefault((r.repeat, r["size"]), set()).add((r.doc_id, r.start))
    return groups


def assert_all_occurrences(groups, texts):
    for (name, size), places in groups.items():
        doc, start = min(places)
        piece = texts[doc][start : start + size]
        assert hashlib.sha256(piece).hexdigest() == name
        everywhere = {(d, s) for d, t in texts.items() for s in range(len(t) - size + 1) if t.startswith(piece, s)}
        assert places == everywhere and len(places) > 1


def test_groups_of_hot_anchors(documents, prose, monkeypatch):
    rows = [(i, t or "") for i, t in dict(corpus(prose)).items() if i is not None]
    want = groups_of(documents(rows))
    assert_all_occurrences(want, {i: t.encode() for i, t in rows})
    monkeypatch.setattr(repeats, "SORTED_SLICES", 1)
    assert groups_of(documents(rows)) == want


def test_a_passage_in_more_texts_than_are_sorted(documents, prose):
    line = prose(1, 40)[:130]
    rows = [(i, f"{i:07d} {line} {i * 7919:09d}") for i in range(repeats.SORTED_SLICES + 1)]
    groups = groups_of(documents(rows))
    hot = [places for places in groups.values() if len(places) >= len(rows)]
    assert hot and all({d for d, _ in places} == {i for i, _ in rows} for places in hot)


def test_groups_in_copies(documents, prose):
    text, other = prose(1, 60), prose(2, 60)
    rows = [(1, text), (2, text), (3, other[:150] + text[:140]), (4, text), (5, "short"), (6, "short")]
    groups = groups_of(documents(rows))
    assert_all_occurrences(groups, {i: t.encode() for i, t in rows})
    for doc in (1, 2, 4):
        covered = {b for (_, size), places in groups.items() for d, s in places if d == doc for b in range(s, s + size)}
        assert covered == set(range(len(text)))
