"""Vector codes against plain Python and the tree of split points against all distances."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from quillvault.llm.gnat import Tree
from quillvault.llm.vector_codes import (
    decoded,
    encoded,
    of_one_length,
    trained,
    usable,
    vector_codes,
)

SCHEMA = "vec_id bigint, label int, embedding array<double>, code string, part int, _rows int"


def plain(rows, entries=256, rounds=4, parts=4):
    kept = [
        (i, label, v)
        for i, label, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    smallest = {}
    for i, _, v in kept:
        if i is not None:
            smallest[i] = min(smallest.get(i, v), v)
    if not smallest:
        return []
    length = len(smallest[min(smallest)])
    kept = [(i, label, v) for i, label, v in kept if len(v) == length]
    smallest = {}
    for i, _, v in kept:
        if i is not None:
            smallest[i] = min(smallest.get(i, v), v)
    sizes = [length // parts + (p < length % parts) for p in range(parts)]
    edges = [sum(sizes[:p]) for p in range(parts + 1)]

    def whole(v):
        v = [int(x) * 1024 if abs(x) >= 2**52 else math.floor(1024 * x) for x in v]
        return [v[a:b] for a, b in zip(edges, edges[1:])]

    seeds = [whole(smallest[i]) for i in sorted(smallest)[:entries]]
    books = [[s[p] for s in seeds] for p in range(parts)]
    vectors = [whole(v) for _, _, v in kept]

    def nearest(book, part):
        return min((sum((x - y) ** 2 for x, y in zip(e, part)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        groups = defaultdict(list)
        for v in vectors:
            for p in range(parts):
                groups[p, nearest(books[p], v[p])[1]].append(v[p])
        for (p, e), members in groups.items():
            books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode())
    out, by_label = [], defaultdict(int)
    for (i, label, _), v in zip(kept, vectors):
        found = [nearest(books[p], v[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    def long(n):
        return n if n < 2**63 else None

    unknown = {label for _, label, _, e in out if long(e) is None}
    rows = [
        (i, code, long(e), None if label in unknown else long(by_label[label]), digest.hexdigest())
        for i, label, code, e in out
    ]
    return sorted(rows, key=repr)


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, label, v, "theirs", 1, 1) for i, label, v in rows], SCHEMA
        ).repartition(3)

    return make


def made(seed, n, length, ids=None):
    rnd = random.Random(seed)
    base = [[rnd.gauss(0, 0.2) for _ in range(length)] for _ in range(9)]
    return [
        (
            i if ids is None else rnd.choice(ids),
            rnd.choice([None, 1, 2, 3]),
            [x + rnd.gauss(0, 0.002) for x in rnd.choice(base)],
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("n, length, entries, rounds", [(400, 8, 256, 4), (60, 12, 16, 2), (5, 4, 256, 4)])
def test_as_plain_python(table, rows_of, n, length, entries, rounds):
    rows = made(n, n, length)
    rows += [(9001, 1, None), (9002, 1, [None] * length), (9003, 2, [math.nan] * length)]
    rows += [(9004, 1, [math.inf] + [0.0] * (length - 1)), (-1, 3, [0.5] * length)]
    got = rows_of(vector_codes(table(rows), entries=entries, rounds=rounds))
    assert got == plain(rows, entries, rounds)


def test_ties_repeats_lengths_and_missing_ids(table, rows_of):
    rng = random.Random(4)
    grid = [-1 / 1024, 0.0, 1 / 1024, 0.4 / 1024]
    rows = [(i, i % 2, [rng.choice(grid) for _ in range(6)]) for i in range(150)]
    rows += rows[:40] + [(None, 1, [0.1] * 6), (3, 0, [0.2] * 6), (7, None, [0.2] * 3), (8, 1, [])]
    assert rows_of(vector_codes(table(rows), entries=20)) == plain(rows, 20)


def test_large_components_are_exact(table, rows_of):
    rng = random.Random(6)
    rows = [(i, i % 3, [rng.uniform(-1, 1) * 10.0**e for e in (0, 4, 9, 12)]) for i in range(60)]
    rows += [(60 + i, 4, [3e38 * rng.choice([-1, 1]), 1e17, 0.1, 1.7e308]) for i in range(3)]
    assert rows_of(vector_codes(table(rows), entries=8)) == plain(rows, 8)


def test_nothing_usable(table):
    assert vector_codes(table([])).count() == 0
    assert vector_codes(table([(1, 1, None), (None, 1, [1.0])])).count() == 0


def test_empty_vectors(table, rows_of):
    rows = [(1, 1, []), (2, 1, []), (3, None, [])]
    got = rows_of(vector_codes(table(rows)))
    assert [r[:4] for r in got] == [(i, "00000000", 0, 0) for i in (1, 2, 3)]


def test_codes_come_back_as_vectors(table):
    rows = made(3, 80, 8)
    vectors = of_one_length(usable(table(rows)))
    books = trained(vectors, entries=64)
    codes = encoded(vectors, books)
    error = {r["vec_id"]: r["error"] for r in codes.collect()}
    for r in decoded(codes, books).collect():
        whole = [math.floor(1024 * x) for x in rows[r["vec_id"]][2]]
        back = [round(1024 * x) for x in r["embedding"]]
        assert sum((a - b) ** 2 for a, b in zip(whole, back)) == error[r["vec_id"]]


@pytest.mark.parametrize("kind", [float, object])
@pytest.mark.parametrize("spread", [2, 700])
def test_tree_finds_the_first_nearest(kind, spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (256, 3)).astype(kind)
    entries[40:60] = entries[0]  # the same entry many times
    queries = rng.integers(-spread, spread + 1, (300, 3)).astype(kind)
    index, squared, taken = Tree(entries).nearest(queries)
    every = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all()
    assert (squared == every.min(axis=1)).all()
    assert taken < 0.6 * every.size  # whole subtrees are left out
