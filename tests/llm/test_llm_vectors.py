from __future__ import annotations

import math
import random

import numpy as np
import pytest

from quillvault.llm import embeddings
from quillvault.llm.embeddings import close_intervals, near_duplicates


def brute(rows, cosine=0.9):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        if not usable(a) or not usable(b) or len(a) != len(b):
            return False
        x, y = np.asarray(a, np.float64), np.asarray(b, np.float64)
        return x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine

    n = len(rows)
    near = [[j for j in range(n) if j != i and linked(rows[i][1], rows[j][1])] for i in range(n)]
    label = list(range(n))
    while True:
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(n)]
        if new == label:
            break
        label = new
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[label[i]] = min(least.get(label[i], vec_id), vec_id)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        component = least.get(label[i])
        out.append((vec_id, len(near[i]), component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


def vectors(seed, n, width=12):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rnd.integers(12)] + rnd.normal(size=width) * rnd.choice([0.05, 0.2, 0.5, 2])
        rows.append((int(i * 7 % 1009), [float(x) for x in v.astype(np.float32)]))
    return rows


ODD = [
    (5000, None), (5001, []), (5002, [0.0] * 12), (5003, [1.0, None] + [0.0] * 10), (5004, [float("nan")] * 12),
    (5005, [float("inf")] + [1.0] * 11), (None, [1.0] * 12), (5006, [2.0] * 12), (5006, [2.0] * 12), (5007, [3.0] * 4),
    (5008, [3.0] * 4), (5009, [-0.0] * 11 + [1e-30]), (5010, [0.0] * 11 + [1e30]), (None, None),
]
SCHEMA = "vec_id bigint, embedding array<float>, label string, key string, n string, links string"


@pytest.mark.parametrize("block,tile", [(256, 32), (8, 2), (1, 3)])
def test_against_brute_force(spark, rows_of, monkeypatch, block, tile):
    rows = vectors(1, 260) + ODD
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, v, "l", "k", "n", "x") for i, v in rows], SCHEMA)
    monkeypatch.setattr(embeddings.blocks_of, "__defaults__", (block,))
    monkeypatch.setattr(embeddings.tile_links, "__defaults__", (tile,))
    assert rows_of(near_duplicates(df)) == brute(rows)


def test_the_limit_itself(spark, rows_of):
    # cosine of (3, 4) with (4, 3) is 0.96 exactly, with (0, 1) 0.8
    rows = [(1, [3.0, 4.0]), (2, [4.0, 3.0]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for limit, links in ((0.96, [1, 1, 0]), (0.8, [2, 1, 1]), (0.97, [0, 0, 0])):
        assert [r[1] for r in sorted(near_duplicates(df, limit).collect())] == links


def test_nothing_usable(spark, rows_of):
    schema = "vec_id bigint, embedding array<float>"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = rows_of(near_duplicates(spark.createDataFrame([(1, None), (None, [0.0])], schema)))
    assert got == sorted([(1, 0, 1, True), (None, 0, None, False)], key=repr)


def test_many_copies(spark):
    rows = [(i, [1.0, 0.5, float(i % 2)]) for i in range(400)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert {(r.n_links, r.component_id, r.kept) for r in got if r.vec_id > 1} == {(199, 0, False), (199, 1, False)}


def test_only_distant_intervals_are_skipped(spark):
    rnd = random.Random(3)
    boxes = []
    for i in range(50):
        low = [rnd.uniform(0, 10), rnd.uniform(0, 10)]
        boxes.append((i, low, [x + rnd.uniform(0, 1) for x in low]))

    def gap(a, b):
        return sum(max(a[1][d] - b[2][d], b[1][d] - a[2][d], 0) ** 2 for d in range(2)) ** 0.5

    df = spark.createDataFrame(boxes, "block bigint, low array<double>, high array<double>")
    got = {(r.a, r.b) for r in close_intervals(df, 1.5, 2).collect()}
    assert got == {(a[0], b[0]) for a in boxes for b in boxes if a[0] <= b[0] and gap(a, b) <= 1.5}
    assert len(got) < 600


def test_pairs_of_huge_and_tiny_vectors_at_the_limit():
    """Products of components beyond 1e154 leave the doubles; the cosine does not."""
    from quillvault.llm.embeddings import exact_cosine

    rng = np.random.default_rng(9)
    for _ in range(50):
        x, y = rng.normal(size=(2, 12))
        want = exact_cosine(x.tobytes(), y.tobytes())
        for up, down in ((2.0**900, 2.0**900), (2.0**1000, 2.0**-900), (2.0**-700, 2.0**-700)):
            assert exact_cosine((x * up).tobytes(), (y * down).tobytes()) == want
        assert abs(want - x @ y / np.linalg.norm(x) / np.linalg.norm(y)) < 1e-12
    big = np.array([1e300, -1e300, 1e-300])
    assert exact_cosine(big.tobytes(), big.tobytes()) == pytest.approx(1.0, abs=1e-15)
