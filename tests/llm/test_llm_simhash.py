from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quillvault.llm.components import components
from quillvault.llm.simhash import (
    across,
    fingerprint,
    linked_fingerprints,
    masks,
    near_copies,
    one_of_each,
    signed,
)


def plain_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def least_reachable(ids, linked):
    label = list(range(len(ids)))
    while True:
        new = [min(label[j] for j in range(len(ids)) if linked(i, j)) for i in range(len(ids))]
        if new == label:
            break
        label = new
    members = {}
    for i, lab in enumerate(label):
        if ids[i] is not None:
            members[lab] = min(members.get(lab, ids[i]), ids[i])
    return [members.get(lab) for lab in label]


def test_fingerprint(prose):
    for seed in range(30):
        text = prose(seed, seed * 7).upper() + " Ä\x0bß"
        assert fingerprint(text) == plain_fingerprint(text)
    assert fingerprint("") == fingerprint(" \t\n") == 0
    assert fingerprint("ONE two") == xxhash.xxh64_intdigest(b"one two", 42)
    assert fingerprint(" a" * 700) == xxhash.xxh64_intdigest(b"a a a a", 42)


def test_masks_cover_every_pair_within_the_radius():
    every = masks(4)
    assert len(every) == 31 and all(30 <= m.bit_count() <= 36 for m in every)
    rnd = random.Random(1)
    for _ in range(3000):
        bits = rnd.sample(range(64), rnd.randint(1, 4))
        difference = sum(1 << b for b in bits)
        assert any(not difference & m for m in every)
    small = masks(2, 8)
    assert all(any(not (1 << a | 1 << b) & m for m in small) for a, b in combinations(range(8), 2))


def test_links_against_brute_force(spark):
    rnd = random.Random(3)
    prints = {0}
    for _ in range(25):  # chains and clouds around centres
        value = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 40)):
            prints.add(value)
            other = value
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                other ^= 1 << b
            prints.add(other)
            value = other if rnd.random() < 0.3 else value
    prints = sorted(signed(p) for p in prints)
    array = np.array(prints, np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    want = least_reachable(prints, lambda i, j: near[i, j])
    df = spark.createDataFrame([(p, 1) for p in prints], "fp bigint, n bigint")
    got = {r.fp: r.root for r in linked_fingerprints(df).collect()}
    assert [got.get(p, p) for p in prints] == want


def test_cells_miss_nothing(spark):
    rnd = random.Random(5)
    rows = [(0, 0, p, 1 if p < 60 else p) for p in rnd.sample(range(1 << 10), 90)]
    df = spark.createDataFrame(rows, "t int, key bigint, fp bigint, component bigint")
    want = {
        (min(a[3], b[3]), max(a[3], b[3]))
        for a, b in combinations(rows, 2)
        if a[3] != b[3] and (a[2] ^ b[2]).bit_count() <= 2
    }
    for cell in (1024, 7):
        assert {tuple(r) for r in across(df, 2, cell).collect()} == want


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 2), (20, 10), *[(100, 100 + i) for i in range(1, 60)],
             *[(200 + i, 201 + i) for i in range(40)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got[3] == 1 and got[9] == 7 and got[20] == 10 and 5 not in got
    assert all(got[100 + i] == 100 for i in range(60)) and all(got[200 + i] == 200 for i in range(41))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def corpus(prose):
    base = prose(1, 400)
    edited = base.split()
    edited[200] = "changed"
    rows = [(7, base), (3, base.upper()), (9, " ".join(edited)), (1, prose(2, 300)), (1, prose(2, 300))]
    return [*rows, (12, None), (11, ""), (None, "   "), (None, prose(3, 50)), (40, prose(4, 30000))]


def test_near_copies(documents, prose, rows_of):
    rows = corpus(prose)
    got = rows_of(near_copies(documents(rows)))
    prints = [plain_fingerprint((t or "").upper()) for _, t in rows]
    want = least_reachable(
        [i for i, _ in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4
    )
    assert got == sorted(
        ((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want, strict=True)), key=repr
    )
    assert near_copies(documents([])).count() == 0


def test_one_of_each(documents, prose):
    df = documents(corpus(prose))
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert all(r[c] == "theirs" for r in kept.collect() for c in df.columns[2:])
    assert sorted(i for i in ids if i is not None) == [1, 3, 11, 40] and ids.count(None) == 1
    assert one_of_each(documents([])).count() == 0


def test_many_equal_texts_stay_few_rows(documents, prose):
    rows = [(i, prose(i % 3, 60)) for i in range(300)]
    got = near_copies(documents(rows)).groupBy("component_id").agg(F.count("*").alias("n")).collect()
    assert {(r.component_id, r.n) for r in got} == {(0, 100), (1, 100), (2, 100)}


def test_one_of_each_with_several_texts_of_one_id(documents, prose):
    a, b, c = (prose(i, 200) for i in (31, 32, 33))
    rows = [(1, a), (1, b), (1, b.upper()), (2, a), (2, c), (3, c), (3, c), (4, b)]
    kept = [(r.doc_id, r.text.lower()) for r in one_of_each(documents(rows)).collect()]
    assert sorted(kept) == sorted([(1, a), (1, b), (2, c)])
