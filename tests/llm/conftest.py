from __future__ import annotations

import random

import pytest

#: Columns that operators use themselves; inputs may bring their own.
CLASHING = ("fp", "x", "n", "k", "row", "spans", "component_id", "score", "held_out", "digest", "_row")


@pytest.fixture
def documents(spark):
    def make(rows, extra=CLASHING):
        names = ", ".join(f"{c} string" for c in extra)
        return spark.createDataFrame(
            [(i, t, *["theirs"] * len(extra)) for i, t in rows],
            f"doc_id bigint, text string{', ' + names if names else ''}",
        )

    return make


@pytest.fixture
def prose():
    def make(seed, words):
        rnd = random.Random(seed)
        parts = ["ba", "ko", "ti", "re", "mu", "san", "del", "vor", "li", "pe"]
        return " ".join("".join(rnd.choices(parts, k=rnd.randint(1, 3))) for _ in range(words))

    return make


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def rows_of():
    return ordered
