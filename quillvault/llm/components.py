"""Connected components of edge tables by alternating star contraction.

Each round links every node's larger neighbours to the least node it sees, then every node's smaller
ones. Least neighbours are grouped minima (partial per task) joined back to the edges, so a node
with very many neighbours is never gathered in one task. Every round is a written table in the
shared folder: no lineage grows and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault.llm.tables import staged


def _linked_to_least(edges: DataFrame) -> DataFrame:
    """Large star: neighbours above a node go to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b"))


def _chained_to_least(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours go to the least of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return near.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    return tuple(
        edges.agg(
            F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.lit(0))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least reachable node) of every node of ``edges (a, b)``.

    Loops, repeated edges and either direction are fine; null ends are ignored; no edges give no
    rows. Node ids may be any type with an order.
    """
    current = staged(
        edges.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        current = staged(_chained_to_least(_linked_to_least(current).distinct()).distinct(), "edges")
        reached = _state(current)
        if reached == state:
            break
        state = reached
    roots = current.select(F.col("a").alias("node")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
