"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine at least t lie within ``eps = sqrt(2 - 2 t)`` of each other. Vectors are
sorted by their cells of width eps on the leading principal dimensions and cut into blocks of
consecutive vectors. A block knows its box in these dimensions, with the length of the remainder as
one more (it changes by no more than the distance). Intervals of the sequence are joined recursively:
a pair of intervals whose boxes are farther apart than eps is dropped with all it holds, others are
cut into smaller intervals, down to blocks. The pairs of blocks that are left are compared exactly, in
double precision, in tiles of bounded size.

Equal vectors are one from the start, and a tile returns counts of links and one spanning forest,
so a large group of copies is never written out as pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault.llm.components import components
from quillvault.llm.tables import map_rows, staged

COSINE = 0.9
LEADING = 6
BLOCK = 256
#: Blocks on either side of a tile.
TILE = 32
FANOUT = 4
#: Cosines this close to the limit are computed again one by one.
DOUBT = 1e-9


def _bytes_of(values) -> np.ndarray | None:
    """Double vector without negative zeros, or None if it links with nothing."""
    if values is None or any(v is None for v in values):
        return None
    v = np.asarray(values, np.float64) + 0.0
    if not v.size or not np.isfinite(v).all() or not v.any():
        return None
    return v


def usable(vectors: DataFrame) -> DataFrame:
    """Stored ``vec_id, key, vector``; key and vector (packed doubles) are null for unusable rows."""

    def make():
        def one(vec_id, values):
            v = _bytes_of(values)
            if v is None:
                return [(vec_id, None, None)]
            raw = v.tobytes()
            return [(vec_id, hashlib.blake2b(raw, digest_size=16).digest(), raw)]

        return one

    return staged(
        map_rows(
            vectors.select("vec_id", "embedding"), make, "vec_id bigint, key binary, vector binary"
        ),
        "vectors",
    )


def unit(raw: bytes) -> np.ndarray:
    v = np.frombuffer(raw)
    v = v / np.abs(v).max()  # neither squares overflow nor vanish
    return v / math.sqrt(v @ v)


def principal(distinct: DataFrame, width: int, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal directions of all unit vectors; sums by position in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width + width + 1)
        for batch in batches:
            x = padded([unit(r) for r in batch.column(0).to_pylist()], width)
            total += np.concatenate([(x.T @ x).ravel(), x.sum(axis=0), [len(x)]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int64()), pa.array(total)], names=["i", "v"]
        )

    sums = np.zeros(width * width + width + 1)
    rows = distinct.select("vector").mapInArrow(run, "i bigint, v double").groupBy("i")
    for i, v in rows.agg(F.sum("v").alias("v")).collect():  # width squared, whatever the input
        sums[i] = v
    n = max(1.0, sums[-1])
    mean = sums[width * width : -1] / n
    covariance = sums[: width * width].reshape(width, width) / n - np.outer(mean, mean)
    _, directions = np.linalg.eigh(covariance)
    return mean, directions[:, ::-1][:, :leading]


def padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    if all(r.size == width for r in rows):
        return np.array(rows).reshape(-1, width)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : r.size] = r
    return out


def in_grid_order(distinct: DataFrame, width: int, eps: float, leading: int = LEADING) -> DataFrame:
    """``cells, place, key, n, vector``: rows with their cells and their place in the box space."""
    mean, directions = principal(distinct, width, leading)

    def make():
        def one(key, n, raw):
            v = unit(raw)
            x = np.zeros(width)
            x[: v.size] = v
            x -= mean
            y = x @ directions
            rest = math.sqrt(max(0.0, float(x @ x - y @ y)))
            cells = [v.size, *np.floor(y / eps).astype(int).tolist()]
            return [(cells, [*y.tolist(), rest], key, n, raw)]

        return one

    return map_rows(
        distinct.select("key", "n", "vector"),
        make,
        "cells array<bigint>, place array<double>, key binary, n bigint, vector binary",
    )


BLOCKS = (
    "part bigint, seq bigint, low array<double>, high array<double>, "
    "keys array<binary>, sizes array<bigint>, places array<double>, vectors array<binary>"
)


def blocks_of(ordered: DataFrame, block: int = BLOCK) -> DataFrame:
    """Stored blocks of consecutive vectors, numbered in grid order (``block``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seq, part = 0, TaskContext.get().partitionId()
        names = ["part", "seq", "low", "high", "keys", "sizes", "places", "vectors"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()),
                 pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.float64()),
                 pa.list_(pa.binary())]

        def packed_block():
            places = np.array([h[0] for h in held])
            row = [part, seq, places.min(axis=0).tolist(), places.max(axis=0).tolist(),
                   [h[1] for h in held], [h[2] for h in held], places.ravel().tolist(),
                   [h[3] for h in held]]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held.append(row)
                if len(held) == block:
                    yield packed_block()
                    held, seq = [], seq + 1
        if held:
            yield packed_block()

    sort = ["cells", "place"]
    cut = (
        ordered.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select("place", "key", "n", "vector")
        .mapInArrow(run, BLOCKS)
    )
    cut = staged(cut, "blocks")
    # One number per partition is all that the driver needs to number the blocks.
    counts = dict(cut.groupBy("part").agg(F.count("*")).collect())
    first, at = {}, 0
    for part in sorted(counts):
        first[part], at = at, at + counts[part]
    offset = F.create_map(*(F.lit(x) for p in sorted(first) for x in (p, first[p])))
    if not first:
        return cut.withColumn("block", F.lit(0).cast("bigint"))
    return cut.withColumn("block", (offset[F.col("part")] + F.col("seq")).cast("bigint"))


def gap(width: int) -> str:
    """Squared distance of the boxes ``la, ha`` and ``lb, hb``."""
    return (
        f"aggregate(sequence(0, {width - 1}), 0D, (s, i) -> s + "
        "pow(greatest(la[i] - hb[i], lb[i] - ha[i], 0D), 2))"
    )


def close_intervals(boxes: DataFrame, eps: float, width: int, fanout: int = FANOUT) -> DataFrame:
    """Pairs of blocks ``a <= b`` whose boxes are within ``eps``, by recursive halving of intervals.

    ``boxes``: ``block, low, high``. An interval of level l holds ``fanout ** l`` blocks.
    """
    spark = boxes.sparkSession
    top = boxes.agg(F.max("block")).first()[0]
    if top is None:
        return spark.createDataFrame([], "a bigint, b bigint")
    levels = [boxes.select(F.col("block").alias("i"), "low", "high")]
    while top:
        top //= fanout
        ends = [F.min(F.col("low")[d]).alias(f"l{d}") for d in range(width)]
        ends += [F.max(F.col("high")[d]).alias(f"h{d}") for d in range(width)]
        upper = levels[-1].groupBy(F.floor(F.col("i") / fanout).alias("i")).agg(*ends)
        levels.append(
            staged(
                upper.select(
                    "i",
                    F.array(*(f"l{d}" for d in range(width))).alias("low"),
                    F.array(*(f"h{d}" for d in range(width))).alias("high"),
                ),
                "intervals",
            )
        )
    pairs = spark.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    # Rounding must not drop a pair that is just within reach.
    limit = eps * eps * (1 + 1e-9) + 1e-12
    for level in reversed(levels[:-1]):
        children = F.sequence(F.lit(0), F.lit(fanout - 1))
        pairs = (
            pairs.withColumn("x", F.explode(children))
            .withColumn("y", F.explode(children))
            .select((F.col("a") * fanout + F.col("x")).alias("a"), (F.col("b") * fanout + F.col("y")).alias("b"))
            .filter("a <= b")
        )
        left = level.select(F.col("i").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"))
        right = level.select(F.col("i").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"))
        pairs = pairs.join(left, "a").join(right, "b").filter(F.expr(gap(width)) <= limit).select("a", "b")
        pairs = staged(pairs, "pairs")
    return pairs


def spanning(lab: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked positions their least label, in place, until nothing changes."""
    while True:
        least = np.minimum(lab[i], lab[j])
        before = lab.copy()
        np.minimum.at(lab, lab[i], least)
        np.minimum.at(lab, lab[j], least)
        lab[:] = lab[lab]
        if (lab == before).all():
            return


class Tile:
    """Blocks of one side, or of both, ready to be compared."""

    def __init__(self, rows: list[dict], width: int):
        self.x = [padded([unit(r) for r in row["vectors"]], width) for row in rows]
        self.dims = [np.array([len(r) for r in row["vectors"]]) for row in rows]
        self.raw = [row["vectors"] for row in rows]
        self.sizes = [np.array(row["sizes"], np.int64) for row in rows]
        self.start = np.cumsum([0] + [len(x) for x in self.x])
        self.gids = np.concatenate(
            [row["block"] * BLOCK_SPAN + np.arange(len(row["vectors"])) for row in rows]
        )
        self.number = {row["block"]: k for k, row in enumerate(rows)}


BLOCK_SPAN = 1 << 20


def linked_in_tile(rows: list[dict], pairs: list[tuple[int, int]], width: int, cosine: float):
    """(gid, links, linked gid) for every vector of the tile with a link."""
    tile = Tile(rows, width)
    n = int(tile.start[-1])
    links = np.zeros(n, np.int64)
    lab = np.arange(n)
    for a, b in pairs:
        p, q = tile.number[a], tile.number[b]
        c = tile.x[p] @ tile.x[q].T
        for i, j in zip(*np.nonzero(np.abs(c - cosine) < DOUBT), strict=True):
            c[i, j] = exact_cosine(tile.raw[p][i], tile.raw[q][j])
        hit = (c >= cosine) & (tile.dims[p][:, None] == tile.dims[q][None, :])
        if p == q:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        sp, sq = slice(*tile.start[p : p + 2]), slice(*tile.start[q : q + 2])
        links[sp] += hit @ tile.sizes[q]
        if p != q:
            links[sq] += hit.T @ tile.sizes[p]
        i, j = np.nonzero(hit)
        spanning(lab, i + tile.start[p], j + tile.start[q])
    seen = np.flatnonzero(links)
    return [(int(tile.gids[k]), int(links[k]), int(tile.gids[lab[k]])) for k in seen]


def scaled(x: np.ndarray) -> np.ndarray:
    """``x`` by a power of two, its largest component near 1: no product overflows, none is rounded."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def exact_cosine(a: bytes, b: bytes) -> float:
    """Correctly rounded sums, for pairs at the limit."""
    if len(a) != len(b):
        return 0.0
    x, y = scaled(np.frombuffer(a)), scaled(np.frombuffer(b))
    dot = math.fsum((x * y).tolist())
    return dot / math.sqrt(math.fsum((x * x).tolist()) * math.fsum((y * y).tolist()))


def tile_links(blocks: DataFrame, pairs: DataFrame, width: int, cosine: float, tile: int = TILE) -> DataFrame:
    """Stored ``gid, links, root``: links found in one tile, and a linked vector of the tile.

    A tile is what one task compares: the pairs between two runs of ``tile`` consecutive blocks, so
    at most ``2 * tile`` blocks are in memory.
    """
    of_tile = pairs.select(
        F.floor(F.col("a") / tile).alias("ta"), F.floor(F.col("b") / tile).alias("tb"), "a", "b"
    )
    lists = of_tile.groupBy("ta", "tb").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    needed = (
        of_tile.select("ta", "tb", F.explode(F.array("a", "b")).alias("block"))
        .distinct()
        .join(blocks.select("block", "sizes", "vectors"), "block")
        .select("ta", "tb", "block", "sizes", "vectors", F.lit(None).cast("array<struct<a: bigint, b: bigint>>").alias("pairs"))
    )
    heads = lists.select(
        "ta", "tb", F.lit(-1).cast("bigint").alias("block"), F.lit(None).cast("array<bigint>").alias("sizes"),
        F.lit(None).cast("array<binary>").alias("vectors"), "pairs",
    )
    spark = blocks.sparkSession
    dealt = needed.unionByName(heads).repartition(
        max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))),
        "ta", "tb",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        now = None

        def done():
            out = linked_in_tile(
                [r for r in rows if r["block"] >= 0],
                [(p["a"], p["b"]) for r in rows if r["block"] < 0 for p in r["pairs"]],
                width,
                cosine,
            )
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["gid", "links", "root"]
            )

        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if now is not None and (row["ta"], row["tb"]) != now:
                    yield done()
                    rows = []
                now = row["ta"], row["tb"]
                rows.append(row)
        if rows:
            yield done()

    found = dealt.sortWithinPartitions("ta", "tb").mapInArrow(
        run, "gid bigint, links bigint, root bigint"
    )
    return staged(found, "links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id, embedding``): ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor
    do vectors of different lengths. Repeated rows link with each other. A row without vec_id
    counts as a link of others but never names a component; ``component_id`` is null where no member
    has an id, and ``kept`` is then false.
    """
    rows = usable(vectors)
    distinct = staged(
        rows.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")),
        "distinct",
    )
    width = distinct.agg(F.max(F.octet_length("vector"))).first()[0]
    if width is None:
        return rows.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    width //= 8
    eps = math.sqrt(2 - 2 * cosine)
    leading = min(LEADING, width)
    blocks = blocks_of(in_grid_order(distinct, width, eps, leading))
    pairs = close_intervals(blocks.select("block", "low", "high"), eps, leading + 1)
    found = tile_links(blocks, pairs, width, cosine)
    numbered = blocks.select("block", F.posexplode("keys").alias("pos", "key")).select(
        (F.col("block") * BLOCK_SPAN + F.col("pos")).alias("gid"), "key"
    )
    linked = components(
        found.filter("gid <> root").select(F.col("root").alias("a"), F.col("gid").alias("b")).distinct()
    )
    counts = found.groupBy("gid").agg(F.sum("links").alias("links"))
    groups = staged(
        numbered.join(distinct.drop("vector"), "key")
        .join(counts, "gid", "left")
        .join(linked.withColumnRenamed("node", "gid"), "gid", "left")
        .select("key", "n", "least", F.coalesce("links", F.lit(0)).alias("links"),
                F.coalesce("component", "gid").alias("root")),
        "groups",
    )
    named = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = groups.join(named, "root").select("key", "n", "links", "component_id")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.drop("vector").join(groups, "key", "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
