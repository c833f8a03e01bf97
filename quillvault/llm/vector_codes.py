"""Vectors as short codes: each part of a vector is replaced by the nearest entry of a codebook.

Components become whole numbers, so assignments, sums and errors are exact and the same on every
cluster. Spark passes over all vectors once a round: every task finds nearest entries by a tree of
split points (``gnat``), sums its parts per entry, and only these sums, a few numbers per entry and
task, are shuffled and added up. The codebooks (at most 256 entries a part) go with the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault.llm.gnat import Tree, fits_doubles
from quillvault.llm.tables import staged
from quillvault.plans.joins import attach

SCALE = 1024
#: Vectors compared at a time within a batch.
ROWS = 4096
LARGEST_LONG = (1 << 63) - 1


class Codebooks(NamedTuple):
    """``entries[p]``: the whole-number entries of part p; ``edges``: where the parts begin and end."""

    edges: list[int]
    entries: list[list[list[int]]]

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position."""
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows whose vector is not null and holds only finite components, as ``array<double>``."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    return embeddings.filter(F.col("embedding").isNotNull() & finite).select(
        "vec_id", "label", vector.alias("embedding")
    )


def _whole(values: np.ndarray, largest: float, length: int) -> np.ndarray:
    """floor(SCALE * x): doubles where all arithmetic on them is exact, else Python integers."""
    if fits_doubles(SCALE * largest + 1, length):
        return np.floor(values * SCALE)
    exact = [int(x) * SCALE if abs(x) >= 1 << 52 else math.floor(x * SCALE) for x in values.flat]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(values.shape)


class _Assigner:
    """Nearest entries of whole vectors; trees are built once a task."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.longest = max(b - a for a, b in zip(books.edges, books.edges[1:], strict=False))
        self.largest = max(
            (abs(x) for part in books.entries for entry in part for x in entry), default=0
        )
        self.trees: dict[bool, list[Tree]] = {}

    def _trees(self, exact: bool) -> list[Tree]:
        if exact not in self.trees:
            edges = self.books.edges
            made = []
            for p, part in enumerate(self.books.entries):
                table = np.empty((len(part), edges[p + 1] - edges[p]), float if exact else object)
                for i, entry in enumerate(part):
                    table[i] = entry
                made.append(Tree(table))
            self.trees[exact] = made
        return self.trees[exact]

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, list]]:
        """For rows of the batch at a time: which, their whole parts, and (index, squared) a part."""
        length = self.books.edges[-1]
        column = batch.column("embedding")
        flat = column.flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(batch.num_rows, length)
        for start in range(0, batch.num_rows, ROWS):
            some = vectors[start : start + ROWS]
            largest = max(float(np.abs(some).max(initial=0)), self.largest / SCALE)
            whole = _whole(some, largest, self.longest)
            trees = self._trees(whole.dtype != object)
            parts = [
                whole[:, a:b]
                for a, b in zip(self.books.edges, self.books.edges[1:], strict=False)
            ]
            found = [tree.nearest(part)[:2] for tree, part in zip(trees, parts, strict=True)]
            yield slice(start, start + len(some)), parts, found


def _sums(vectors: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and componentwise sum of the parts that each used entry is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _Assigner(books)
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, parts, found in assign(batch):
                for p, (part, (index, _)) in enumerate(zip(parts, found, strict=True)):
                    order = np.argsort(index, kind="stable")
                    used, starts = np.unique(index[order], return_index=True)
                    # At most ROWS components below 2 ** 27 in a sum: exact in doubles.
                    sums = np.add.reduceat(part[order], starts, axis=0)
                    sizes = np.diff([*starts, len(order)])
                    for e, n, s in zip(used.tolist(), sizes.tolist(), sums, strict=True):
                        total = totals.setdefault((p, e), [0, [0] * part.shape[1]])
                        total[0] += n
                        total[1] = [x + int(y) for x, y in zip(total[1], s, strict=True)]
        rows = [(p, e, n, ",".join(map(str, s))) for (p, e), (n, s) in totals.items()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[i] for r in rows], t)
                for i, t in enumerate([pa.int32(), pa.int32(), pa.int64(), pa.string()])
            ],
            ["part", "entry", "n", "sums"],
        )

    def add(table: pa.Table) -> pa.Table:
        n = sum(table.column("n").to_pylist())
        rows = [[int(x) for x in s.split(",") if x] for s in table.column("sums").to_pylist()]
        sums = ",".join(str(sum(column)) for column in zip(*rows, strict=True))
        return table.slice(0, 1).set_column(2, "n", [[n]]).set_column(3, "sums", [[sums]])

    schema = "part int, entry int, n bigint, sums string"
    partial = vectors.select("embedding").mapInArrow(run, schema)
    # At most one row an entry comes back: a few thousand numbers whatever the input.
    rows = partial.groupBy("part", "entry").applyInArrow(add, schema).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(x) for x in r["sums"].split(",") if x]) for r in rows}


def _seeds(vectors: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest different ids; of several vectors of an id the smallest."""
    ids = (
        vectors.filter(F.col("vec_id").isNotNull())
        .select("vec_id")
        .distinct()
        .orderBy("vec_id")
        .limit(entries)
    )
    rows = (
        vectors.join(F.broadcast(ids), "vec_id")  # at most `entries` ids
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .orderBy("vec_id")
        .collect()
    )
    return [r["embedding"] for r in rows]


def of_one_length(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is as long as that of the smallest id."""
    first = _seeds(vectors, 1)
    return vectors.filter(F.size("embedding") == (len(first[0]) if first else -1))


def trained(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """Codebooks of ``vectors`` (``vec_id, embedding``: usable and of one length).

    Each begins as the parts of the smallest ids and is moved ``rounds`` times to the rounded-down
    means of the parts nearest to its entries; entries that no part is nearest to stay. Where the
    length is no multiple of ``parts`` the first parts are one longer.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part")
    seeds = _seeds(vectors, entries)
    length = len(seeds[0]) if seeds else 0
    sizes = [length // parts + (p < length % parts) for p in range(parts)]
    edges = [sum(sizes[:p]) for p in range(parts + 1)]
    whole = [
        [int(x) for x in _whole(np.array(s, float), math.inf, 1)] if s else [] for s in seeds
    ]
    books = Codebooks(edges, [[v[a:b] for v in whole] for a, b in zip(edges, edges[1:], strict=False)])
    for _ in range(rounds if seeds else 0):
        for (p, e), (n, sums) in _sums(vectors, books).items():
            books.entries[p][e] = [s // n for s in sums]
    return books


def encoded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every row; an error beyond 64 bits is null."""
    schema = "vec_id bigint, label string, code string, error bigint"
    label_type = vectors.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _Assigner(books)
        for batch in batches:
            for rows, _, found in assign(batch):
                codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
                errors = sum(squared.astype(object) for _, squared in found)
                errors = [int(e) if e <= LARGEST_LONG else None for e in errors]
                size = rows.stop - rows.start
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(rows.start, size),
                        batch.column("label").slice(rows.start, size),
                        pa.array([c.tobytes().hex() for c in codes], pa.string()),
                        pa.array(errors, pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    named = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("string"), "embedding"
    )
    out = named.mapInArrow(run, schema)
    return out.withColumn("label", F.col("label").cast(label_type))


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, embedding``: the vectors that the codes stand for, in the scale of the input."""
    tables = [
        F.array(*(F.array(*(F.lit(x / SCALE) for x in entry)).cast("array<double>") for entry in part))
        for part in books.entries
    ]
    parts = [
        F.element_at(table, F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1)
        for p, table in enumerate(tables)
    ]
    return codes.select("vec_id", F.concat(*parts).alias("embedding"))


def vector_codes(
    embeddings: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector.

    Rows are dropped whose vector is null, holds null or non-finite components, or is not as long as
    that of the smallest kept vec_id. Repeated rows stay repeated and count as often as they are
    there; an id seeds a codebook once, by its smallest vector. Rows without a vec_id are encoded
    but seed nothing; if no row has one, none is kept. Empty vectors have the code of entry 0 in every
    part. Null labels are one label; an error beyond 64 bits is null, and so is the sum of its
    label. Empty tables give no row. Other columns are not read.
    """
    vectors = of_one_length(staged(usable(embeddings), "vectors"))
    books = trained(vectors, parts, entries, rounds)
    if not books.entries or not books.entries[0]:
        return embeddings.sparkSession.createDataFrame(
            [],
            "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
        )
    found = staged(encoded(vectors, books).withColumn("_label", F.struct("label")), "codes")
    sums = found.groupBy("_label").agg(
        F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"),
        F.count("*").alias("_rows"),
    )
    joined = attach(found, sums, "_label", weight="_rows", tie="vec_id", few=False)
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
