"""Near-copies by SimHash, with covering tables that miss no pair within the radius.

Every bit position gets a nonzero vector of ``radius + 1`` bits. Each nonzero vector v makes a table:
its mask holds the positions whose vector has odd overlap with v. The vectors of at most
``radius`` differing positions do not span the space, so some v has even overlap with all of them,
its mask leaves all differing bits out, and the two fingerprints share a bucket of that table.

Equal fingerprints are one row from the start. Buckets are not expanded into pairs: first every
member is compared with its bucket's most frequent fingerprint, and the components of these links
are formed. Only buckets that still hold several components are compared further, and only across
components, in cells of bounded size.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault.llm.components import components
from quillvault.llm.tables import map_rows, staged, unused

SHINGLE = 4
RADIUS = 4
#: Rows on either side of a comparison cell.
CELL = 1024

ONES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of all shingles, repeats included; the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    n = max(1, len(words) - size + 1)
    first = starts[:n].tolist()
    last = (starts[min(size, len(words)) :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(first, last, strict=True)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set; eight bit lanes are summed at a time."""
    padded = np.zeros(-(-hashes.size // 255) * 255, np.uint64)
    padded[: hashes.size] = hashes
    counts = np.zeros((8, 8), np.int64)
    for j in range(8):
        lanes = ((padded >> np.uint64(j)) & ONES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[:, j] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.ravel()


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64 bits: set where more than half the shingle hashes have the bit; no words give 0."""
    hashes = shingle_hashes(text, size)
    if not hashes.size:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 1 << 18):
        counts += bit_counts(hashes[at : at + (1 << 18)])
    return int(np.packbits(counts * 2 > hashes.size, bitorder="little").view("<u8")[0])


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks of the ``2 ** (radius + 1) - 1`` covering tables."""
    vectors = (1 << radius + 1) - 1
    of = [1 + i % vectors for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if (v & of[i]).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    def make():
        return lambda doc_id, text: [(doc_id, signed(fingerprint(text or "", size)))]

    return map_rows(documents.select("doc_id", "text"), make, "doc_id bigint, fp bigint")


def crowded(distinct: DataFrame, radius: int) -> DataFrame:
    """Rows of buckets with two or more fingerprints: ``t, key, fp, lead``.

    ``distinct`` has ``fp`` and its number of documents ``n``; ``lead`` is the bucket's most
    frequent fingerprint.
    """
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(signed(m)).alias("m"))
                       for t, m in enumerate(masks(radius))))
    rows = distinct.select("fp", "n", F.explode(tables).alias("x")).select(
        "x.t", F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp", "n"
    )
    buckets = (
        rows.groupBy("t", "key")
        .agg(F.count("*").alias("members"), F.max(F.struct("n", "fp")).alias("top"))
        .filter("members > 1")
        .select("t", "key", F.col("top.fp").alias("lead"))
    )
    # Stored, so that both sides of the join are plain exchanges and a hot bucket can be split.
    buckets = staged(buckets, "crowds")
    # The planner takes the exploded side for as small as the table it comes from and would
    # broadcast it.
    return rows.hint("merge").join(buckets, ["t", "key"]).select("t", "key", "fp", "lead")


def across(rows: DataFrame, radius: int, cell: int = CELL) -> DataFrame:
    """Pairs of different components ``a, b`` with near members in one bucket.

    ``rows``: ``t, key, fp, component``. Most members of a crowded bucket are of one component, the
    major one. Only the others are compared, with each other and with the major one, in cells of
    about ``cell`` rows on either side.
    """
    sizes = rows.groupBy("t", "key", "component").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("t", "key")
        .agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"),
             F.count("*").alias("parts"))
        .filter("parts > 1")
        .select(
            "t",
            "key",
            F.col("top.component").alias("major"),
            F.ceil(F.col("top.n") / cell).cast("int").alias("majors"),
            F.ceil((F.col("all") - F.col("top.n")) / cell).cast("int").alias("others"),
        )
    )
    inside = rows.join(mixed, ["t", "key"]).withColumn("is_major", F.expr("component = major"))
    block = F.pmod(F.xxhash64("fp"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("others")))
    inside = inside.withColumn("block", block.cast("int"))
    other = inside.filter("NOT is_major")
    columns = ["t", "key", "i", "j", "with_major", "fp", "component"]

    def to_cells(df: DataFrame, i: Column, j: Column, with_major: bool) -> DataFrame:
        return df.withColumn("i", i).withColumn("j", j).select(
            "t", "key", "i", "j", F.lit(with_major).alias("with_major"), "fp", "component"
        )

    def span(start, stop) -> Column:
        return F.explode(F.sequence(start, stop))

    zero = F.lit(0)
    left = to_cells(other, F.col("block"), span(zero, F.col("majors") - 1), True).union(
        to_cells(other, F.col("block"), span(F.col("block"), F.col("others") - 1), False)
    )
    right = to_cells(
        inside.filter("is_major"), span(zero, F.col("others") - 1), F.col("block"), True
    ).union(to_cells(other, span(zero, F.col("block")), F.col("block"), False))
    left = left.select(*columns[:5], F.col("fp").alias("fp_a"), F.col("component").alias("a"))
    right = right.select(*columns[:5], F.col("fp").alias("fp_b"), F.col("component").alias("b"))
    return (
        left.join(right, columns[:5])
        .filter((F.col("a") != F.col("b")) & near(F.col("fp_a"), F.col("fp_b"), radius))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root`` of every fingerprint with a neighbour within ``radius``; others are left out."""
    buckets = staged(crowded(distinct, radius), "buckets")
    stars = buckets.filter((F.col("fp") != F.col("lead")) & near(F.col("fp"), F.col("lead"), radius))
    first = staged(
        components(stars.select(F.col("lead").alias("a"), F.col("fp").alias("b"))), "stars"
    )
    labelled = buckets.join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "t", "key", "fp", F.coalesce("component", "fp").alias("component")
    )
    second = components(across(labelled, radius)).select(
        F.col("node").alias("component"), F.col("component").alias("root")
    )
    members = first.union(
        second.select("component", "component")  # single fingerprints that only now found a link
    ).distinct()
    return (
        members.toDF("fp", "component")
        .join(second, "component", "left")
        .select("fp", F.coalesce("root", "component").alias("root"))
        .distinct()
    )


def grouped_prints(documents: DataFrame, size: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``doc_id, fp`` of every row, and ``fp, component_id, root`` of every fingerprint."""
    prints = staged(fingerprints(documents, size), "fingerprints")
    distinct = staged(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct"
    )
    linked = staged(linked_fingerprints(distinct.select("fp", "n"), radius), "linked")
    named = (
        distinct.join(linked, "fp")
        .groupBy("root")
        .agg(F.min("least").alias("component_id"))
        .join(linked, "root")
        .select("fp", "component_id", "root")
    )
    ids = distinct.join(named, "fp", "left").select(
        "fp",
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    return prints, ids


def near_copies(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing
    bits. Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows stay
    repeated; a null doc_id never names a component, so it is null where no row of the component
    has an id. Other columns are not read.
    """
    prints, ids = grouped_prints(documents, size, radius)
    ids = staged(ids, "groups")  # both sides plain exchanges: a hot fingerprint can be split
    return prints.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents`` that stand for their group: its smallest doc_id, once.

    A row without doc_id stays only if no row of its group has one, and then one per group. All
    columns stay as they are. Only ids that occur more than once go through a second grouping, by id and group,
    since their texts may be of different groups.
    """
    prints, ids = grouped_prints(documents, size, radius)
    ids = staged(ids, "groups")
    rows, fp, root, least = (unused(documents, name) for name in ("_rows", "_fp", "_root", "_least"))
    stands = F.coalesce(F.bool_or(F.expr("doc_id = component_id")), F.lit(False))
    kept = prints.join(ids, "fp").groupBy("doc_id").agg(F.count("*").alias(rows), stands.alias(fp))
    kept = staged(kept.filter(F.col(fp)).drop(fp), "representatives")
    # Merged whatever the size, so that a small run has the plan of a large one.
    chosen = documents.hint("merge").join(kept, "doc_id")
    single = chosen.filter(F.col(rows) == 1).select(*documents.columns)

    @F.pandas_udf("bigint")
    def print_of(texts):
        return texts.map(lambda t: signed(fingerprint(t or "", size)))

    groups = ids.select(
        F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(least)
    )
    repeated = (
        chosen.filter(F.col(rows) > 1)
        .withColumn(fp, print_of("text"))
        .join(groups, fp)
        .filter(F.col("doc_id") == F.col(least))
        .dropDuplicates(["doc_id", root])
        .select(*documents.columns)
    )
    nameless = (
        documents.filter("doc_id IS NULL")
        .withColumn(fp, print_of("text"))
        .join(groups.filter(F.col(least).isNull()), fp)
        .dropDuplicates([root])
        .select(*documents.columns)
    )
    return single.unionByName(repeated).unionByName(nameless)
