"""Deciding for every row whether it is ingested, a duplicate, quarantined or empty."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.injection import with_injection_score
from quillvault.functions.pii import pseudonymise
from quillvault.functions.text import is_blank, with_content_hash
from quillvault.operators.bits import bit_maps, key_filter, marked, may_be_in
from quillvault.plans.joins import BROADCAST_ROWS, HOT_ROWS, attach, fits
from quillvault.sources.shared import staged


def prepared(
    df: DataFrame,
    text: str,
    threshold: float,
    categories: Sequence[str] = fv.PII_PRIORITY,
    entities: str | None = None,
) -> DataFrame:
    """Hash the raw text, pseudonymise it, score the result; ``passing`` rows may be stored.

    One pass over the rows without a shuffle. A text yields no chunk exactly when nothing is left
    of it after stripping, so emptiness is known before any chunking.
    """
    df = with_content_hash(df, text)
    df = pseudonymise(df, text, categories=categories, entities=entities)
    df = with_injection_score(df, "text_pseudo")
    return df.withColumn("is_empty", is_blank(F.col("text_pseudo"))).withColumn(
        "passing", (F.col("score") < threshold) & ~F.col("is_empty")
    )


#: Finds stored content hashes that those of a table (``doc_sha256``) may be among; None: none are.
Known = Callable[[DataFrame], DataFrame | None]


def copies(
    rows: DataFrame,
    order: str = "ord",
    known: Known | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``_place`` of the rows that are copies of a passing row before them or of a stored one.

    Copies of quarantined or empty rows are therefore not duplicates. "Before" needs only the
    smallest passing ``order`` per hash, which partial aggregation finds without bringing the
    copies of a text together. Hashes that come once, by a filter of fixed size, are not
    even looked at; of the rest no more than order and hash is shuffled. ``rows`` (``_place``,
    ``order``, ``doc_sha256``, ``passing``) is read more than once: pass a staged table.
    """
    narrow = rows.select("_place", order, "doc_sha256", "passing")
    numbers = narrow.groupBy(F.xxhash64("doc_sha256").alias("_k")).agg(F.count("*").alias("_n"))
    several = key_filter(numbers.filter("_n > 1"), "_k")
    hashed = narrow.withColumn("_k", F.xxhash64("doc_sha256"))
    suspects = staged(may_be_in(hashed, "_k", several).drop("_k"), "suspects")
    first = suspects.groupBy("doc_sha256").agg(
        F.min(F.when(F.col("passing"), F.col(order))).alias("_first"),
        F.count("*").alias("_rows"),
    )
    first = staged(first.filter((F.col("_rows") > 1) & F.col("_first").isNotNull()), "repeats")
    limits = {"how": "inner", "broadcast_rows": broadcast_rows, "hot_rows": hot_rows}
    found = attach(suspects, first, "doc_sha256", weight="_rows", tie=order, **limits)
    found = found.filter(F.col("_first") < F.col(order)).select("_place")
    stored = known(narrow) if known else None
    if stored is None:
        return found
    hits = staged(stored_keys(narrow, stored, "doc_sha256", broadcast_rows), "stored")
    if hits.isEmpty():
        return found
    held = may_be_in(narrow, "doc_sha256", key_filter(hits, "doc_sha256"))
    held = attach(held, hits, "doc_sha256", weight="_rows", tie=order, **limits)
    return found.unionByName(held.select("_place"))


def with_status(rows: DataFrame, marks: DataFrame, threshold: float, **limits) -> DataFrame:
    """Add ``status`` to prepared rows with a ``_place``; ``marks`` is the stored set of copies.

    Every row gets its status where it is: only the set goes to the tasks.
    """
    status = (
        F.when(F.col("_copy"), "duplicate")
        .when(F.col("score") >= threshold, "quarantined")
        .when(F.col("is_empty"), "empty")
        .otherwise("ingested")
    )
    return marked(rows, marks, "_place", "_copy", **limits).withColumn("status", status).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows with ``_place``: numbers that rise within a task. They last once the rows are stored."""
    return rows.withColumn("_place", F.monotonically_increasing_id())


def statuses(
    rows: DataFrame,
    threshold: float,
    order: str = "ord",
    known: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    **limits,
) -> DataFrame:
    """Add ``status`` to prepared rows."""
    rows = staged(placed(rows), "placed")
    look_up = None if known is None else lambda _: known
    found = copies(rows, order, look_up, broadcast_rows, hot_rows)
    marks = staged(bit_maps(found, "_place"), "marks")
    return with_status(rows, marks, threshold, **limits).drop("_place")


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The smallest ``order`` per key and the number of rows, without gathering the rows."""
    return rows.groupBy(key).agg(F.min(order).alias(order), F.count("*").alias("copies"))


def stored_keys(
    rows: DataFrame, known: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Keys of ``rows`` that occur in ``known``, with their number of rows.

    A batch with few keys is looked up by scanning the known keys once without a shuffle.
    """
    keys = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    if fits(keys, broadcast_rows):
        hits = known.select(key).join(F.broadcast(keys.select(key)), key, "left_semi").distinct()
        found = keys.join(F.broadcast(hits), key, "left_semi")
    else:
        found = keys.join(known.select(key), key, "left_semi")
    return found.withColumn("_hit", F.lit(True))


def new_rows(rows: DataFrame, known: DataFrame, tie: str, key: str = "doc_sha256") -> DataFrame:
    """Rows whose key is not stored yet."""
    seen = stored_keys(rows, known, key)
    flagged = attach(rows, seen, key, weight="_rows", tie=tie)
    return flagged.filter(F.col("_hit").isNull()).drop("_hit")


def status_rollup(rows: DataFrame, chunks: str = "n_chunks") -> DataFrame:
    """Rows and chunks per status, zero for statuses that do not occur."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(s,) for s in fv.STATUSES], "status string")
    counted = rows.groupBy("status").agg(
        F.count("*").alias("n_docs"), F.sum(F.col(chunks)).cast("long").alias("n_chunks")
    )
    return every.join(F.broadcast(counted), "status", "left").select(
        "status",
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
    )


def log_detail(
    status: Column, source_ref: Column, n_chunks: Column, score: Column, reasons: Column
) -> Column:
    """Detail text of a log row; null for statuses that are not logged."""
    return (
        F.when(
            status == "ingested",
            F.format_string("%d chunks (%s)", n_chunks.cast("long"), source_ref),
        )
        .when(status == "duplicate", F.format_string("doublon ignoré (%s)", source_ref))
        .when(
            status == "quarantined",
            F.format_string("score=%.2f motifs=%s", score, F.array_join(reasons, ",")),
        )
    )


def log_operation(status: Column) -> Column:
    return (
        F.when(status == "ingested", "ingest")
        .when(status == "duplicate", "dedup")
        .when(status == "quarantined", "quarantine")
    )
