"""Corpus input: JSON lines, seeded samples and extracts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv
from quillvault.functions.text import source_ref
from quillvault.plans.joins import fits
from quillvault.sources.shared import staged

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their 0-based number, counted across files in path order.

    Each file block counts its own lines; the running total over blocks (one row per block, not
    per line) turns a place within a block into a line number.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    )
    blocks = lines.groupBy("_file", "_block").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_lines")
    )
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    offsets = blocks.select("_file", "_block", (F.col("_before") - F.col("_first")).alias("_shift"))
    if fits(offsets):
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["_file", "_block"]).select(
        "line", (F.col("_place") + F.col("_shift")).alias("line_number")
    )


def read_corpus(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CORPUS_SCHEMA,
    prefix: str = fv.SOURCE_PREFIX,
    ids_given: bool = False,
) -> DataFrame:
    """Corpus rows with ``source_id``, ``source_ref`` and ``ord``; extra schema columns are kept.

    Blank lines are skipped, a malformed line or a missing ``context`` fails the job, and a
    missing ``source_id`` becomes ``line<n>`` with n counting blank lines too. ``ids_given``
    promises that every row has an id, which spares the line numbering; ``ord`` is then a number
    that follows file order.
    """
    if ids_given:
        lines = spark.read.text(path).select(
            F.col("value").alias("line"), F.monotonically_increasing_id().alias("line_number")
        )
    else:
        lines = numbered_lines(spark, path)
    rows = lines.filter(F.trim(F.regexp_replace("line", rf"[{fv.WS}]", " ")) != "").select(
        "line_number",
        F.from_json("line", schema, {"mode": "FAILFAST"}).alias("row"),
    )
    context = F.when(F.col("row.context").isNotNull(), F.col("row.context")).otherwise(
        F.raise_error(
            F.concat(F.lit("missing context on line "), (F.col("line_number") + 1).cast("string"))
        )
    )
    source_id = F.coalesce(
        F.col("row.source_id"), F.concat(F.lit("line"), F.col("line_number").cast("string"))
    )
    others = [f"row.{n}" for n in schema.fieldNames() if n not in ("source_id", "context")]
    return rows.select(
        F.col("line_number").alias("ord"),
        source_id.alias("source_id"),
        source_ref(source_id, prefix).alias("source_ref"),
        context.alias("context"),
        *others,
    )


def shuffle_key(seed: int, identifier: Column) -> Column:
    """A pseudo-random order that depends on the seed and the id only, not on partitioning."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), identifier.cast("string")), 256)


def smallest_keys(keyed: DataFrame, key: str, n: int) -> DataFrame:
    """Rows among which the ``n`` smallest keys are; keys are evenly spread hexadecimal digests.

    A key below the share that ``n`` has of all rows, with room of several standard deviations, is
    kept; in the one case in millions that too few are, all rows are.
    """
    rows = keyed.count()
    room = n + 8 * math.isqrt(n) + 16
    if room >= rows:
        return keyed
    few = staged(keyed.filter(F.col(key) < f"{room * 16**15 // rows:015x}"), "smallest")
    return few if few.count() >= n else keyed


def seeded_sample(df: DataFrame, identifier: str, n: int, seed: int) -> DataFrame:
    """The first ``n`` rows in seeded order, with their 0-based place as ``sample_ord``.

    ``identifier`` is unique. A threshold leaves little more than the rows wanted; a distributed sort
    of their ids numbers them, and the rows then join the ids chosen, so no full row is sorted.
    """
    key = shuffle_key(seed, F.col(identifier))
    keyed = smallest_keys(df.select(identifier, key.alias("_key")), "_key", n)
    ordered = staged(
        keyed.orderBy("_key", identifier).select(
            identifier,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "order",
    )
    parts = ordered.groupBy("_part").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    shift = parts.select("_part", (F.col("_before") - F.col("_first")).alias("_shift"))
    places = ordered.join(F.broadcast(shift), "_part").select(  # one row per sort partition
        identifier, (F.col("_place") + F.col("_shift")).alias("sample_ord")
    )
    return df.join(places.filter(F.col("sample_ord") < n), identifier)


def write_extract(df: DataFrame, path: str, n: int, seed: int, identifier: str) -> None:
    """Write ``n`` seeded rows of ``context, question, answer`` as JSON lines with fresh ids."""
    missing = {"context", "question", "answer"} - set(df.columns)
    if missing:
        raise ValueError(f"columns missing from the source: {sorted(missing)}")
    sample = seeded_sample(df, identifier, n, seed)
    sample.select(
        F.col("sample_ord").cast("string").alias("source_id"), "context", "question", "answer"
    ).write.json(path)
