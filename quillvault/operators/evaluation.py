"""Retrieval quality per chunk size, and side-by-side answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.text import strip


def bench_sizes(spark: SparkSession, sizes: Sequence[int], overlap: int) -> DataFrame:
    """Chunk sizes worth comparing, with their place in the given order."""
    rows = spark.createDataFrame(list(enumerate(sizes)), "pos int, chunk_size int")
    return rows.filter(F.col("chunk_size") > overlap)


def truth_questions(
    candidates: DataFrame, ingested: DataFrame, n: int | None = None, order: str = "ord"
) -> DataFrame:
    """Questions that are not blank and whose document was ingested; the first ``n`` in order.

    ``candidates`` has ``question, doc_sha256`` and the order column.
    """
    asked = candidates.filter(strip(F.col("question")) != "").join(
        ingested.select("doc_sha256"), "doc_sha256", "left_semi"
    )
    return asked if n is None else asked.orderBy(order).limit(n)


def hit_rates(questions: DataFrame, found: DataFrame, by: str = "chunk_size") -> DataFrame:
    """Share of questions whose own document is among the chunks found, per value of ``by``.

    ``questions`` has ``question_id, doc_sha256`` and ``by``; ``found`` has ``question_id,
    doc_sha256, similarity`` and ``by``. The similarity of a hit is that of its best chunk.
    """
    hits = (
        found.join(questions.select("question_id", "doc_sha256", by), ["question_id", "doc_sha256", by])
        .groupBy("question_id", by)
        .agg(F.max("similarity").alias("best"))
    )
    return (
        questions.join(hits, ["question_id", by], "left")
        .groupBy(by)
        .agg(
            F.count("*").alias("questions"),
            F.count("best").alias("hits"),
            F.round(F.count("best") / F.count("*"), 3).alias("hit_rate"),
            F.round(F.avg("best"), 4).alias("mean_hit_similarity"),
        )
    )


def hit_report(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per size, with zeros where no question was asked."""
    zero = F.lit(0).cast("long")
    return sizes.join(F.broadcast(rates), "chunk_size", "left").select(
        "pos",
        "chunk_size",
        F.coalesce("questions", zero).alias("questions"),
        F.coalesce("hits", zero).alias("hits"),
        F.coalesce("hit_rate", F.lit(0.0)).alias("hit_rate"),
        "mean_hit_similarity",
    )


def best_size(report: DataFrame) -> DataFrame:
    """The size with the highest hit rate; the first one given wins a tie."""
    return report.agg(
        F.max_by("chunk_size", F.struct(F.col("hit_rate"), -F.col("pos"))).alias("chunk_size"),
        F.max("hit_rate").alias("hit_rate"),
    )


def mean_durations(metrics: DataFrame, duration: str, *by: str) -> DataFrame:
    return metrics.groupBy(*by).agg(
        F.count("*").alias("queries"), F.round(F.avg(duration), 1).alias("mean_duration")
    )


def paired_answers(with_context: DataFrame, without: DataFrame) -> DataFrame:
    """Each question once, with the answer given with context and the one given without.

    ``with_context`` has ``question_id, question, truth, answer, sources, context_used`` and
    ``without`` has ``question_id, answer``; ``sources`` is an array of references.
    """
    listed = F.when(F.size("sources") > 0, F.array_join("sources", ", ")).otherwise(fv.NO_SOURCES)
    return with_context.select(
        "question_id",
        "question",
        "truth",
        F.col("answer").alias("answer_with_context"),
        "context_used",
        listed.alias("sources"),
    ).join(
        without.select("question_id", F.col("answer").alias("answer_without")), "question_id"
    )
