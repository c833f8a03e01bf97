"""Validation of question requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault import fixed_values as fv

FIELDS = ("question", "mode", "k")


def unknown_fields(body: Column) -> Column:
    """Keys of a JSON object that a request may not carry."""
    return F.array_except(F.json_object_keys(body), F.array(*[F.lit(f) for f in FIELDS]))


def validated(questions: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the first rule a request breaks, or null for a valid one.

    ``questions`` has ``question, mode, k``; a null mode or k takes its default. A ``body`` column
    with the JSON as received must hold an object, without unknown fields.
    """
    length = F.length("question")
    rules = [
        (F.col("question").isNull() | (length < fv.QUESTION_LENGTH[0]), "question_empty"),
        (length > fv.QUESTION_LENGTH[1], "question_too_long"),
        (~F.coalesce("mode", F.lit("rag")).isin(*fv.QUESTION_MODES), "mode_unknown"),
        (F.col("k").isNotNull() & ~F.col("k").between(*fv.QUESTION_K), "k_out_of_range"),
    ]
    if "body" in questions.columns:
        unknown = unknown_fields(F.col("body"))
        rules.insert(0, (unknown.isNull(), "body_malformed"))
        rules.append((F.size(unknown) > 0, "unknown_field"))
    reason = F.lit(None).cast("string")
    for broken, name in reversed(rules):
        reason = F.when(broken, name).otherwise(reason)
    return questions.withColumn("reject_reason", reason)


def effective_k(k: Column, default: int) -> Column:
    """Null and zero both mean the default."""
    return F.coalesce(F.nullif(k, F.lit(0)), F.lit(default))
