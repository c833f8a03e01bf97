"""Events that a batch of documents or questions leaves in the event log.

Event rows carry ``event, level, detail`` (a JSON object without any text content) and, for
questions, ``request_id``. ``as_lines`` turns them into log lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault.sources.events import event_level


def _event(when: Column, name: str, **detail: Column) -> Column:
    fields = [value.alias(key) for key, value in detail.items()]
    return F.when(
        when, F.struct(F.lit(name).alias("event"), F.to_json(F.struct(*fields)).alias("detail"))
    )


def _spelled(rows: DataFrame, events: list[Column], *keep: str) -> DataFrame:
    out = rows.select(*keep, F.explode(F.array_compact(F.array(*events))).alias("e"))
    level = F.when(F.col("e.event") == "doc_error", "ERROR").otherwise(event_level(F.col("e.event")))
    return out.select(*keep, "e.event", level.alias("level"), "e.detail")


def ingest_events(routed: DataFrame) -> DataFrame:
    """Events per routed document; pseudonymisation is reported for all but duplicates.

    ``error``, where there is such a column, says what a document has failed on.
    """
    status, ref, sha = F.col("status"), F.col("source_ref"), F.col("doc_sha256")
    origin = {"source_ref": ref, "doc_sha256": sha}
    error = F.col("error") if "error" in routed.columns else F.lit("no usable vector")
    return _spelled(
        routed,
        [
            _event(status == "duplicate", "doc_skipped_duplicate", **origin),
            _event(
                (status != "duplicate") & (F.size("pii_stats") > 0),
                "pii_pseudonymized",
                **origin,
                categories=F.col("pii_stats"),
            ),
            _event(
                status == "quarantined",
                "doc_quarantined",
                **origin,
                score=F.round("score", 3),
                reason=F.col("reasons"),
            ),
            _event(status == "empty", "doc_empty", **origin),
            _event(
                status == "ingested",
                "doc_ingested",
                **origin,
                chunks=F.col("n_chunks"),
                pii=F.col("pii_stats"),
            ),
            _event(status == "errors", "doc_error", source_ref=ref, error=error),
        ],
        "source_ref",
    )


def mismatch_events(verdict: DataFrame, configured: str) -> DataFrame:
    """The event for stored vectors that do not come from the configured model."""
    return verdict.select(
        F.lit("model_mismatch").alias("event"),
        event_level(F.lit("model_mismatch")).alias("level"),
        F.to_json(F.struct("models", F.lit(configured).alias("configured"))).alias("detail"),
    )


def retrieval_events(
    outcome: DataFrame, broken: DataFrame, threshold: float, duration_s: float | None = None
) -> DataFrame:
    """Events per question: start, what retrieval ran into, broken seals, end.

    ``outcome`` may carry ``mode`` and ``k``. ``duration_s`` is that of the whole table of questions.
    """
    if "mode" not in outcome.columns:
        outcome = outcome.withColumn("mode", F.lit("rag"))
    if "k" not in outcome.columns:
        outcome = outcome.withColumn("k", F.lit(None).cast("int"))
    mode, taken = F.col("mode"), F.lit(duration_s).cast("double")
    per_question = _spelled(
        outcome.join(
            broken.groupBy("question_id").agg(F.count("*").alias("n_broken")), "question_id", "left"
        ).withColumn("n_valid", F.col("n_kept") - F.coalesce("n_broken", F.lit(0))),
        [
            _event(F.lit(True), "query_start", mode=mode, k=F.col("k")),
            _event(F.col("event") == "empty_store", "empty_store", mode=mode),
            _event(
                F.col("event") == "below_threshold",
                "below_threshold",
                best_similarity=F.col("best_similarity"),
                threshold=F.lit(threshold),
            ),
            _event(
                F.lit(True),
                "query_done",
                mode=mode,
                context_used=F.col("n_valid") > 0,
                n_chunks=F.col("n_valid"),
                duration_s=taken,
            ),
        ],
        "question_id",
    )
    seals = _spelled(
        broken,
        [
            _event(
                F.lit(True),
                "hmac_mismatch",
                chunk_id=F.col("chunk_id"),
                source_ref=F.col("source_ref"),
                chunk_index=F.col("chunk_index"),
                doc_sha256=F.col("doc_sha256"),
            )
        ],
        "question_id",
    )
    return per_question.unionByName(seals)


def answer_events(safe: DataFrame, key: str = "question_id") -> DataFrame:
    """One event per answer that the filter changed, with its counters."""
    changed = _event(
        F.col("has_masking"),
        "output_masked",
        masked=F.col("masked"),
        urls_neutralized=F.col("urls_neutralized"),
        tokens_passed=F.col("tokens_passed"),
    )
    return _spelled(safe, [changed], key)


def as_lines(events: DataFrame, component: str, request_id: Column | None = None) -> DataFrame:
    """Log lines stamped with the current time; ``detail`` is embedded as an object."""
    head = F.to_json(
        F.struct(
            F.date_format(
                F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'",
            ).alias("ts"),
            "level",
            "event",
            F.lit(component).alias("component"),
            *([request_id.cast("string").alias("request_id")] if request_id is not None else []),
        )
    )
    opened = F.substr(head, F.lit(1), F.length(head) - 1)
    return events.select(
        F.concat(opened, F.lit(',"detail":'), F.col("detail"), F.lit("}")).alias("value")
    )
