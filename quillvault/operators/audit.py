"""Read-only reports over stored tables and the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.integrity import decrypt, seal, seal_matches


def pii_totals(documents: DataFrame) -> DataFrame:
    """Occurrences per category over all documents, by category."""
    return (
        documents.select(F.explode("pii_stats").alias("category", "n"))
        .groupBy("category")
        .agg(F.sum("n").cast("long").alias("total"))
        .orderBy("category")
    )


def corpus_overview(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count("*").alias("documents"), F.max("ingested_at").alias("last_ingested_at")
    )


def latest(rows: DataFrame, by: str, limit: int = 20, tie: str | None = None) -> DataFrame:
    """The newest rows of a log."""
    return rows.orderBy(F.desc(by), *([F.desc(tie)] if tie else [])).limit(limit)


def log_tail(events: DataFrame, order: str, lines: int = fv.EVENT_LOG_TAIL) -> DataFrame:
    """The last lines of a log; ``order`` increases from line to line."""
    return events.orderBy(F.desc(order)).limit(lines)


def alert_counters(events: DataFrame, names: tuple[str, ...] = fv.ALERT_EVENTS) -> DataFrame:
    """Events per alert name, zero for names that do not occur."""
    every = events.sparkSession.createDataFrame([(n,) for n in names], "event string")
    counted = (
        events.filter(F.col("event").isin(*names)).groupBy("event").agg(F.count("*").alias("n"))
    )
    return every.join(F.broadcast(counted), "event", "left").select(
        "event", F.coalesce("n", F.lit(0)).alias("n")
    )


def recent_queries(events: DataFrame, order: str = "ts", limit: int = 10) -> DataFrame:
    """The newest finished queries with the figures of their detail object."""
    detail = F.col("detail")
    return (
        events.filter(F.col("event") == "query_done")
        .orderBy(F.desc(order))
        .limit(limit)
        .select(
            "ts",
            "request_id",
            detail["mode"].alias("mode"),
            detail["n_chunks"].try_cast("int").alias("n_chunks"),
            detail["duration_s"].try_cast("double").alias("duration_s"),
        )
    )


def by_request(events: DataFrame, security: tuple[str, ...] = fv.SECURITY_EVENTS) -> DataFrame:
    """One row per request: when it started and ended, and its security events."""
    return (
        events.filter(F.col("request_id").isNotNull())
        .groupBy("request_id")
        .agg(
            F.min(F.when(F.col("event") == "query_start", F.col("ts"))).alias("started"),
            F.max(F.when(F.col("event") == "query_done", F.col("ts"))).alias("done"),
            F.count_if(F.col("event").isin(*security)).alias("security_events"),
            F.count("*").alias("events"),
        )
    )


def with_seal_check(
    chunks: DataFrame, seal_key: bytes, cipher_key: str, out: str = "seal_ok"
) -> DataFrame:
    """Decrypt stored chunks and recompute their seals; adds ``content`` and ``out``."""
    spark = chunks.sparkSession
    opened = chunks.withColumn("content", decrypt(spark, F.col("content_enc"), cipher_key))
    computed = seal(
        spark,
        F.col("content"),
        F.col("doc_sha256"),
        F.col("chunk_index"),
        F.col("embedding"),
        seal_key,
    )
    return opened.withColumn(out, seal_matches(computed, F.col("chunk_hmac")))


def integrity_report(chunks: DataFrame, seal_key: bytes, cipher_key: str) -> DataFrame:
    """Chunks and broken seals per document."""
    checked = with_seal_check(chunks, seal_key, cipher_key)
    return (
        checked.groupBy("doc_sha256")
        .agg(
            F.min("document_id").alias("document_id"),
            F.count("*").alias("n_chunks"),
            F.count_if(~F.col("seal_ok")).alias("n_broken"),
        )
        .drop("doc_sha256")
    )
