"""From a table of questions to hardened prompts, and from answers to safe answers."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault.functions.embedding import Embedder, embed_questions
from quillvault.functions.pii import filter_answers
from quillvault.operators.audit import with_seal_check
from quillvault.operators.bits import key_filter, may_be_in
from quillvault.operators.journal import (
    answer_events,
    as_lines,
    mismatch_events,
    retrieval_events,
)
from quillvault.operators.requests import effective_k, validated
from quillvault.operators.retrieval import (
    above_threshold,
    allowed_sources,
    nearest_chunks,
    prompts,
    ranked,
    require_one_space,
    retrieval_outcome,
    source_lists,
    space_verdict,
)
from quillvault.plans.ingest import Keys
from quillvault.plans.joins import fits
from quillvault.settings import Settings
from quillvault.sources.events import write_events
from quillvault.sources.shared import staged
from quillvault.sources.store import Store


#: Chunks up to this number are fetched by their hashes; more are joined without a pushed filter.
PUSHED_HASHES = 5_000


def chunk_key(doc_sha256: Column, chunk_index: Column) -> Column:
    """Order-preserving identity of a chunk."""
    return F.concat_ws(":", doc_sha256, F.lpad(chunk_index.cast("string"), 9, "0"))


@dataclass(frozen=True)
class Retrieved:
    context: DataFrame  # valid chunks with their content, at most k per question
    outcome: DataFrame  # per question: found, kept, best similarity, event
    broken: DataFrame  # chunks dropped because their seal does not match
    refused: DataFrame  # questions the model gave no usable vector for


def retrieve(
    questions: DataFrame,
    store: Store,
    keys: Keys,
    model: Embedder,
    settings: Settings = Settings(),
    journal: str | None = None,
) -> Retrieved:
    """Top-k, then threshold, then seal check; dropped chunks are not replaced.

    ``questions`` has ``question_id, question`` and optionally ``k`` and ``mode``; a question with
    mode ``no-rag`` is asked without context and searches nothing. Ranking reads vectors only; texts
    are fetched and decrypted for the chunks that survive the threshold. Questions without a usable
    vector are ``refused``. With ``journal`` the events of all questions are appended to that log.
    """
    began = time.monotonic()
    spark = questions.sparkSession
    chunks = store.visible_chunks()
    verdict = space_verdict(chunks, settings.embed_model_tag)
    try:
        searchable = require_one_space(verdict)
    except ValueError:
        if journal:
            write_events(as_lines(mismatch_events(verdict, settings.embed_model_tag), "query"), journal)
        raise
    k_column = (
        effective_k(F.col("k"), settings.top_k)
        if "k" in questions.columns
        else F.lit(settings.top_k)
    )
    mode = F.coalesce("mode", F.lit("rag")) if "mode" in questions.columns else F.lit("rag")
    asked = staged(
        questions.select(
            "question_id",
            mode.alias("mode"),
            k_column.cast("int").alias("k"),
            embed_questions(F.col("question"), model, settings.embed_dim).alias("embedding"),
        ),
        "questions",
    )
    searching = asked.filter((F.col("mode") != "no-rag") & F.col("embedding").isNotNull())
    refused = asked.filter((F.col("mode") != "no-rag") & F.col("embedding").isNull())
    if searchable:
        largest = asked.agg(F.coalesce(F.max("k"), F.lit(settings.top_k))).first()[0]
        vectors = chunks.select(
            chunk_key(F.col("doc_sha256"), F.col("chunk_index")).alias("chunk_id"), "embedding"
        )
        found = nearest_chunks(searching.select("question_id", "embedding"), vectors, largest)
        found = found.join(asked.select("question_id", "k"), "question_id").filter(
            F.col("rank") <= F.col("k")
        )
        found = staged(found.drop("k"), "found")
    else:
        found = spark.createDataFrame(
            [], "question_id bigint, chunk_id string, similarity double, rank int"
        )
    opened = _opened(above_threshold(found, settings.sim_threshold), store, chunks, keys)
    broken = opened.filter(~F.col("seal_ok")).drop("seal_ok", "content")
    outcome = retrieval_outcome(
        asked.join(refused.select("question_id"), "question_id", "left_anti"),
        found,
        settings.sim_threshold,
        broken,
    ).join(asked.select("question_id", "mode", "k"), "question_id")
    # Nothing is looked for without context, so nothing can be missing.
    outcome = outcome.withColumn(
        "event", F.when(F.col("mode") != "no-rag", F.col("event"))
    )
    if journal:
        seconds = round(time.monotonic() - began, 3)
        events = retrieval_events(outcome, broken, settings.sim_threshold, duration_s=seconds)
        write_events(as_lines(events, "query", F.col("question_id")), journal)
    return Retrieved(
        opened.filter("seal_ok").drop("seal_ok"), outcome, broken, refused.drop("embedding")
    )


def _opened(kept: DataFrame, store: Store, chunks: DataFrame, keys: Keys) -> DataFrame:
    """The kept chunks with source, text and seal check.

    Stored chunks are joined on their own columns. A filter of the hashes, of fixed size, goes to the
    scan first, so that encrypted texts that are not asked for are never moved. Few hashes are pushed
    into the scan instead; chunks are stored in order of their hash, so most row groups are skipped.
    """
    kept = kept.withColumns(
        {
            "doc_sha256": F.substring_index("chunk_id", ":", 1),
            "chunk_index": F.substring_index("chunk_id", ":", -1).cast("int"),
        }
    )
    documents = store.read("documents").select("doc_sha256", "source_ref")
    if fits(kept, PUSHED_HASHES):
        hashes = [r[0] for r in kept.select("doc_sha256").distinct().collect()]
        chunks = chunks.filter(F.col("doc_sha256").isin(hashes))
        documents = documents.filter(F.col("doc_sha256").isin(hashes))
        kept = F.broadcast(kept)
    else:
        maps = staged(key_filter(kept, "doc_sha256"), "asked_for")
        chunks = may_be_in(chunks, "doc_sha256", maps)
        documents = may_be_in(documents, "doc_sha256", maps)
    opened = with_seal_check(
        chunks.drop("batch").join(kept, ["doc_sha256", "chunk_index"]), keys.seal, keys.cipher
    )
    return opened.join(documents, "doc_sha256").select(
        "question_id",
        "chunk_id",
        "similarity",
        "rank",
        "source_ref",
        "content",
        "doc_sha256",
        "chunk_index",
        "seal_ok",
    )


def build_prompts(questions: DataFrame, context: DataFrame) -> DataFrame:
    """Messages, source list and allowed sources for every question."""
    return (
        prompts(questions, context)
        .join(source_lists(context), "question_id", "left")
        .join(allowed_sources(context), "question_id", "left")
    )


def safe_answers(
    answers: DataFrame, prompts_table: DataFrame, journal: str | None = None
) -> DataFrame:
    """Filter the answers of a batch of questions (``question_id, answer``).

    An answer whose question is not in the table stays, with no source allowed. With ``journal``
    one event per changed answer is appended to that log.
    """
    allowed = prompts_table.select("question_id", "allowed_sources")
    joined = answers.join(allowed, "question_id", "left")
    safe = filter_answers(joined, "answer", "allowed_sources")
    if journal:
        write_events(as_lines(answer_events(safe), "query", F.col("question_id")), journal)
    return safe


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected requests."""
    checked = validated(requests)
    return (
        checked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        checked.filter(F.col("reject_reason").isNotNull()),
    )


__all__ = [
    "Retrieved",
    "build_prompts",
    "chunk_key",
    "ranked",
    "retrieve",
    "safe_answers",
    "split_requests",
]
