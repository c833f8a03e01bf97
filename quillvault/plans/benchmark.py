"""Comparing chunk sizes: the corpus is prepared once, cut into chunks of all sizes, and asked once."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault.functions.barrier import settled
from quillvault.functions.chunking import recursive_chunks
from quillvault.functions.embedding import Embedder, embed_questions
from quillvault.functions.integrity import decrypt
from quillvault.operators.evaluation import bench_sizes, hit_rates, hit_report, truth_questions
from quillvault.operators.journal import as_lines, ingest_events
from quillvault.operators.retrieval import nearest_chunks
from quillvault.plans.answer import chunk_key
from quillvault.plans.ingest import Keys, Splitter, routed_batch, sealed_chunks
from quillvault.settings import Settings
from quillvault.sources.events import write_events
from quillvault.sources.shared import scratch, staged
from quillvault.sources.store import TABLES

MEASURES = "chunk_size int, documents bigint, chunks bigint, ingest_s double, mean_search_s double"
REPORT = (
    "pos int, chunk_size int, questions bigint, hits bigint, hit_rate double, "
    "mean_hit_similarity double"
)


def sized_chunks(
    documents: DataFrame, sizes: Sequence[int], overlap: int, splitter: Splitter
) -> DataFrame:
    """``chunk_size, doc_sha256, chunk_index, content``: the chunks of all sizes, in one pass."""
    documents = settled(documents.select("doc_sha256", "_text"), "_text")

    def pieces_of(size: int) -> Column:
        """An error that a splitter reports is a chunk without content, which no model embeds."""
        cut = splitter(F.col("_text"), size, overlap)
        if not isinstance(documents.select(cut.alias("p")).schema["p"].dataType, T.StructType):
            return cut
        none = F.array(F.lit(None).cast("string"))
        return F.when(cut["error"].isNotNull(), none).otherwise(cut["value"])

    cut = F.array(
        *(
            F.struct(
                F.lit(size).alias("chunk_size"), pieces_of(size).alias("_pieces")
            )
            for size in sizes
        )
    )
    by_size = documents.select("doc_sha256", F.inline(cut))
    pieces = by_size.select(
        "chunk_size", "doc_sha256", F.posexplode_outer("_pieces").alias("chunk_index", "content")
    )
    return pieces.filter(F.col("chunk_index").isNotNull())


def read_sized_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of a benchmark with their ``chunk_size``, which is the name of their folder."""
    schema = f"{TABLES['chunks']}, chunk_size int"
    return spark.read.schema(schema).parquet(f"{folder}/chunks")


def benchmark_sizes(
    rows: DataFrame,
    questions: DataFrame,
    folder: str,
    keys: Keys,
    model: Embedder,
    sizes: Sequence[int],
    settings: Settings = Settings(),
    splitter: Splitter = recursive_chunks,
    *,
    names: DataFrame | None,
    journal: str | None = None,
) -> DataFrame:
    """One row per size above the overlap, in the given order: what was stored, times and hits.

    ``questions`` has ``question_id, question, doc_sha256``: the content hash of the document each
    one is about. Questions whose document a size did not ingest are not asked there; a question
    counts as a hit if a chunk of its document is among the ``top_k`` nearest of the size.

    Hashing, masking, scoring and routing do not depend on the size and happen once; then one pass
    cuts, embeds and stores the chunks of all sizes below ``folder``, and one search asks all of them.
    ``ingest_s`` is the time of the preparation and the size's share, by characters, of the pass;
    ``mean_search_s`` the size's share, by chunks, of the time of the search, per question.
    """
    spark = rows.sparkSession
    wanted = bench_sizes(spark, sizes, settings.chunk_overlap).orderBy("pos").collect()  # a handful
    if not wanted:
        raise ValueError("no chunk size above the overlap")
    chosen = [r["chunk_size"] for r in wanted]

    def note(event: str, **detail) -> None:
        if journal:
            row = [(event, "INFO", json.dumps(detail))]
            rows_ = spark.createDataFrame(row, "event string, level string, detail string")
            write_events(as_lines(rows_, "benchmark"), journal)

    with scratch(spark):
        for size in chosen:
            note("bench_size_start", chunk_size=size)
        began = time.monotonic()
        stamped = rows.withColumn("_at", F.current_timestamp())
        routed = routed_batch(stamped, keys, settings, names)
        accepted = routed.filter(F.col("status") == "ingested")
        prepared = time.monotonic()
        texts = accepted.select(
            "doc_sha256", decrypt(spark, F.col("content_enc"), keys.cipher).alias("_text")
        )
        pieces = sized_chunks(texts, sorted(set(chosen)), settings.chunk_overlap, splitter)
        sealed = sealed_chunks(
            pieces, model, keys, replace(settings, chunk_size=max(chosen)), "chunk_size"
        )
        sealed.write.partitionBy("chunk_size").parquet(f"{folder}/chunks")
        stored = time.monotonic()
        chunks = read_sized_chunks(spark, folder)
        # A document with a chunk that the model failed on is left out of that size as a whole.
        documents = staged(
            chunks.groupBy("chunk_size", "doc_sha256").agg(
                F.count("*").alias("n_chunks"),
                F.sum(F.length("content_enc")).alias("length"),
                F.max(F.col("embedding").isNull()).alias("failed"),
            ),
            "sizes",
        )
        if journal:
            # What is ingested is told per size, below.
            others = routed.drop("content_enc").filter(F.col("status") != "ingested")
            others = others.withColumn("n_chunks", F.lit(0).cast("long"))
            write_events(as_lines(ingest_events(others), "benchmark"), journal)
        sound = documents.filter(~F.col("failed"))
        if not documents.filter("failed").isEmpty():
            chunks = chunks.join(
                documents.filter("failed"), ["chunk_size", "doc_sha256"], "left_anti"
            )
        asked = staged(
            truth_questions(questions, sound, order="question_id").select(
                "question_id",
                "doc_sha256",
                embed_questions(F.col("question"), model, settings.embed_dim).alias("embedding"),
            ),
            "asked",
        )
        vectors = chunks.select(
            chunk_key(F.col("doc_sha256"), F.col("chunk_index")).alias("chunk_id"),
            "embedding",
            "chunk_size",
        )
        searching = time.monotonic()
        found = staged(nearest_chunks(asked, vectors, settings.top_k, within="chunk_size"), "found")
        searched = time.monotonic() - searching
        found = found.select(
            "question_id",
            F.substring_index("chunk_id", ":", 1).alias("doc_sha256"),
            "similarity",
            "chunk_size",
        )
        asked_by_size = asked.select("question_id", "doc_sha256").join(
            sound.select("chunk_size", "doc_sha256"), "doc_sha256"
        )
        places = spark.createDataFrame([(r["pos"], r["chunk_size"]) for r in wanted], "pos int, chunk_size int")
        report = hit_report(places, hit_rates(asked_by_size, found)).collect()  # a row per size
        counted = sound.groupBy("chunk_size").agg(
            F.count("*"), F.sum("n_chunks"), F.sum("length")
        )
        held = {r[0]: tuple(r[1:]) for r in counted.collect()}
    lengths = max(1, sum(n[2] for n in held.values()))
    compared = max(1, sum(n[1] for n in held.values()))
    measures = []
    for row in report:
        size = row["chunk_size"]
        n_documents, n_chunks, length = held.get(size, (0, 0, 0))
        cut_s = (stored - prepared) * length / lengths
        search_s = searched * n_chunks / compared / max(1, row["questions"])
        measures.append(
            (size, n_documents, n_chunks, round(prepared - began + cut_s, 3), round(search_s, 6))
        )
        note("bench_size_done", chunk_size=size, documents=n_documents, chunks=n_chunks)
    rates = spark.createDataFrame([tuple(r) for r in report], REPORT)
    taken = spark.createDataFrame(sorted(set(measures)), MEASURES)
    return rates.join(F.broadcast(taken), "chunk_size")  # a handful of rows
