"""Secure ingest of a whole batch of documents."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault.functions.barrier import exploded, settled
from quillvault.functions.chunking import recursive_chunks
from quillvault.functions.embedding import Embedder
from quillvault.functions.integrity import decrypt, encrypt, seal
from quillvault import fixed_values as fv
from quillvault.operators.bits import bit_maps
from quillvault.operators.gazetteer import with_entities
from quillvault.operators.journal import as_lines, ingest_events
from quillvault.operators.routing import (
    Known,
    copies,
    log_detail,
    log_operation,
    placed,
    prepared,
    status_rollup,
    with_status,
)
from quillvault.settings import Settings
from quillvault.sources.events import write_events
from quillvault.sources.shared import scratch, staged
from quillvault.sources.store import Store

Splitter = Callable[[Column, int, int], Column]
#: What is logged where neither splitter nor model says why a chunk has no vector.
UNUSABLE = "no usable vector"


@dataclass(frozen=True)
class Keys:
    """The two secrets of a store; they must differ."""

    seal: bytes = field(repr=False)
    cipher: str = field(repr=False)

    def __post_init__(self) -> None:
        if not self.seal or not self.cipher:
            raise ValueError("both keys must be given")
        if self.seal == self.cipher.encode("utf-8"):
            raise ValueError("the seal key and the encryption key must differ")


def document_id(doc_sha256: Column) -> Column:
    """A number that depends on the content only; joins use the hash itself as the key."""
    return F.xxhash64(doc_sha256)


def chunk_rows(
    documents: DataFrame, text: Column, settings: Settings, splitter: Splitter = recursive_chunks
) -> DataFrame:
    """One row per chunk, numbered from 0 in text order; a splitter may report an error instead.

    A text whose splitter reports one (``struct<value, error>``) has one row without content.
    """
    # Settled first: decrypting reads its key by a subquery, which no lambda may contain.
    documents = settled(documents.select("doc_sha256", text.alias("_text")), "_text")
    pieces = splitter(F.col("_text"), settings.chunk_size, settings.chunk_overlap)
    if not isinstance(documents.select(pieces.alias("p")).schema["p"].dataType, T.StructType):
        return exploded(documents, pieces, ("chunk_index", "content"), "doc_sha256")
    cut = settled(documents.select("doc_sha256", pieces.alias("_cut")), "_cut")
    none = F.array(F.lit(None).cast("string"))
    found = F.when(F.col("_cut.error").isNotNull(), none).otherwise(F.col("_cut.value"))
    return exploded(
        cut.withColumn("error", F.col("_cut.error")), found, ("chunk_index", "content"), "doc_sha256", "error"
    )


def sealed_chunks(
    chunks: DataFrame, model: Embedder, keys: Keys, settings: Settings, *keep: str
) -> DataFrame:
    """Embed, seal and encrypt chunks; ``error`` says why one has no vector.

    A vector the model failed to give stays null. A model may report its failures
    (``struct<value, error>``); what the splitter has reported goes before.
    """
    spark = chunks.sparkSession
    given = model(F.concat(F.lit(fv.DOCUMENT_PREFIX), F.coalesce("content", F.lit(""))))
    vectors = chunks.withColumn("_given", given)
    reports = isinstance(vectors.schema["_given"].dataType, T.StructType)
    raw = (F.col("_given.value") if reports else F.col("_given")).cast("array<float>")
    vectors = vectors.withColumn("_raw", raw)
    usable = (F.size("_raw") == settings.embed_dim) & ~F.exists("_raw", lambda x: x.isNull())
    told = [F.col("error")] if "error" in chunks.columns else []
    told += [F.col("_given.error")] if reports else []
    vectors = vectors.withColumn(
        "embedding", F.when(usable & F.col("content").isNotNull(), F.col("_raw"))
    ).withColumn("error", F.when(F.col("embedding").isNull(), F.coalesce(*told, F.lit(UNUSABLE))))
    return vectors.select(
        *keep,
        document_id(F.col("doc_sha256")).alias("document_id"),
        "doc_sha256",
        "chunk_index",
        encrypt(spark, F.col("content"), keys.cipher).alias("content_enc"),
        "embedding",
        F.when(
            F.col("embedding").isNotNull(),
            seal(
                spark,
                F.col("content"),
                F.col("doc_sha256"),
                F.col("chunk_index"),
                # The input of a Python function is made for every row, also where it is not used.
                F.coalesce("embedding", F.array(F.lit(0.0)).cast("array<float>")),
                keys.seal,
            ),
        ).alias("chunk_hmac"),
        F.current_timestamp().alias("created_at"),
        F.lit(settings.embed_model_tag).alias("embedding_model"),
        "error",
    )


def ingest(
    rows: DataFrame,
    store: Store,
    keys: Keys,
    model: Embedder,
    batch: str,
    settings: Settings = Settings(),
    splitter: Splitter = recursive_chunks,
    *,
    names: DataFrame | None,
    journal: str | None = None,
    clock: str | None = None,
) -> DataFrame:
    """Ingest ``rows`` (``ord, source_ref, context``; ``ord`` is unique) as one repeatable batch.

    ``names`` (``name, category``) is the dictionary of entities to pseudonymise; it must be stated,
    and None says that names are left as they are. Returns documents and chunks per status. The
    costly pass over the texts happens once; its result is staged encrypted, and every later step
    reads only the columns it needs. A document with a chunk the model could not embed is left out
    as a whole: it and its copies count under ``errors``. One commit at the end makes all four tables
    visible; until then readers see the batch as it was. Staged tables are emptied afterwards.
    With ``journal`` the events of the batch are appended to the log at that path. Stored times are
    those of the job, or of the rows' timestamp column ``clock``.
    """
    spark = rows.sparkSession
    attempt = store.begin()
    with scratch(spark):
        if journal:
            started = rows.agg(F.count("*").alias("documents")).select(
                F.lit("ingest_start").alias("event"),
                F.lit("INFO").alias("level"),
                F.to_json(F.struct(F.lit(batch).alias("batch"), "documents")).alias("detail"),
            )
            write_events(as_lines(started, "ingest"), journal)
        stamped = rows.withColumn("_at", F.col(clock) if clock else F.current_timestamp())
        final, any_failed = _ingested(stamped, store, keys, model, batch, attempt, settings, splitter, names)
        counts = [tuple(r) for r in status_rollup(final).collect()]  # one row per status
        if journal:
            write_events(as_lines(ingest_events(final), "ingest"), journal)
            done = spark.createDataFrame(
                [("ingest_done", "INFO", json.dumps({"batch": batch} | {s: n for s, n, _ in counts}))],
                "event string, level string, detail string",
            )
            write_events(as_lines(done, "ingest"), journal)
    store.commit(batch, attempt, failed=any_failed)
    return spark.createDataFrame(counts, "status string, n_docs bigint, n_chunks bigint")


def routed_batch(
    rows: DataFrame,
    keys: Keys,
    settings: Settings,
    names: DataFrame | None,
    known: Known | None = None,
) -> DataFrame:
    """The rows with hash, counts of personal data, score, ``status`` and encrypted text, stored.

    The one costly pass over the texts. Only hashes and numbers are shuffled: every row, its encrypted
    text included, stays in the task that reads it and gets its status there.
    """
    spark = rows.sparkSession
    entities = None
    if names is not None:

        def sealed(named: DataFrame) -> DataFrame:
            """Between the parts of a large dictionary texts are stored encrypted, as they always are."""
            hidden = named.withColumn("context", encrypt(spark, F.col("context"), keys.cipher))
            opened = decrypt(spark, F.col("context"), keys.cipher)
            return staged(hidden, "named").withColumn("context", opened)

        rows = with_entities(rows, "ord", "context", names, "_entities", between=sealed)
        entities = "_entities"
    ready = prepared(
        rows, "context", settings.injection_threshold, entities=entities
    ).withColumn("content_enc", encrypt(spark, F.col("text_pseudo"), keys.cipher))
    columns = (
        "ord source_ref _at doc_sha256 pii_stats score reasons is_empty passing content_enc".split()
    )
    ready = staged(placed(ready.select(*columns)), "ready")
    marks = staged(bit_maps(copies(ready, known=known), "_place"), "marks")
    return with_status(ready, marks, settings.injection_threshold).drop("_place")


def _ingested(
    rows: DataFrame,
    store: Store,
    keys: Keys,
    model: Embedder,
    batch: str,
    attempt: str,
    settings: Settings,
    splitter: Splitter,
    names: DataFrame | None,
) -> tuple[DataFrame, bool]:
    """Write the tables of an attempt; the staged routing of its rows, and whether a model failed."""
    spark = rows.sparkSession
    routed = routed_batch(rows, keys, settings, names, lambda k: store.known_hashes(k, batch))

    def of_status(status: str) -> DataFrame:
        return routed.filter(F.col("status") == status)

    accepted = of_status("ingested").select("doc_sha256", "content_enc")
    texts = decrypt(spark, F.col("content_enc"), keys.cipher)
    pieces = chunk_rows(accepted, texts, settings, splitter)
    store.write("chunks", sealed_chunks(pieces, model, keys, settings), batch, attempt)
    chunks = store.read_attempt("chunks", batch, attempt, "error string")
    sizes = staged(
        chunks.groupBy("doc_sha256").agg(
            F.count("*").alias("n_chunks"),
            F.max(F.col("embedding").isNull()).alias("failed"),
            F.min_by("error", F.when(F.col("error").isNotNull(), F.col("chunk_index"))).alias("error"),
        ),
        "sizes",
    )
    failed = sizes.filter("failed").select("doc_sha256")
    any_failed = not failed.isEmpty()
    if any_failed:
        store.write("failed", failed, batch, attempt)

    none = F.lit(0).cast("long")
    narrow = routed.drop("content_enc")
    others = narrow.filter(F.col("status") != "ingested").withColumns(
        {"n_chunks": none, "error": F.lit(None).cast("string")}
    )
    if any_failed:
        # A copy of a failed document has nothing stored that it could be a duplicate of.
        same = sizes.filter("failed").select(
            "doc_sha256", F.lit(True).alias("_copy"), F.col("error").alias("_error")
        )
        wrong = F.col("_copy") & (F.col("status") == "duplicate") & F.col("passing")
        others = others.join(same, "doc_sha256", "left").withColumns(
            {
                "status": F.when(wrong, "errors").otherwise(F.col("status")),
                "error": F.when(wrong, F.col("_error")),
            }
        ).drop("_copy", "_error")
    ingested = (
        narrow.filter(F.col("status") == "ingested")  # one row per hash
        .join(sizes, "doc_sha256", "left")
        .withColumns(
            {
                "status": F.when(F.col("failed"), "errors").otherwise(F.col("status")),
                "n_chunks": F.when(F.col("failed"), none).otherwise(F.coalesce("n_chunks", none)),
            }
        )
        .drop("failed")
    )
    final = staged(ingested.unionByName(others), "final")

    store.write(
        "quarantine",
        of_status("quarantined").select(
            "source_ref",
            F.array_join("reasons", ", ").alias("reason"),
            F.col("score").cast("float").alias("score"),
            "content_enc",
            F.col("_at").alias("detected_at"),
        ),
        batch,
        attempt,
    )
    store.write("ingest_log", ingest_log(final), batch, attempt)
    store.write(
        "documents",
        final.filter(F.col("status") == "ingested").select(
            document_id(F.col("doc_sha256")).alias("document_id"),
            "source_ref",
            "doc_sha256",
            F.col("_at").alias("ingested_at"),
            F.current_user().alias("ingested_by"),
            "pii_stats",
        ),
        batch,
        attempt,
    )
    return final, any_failed


def ingest_log(routed: DataFrame) -> DataFrame:
    """One log row per ingested, duplicate or quarantined document; the others leave none."""
    return routed.filter(F.col("status").isin("ingested", "duplicate", "quarantined")).select(
        (F.col("_at") if "_at" in routed.columns else F.current_timestamp()).alias("ts"),
        log_operation(F.col("status")).alias("operation"),
        log_detail(
            F.col("status"),
            F.col("source_ref"),
            F.col("n_chunks"),
            F.col("score"),
            F.col("reasons"),
        ).alias("detail"),
        F.col("doc_sha256").alias("ref_sha256"),
    )
