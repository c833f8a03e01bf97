"""Structured Streaming forms of ingest, alert counting and deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillvault import fixed_values as fv
from quillvault.functions.embedding import Embedder
from quillvault.functions.text import with_content_hash
from quillvault.operators.bits import bit_maps, marked
from quillvault.operators.routing import placed
from quillvault.plans.ingest import Keys, ingest
from quillvault.settings import Settings
from quillvault.sources.shared import scratch, staged
from quillvault.sources.store import Store


def stream_ingest(
    rows: DataFrame,
    store: Store,
    keys: Keys,
    model: Embedder,
    checkpoint: str,
    settings: Settings = Settings(),
    on_batch: Callable[[DataFrame, int], None] | None = None,
    name: str = "stream",
    *,
    names: DataFrame | None,
    journal: str | None = None,
    compact_every: int = 32,
) -> StreamingQuery:
    """Ingest new rows (``ord, source_ref, context``) batch by batch until none are left.

    What is known already is looked up in the store's index of hashes, so no state grows with the
    corpus; every ``compact_every`` batches their folders are gathered. A batch that is run again after a failure replaces its own output; ``name`` keeps the
    batches of different streams into one store apart. ``names`` and ``journal`` are those of
    ``ingest``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rollup = ingest(
            batch,
            store,
            keys,
            model,
            f"{name}-{batch_id}",
            settings,
            names=names,
            journal=journal,
        )
        if (batch_id + 1) % compact_every == 0:
            store.compact()
        if on_batch:
            on_batch(rollup, batch_id)

    return (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_alerts(
    events: DataFrame,
    names: tuple[str, ...],
    window: str = "30 seconds",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Alert events per time window; rows later than the watermark are dropped.

    The watermark follows all events, so a quiet alert does not hold its windows back.
    """
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .filter(F.col("event").isin(*names))
        .groupBy(F.window("ts", window).alias("window"), "event")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "event", "n")
    )


_COUNTS = "window_start timestamp, event string, n bigint"


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of a folder with their ``batch``; none if there is no such folder yet."""
    schema = f"{_COUNTS}, batch bigint"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _newest(parts: DataFrame) -> DataFrame:
    """The rows of the newest batch."""
    last = parts.agg(F.max("batch")).first()[0]
    return parts.filter(F.col("batch") == F.lit(last)).drop("batch")


def zero_filled(counts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Every window of ``window_start, event, n`` with all ``names``, zero where none came."""
    every = counts.groupBy("window_start").agg(
        F.map_from_entries(F.collect_list(F.struct("event", "n"))).alias("counts")
    )  # at most one entry per name
    name = F.explode(F.array(*[F.lit(n) for n in names]))
    return every.withColumn("event", name).select(
        "window_start", "event", F.coalesce(F.col("counts")[F.col("event")], F.lit(0)).alias("n")
    )


def alerts_to_table(
    events: DataFrame,
    path: str,
    checkpoint: str,
    names: tuple[str, ...] = fv.ALERT_EVENTS,
    window: str = "30 seconds",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Run ``windowed_alerts`` over all available input; ``window_start, event, n``.

    Windows that no row can reach any more are written once, to ``closed``. The others are a small
    table of their own for every batch (``open``): that of the batch before, and what the batch has
    changed. So a batch reads open windows only, a reader adds the newest ``open`` to ``closed``, and
    a batch that is run again replaces its output. Every window with an alert has all ``names``,
    zero where none came.
    """
    spark = events.sparkSession
    counts = windowed_alerts(events, names, window, lateness)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = _newest(_parts(session, f"{path}/open").filter(F.col("batch") < batch_id))
        known = before.withColumn("_fresh", F.lit(False)).unionByName(
            batch.withColumn("_fresh", F.lit(True))
        )
        with scratch(session):
            now = known.groupBy("window_start", "event").agg(F.max_by("n", "_fresh").alias("n"))
            now = staged(zero_filled(now, names), "alerts")
            # Rows may be late by ``lateness`` behind the newest event of the batch before, which is
            # no older than this; the engine itself drops late rows one batch later.
            edge = F.col("last") - F.expr(f"INTERVAL {lateness}") - F.expr(f"INTERVAL {window}")
            last = before.agg(F.max("window_start").alias("last"))
            edge = last.select(edge.alias("edge")).first()["edge"]
            closed = F.lit(False) if edge is None else F.col("window_start") <= F.lit(edge)
            for name, part in (("open", ~closed), ("closed", closed)):
                now.filter(part).coalesce(1).write.mode("overwrite").parquet(
                    f"{path}/{name}/batch={batch_id}"
                )

    counts.writeStream.outputMode("update").foreachBatch(run).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    return _parts(spark, f"{path}/closed").drop("batch").unionByName(
        _newest(_parts(spark, f"{path}/open"))
    )


def dedup_to_table(
    rows: DataFrame,
    text: str,
    path: str,
    checkpoint: str,
    stream: str = "stream",
    order: str | None = None,
) -> DataFrame:
    """Store the rows of a stream whose content hash is not stored yet, and return what is stored.

    Known hashes are looked up in the table, so no state grows with the corpus. Of equal rows in one
    batch that of the smallest ``order`` is stored, or any one without it. Only hashes are shuffled;
    each row learns where it is whether it is stored. A batch that is run again replaces its own folder; ``stream`` keeps the
    batches of different streams into one table apart.
    """
    spark = rows.sparkSession
    hashed = with_content_hash(rows, text)
    schema = T.StructType([*hashed.schema.fields, T.StructField("batch", T.StringType())])

    def stored() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def run(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream}-{batch_id}"
        known = stored().filter(F.col("batch") != name).select("doc_sha256")
        with scratch(batch.sparkSession):
            held = staged(placed(batch), "batch")
            by = F.struct(*([order] if order else []), "_place")
            first = held.groupBy("doc_sha256").agg(F.min_by("_place", by).alias("_place"))
            fresh = first.join(known, "doc_sha256", "left_anti")
            maps = staged(bit_maps(fresh, "_place"), "fresh")
            kept = marked(held, maps, "_place", "_fresh").filter("_fresh")
            kept.select(*hashed.columns).write.mode("overwrite").parquet(f"{path}/batch={name}")

    hashed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    return stored().drop("batch")


def new_content(rows: DataFrame, text: str, ts: str | None = None, within: str | None = None) -> DataFrame:
    """Rows whose content hash was not seen before on the stream.

    Without a time column the state keeps every hash ever seen; with one it keeps those of the
    last ``within``.
    """
    hashed = with_content_hash(rows, text)
    if ts and within:
        return hashed.withWatermark(ts, within).dropDuplicatesWithinWatermark(["doc_sha256"])
    return hashed.dropDuplicates(["doc_sha256"])


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append stream over all available input into Parquet and read the result."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
