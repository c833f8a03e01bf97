"""The stored tables of a corpus: documents, chunks, quarantine and ingest log.

A run of a batch writes all its tables below a folder of its own, ``batch=<id>/attempt=<id>``. One row
in ``commits``, written last, makes the whole attempt visible and the batch's earlier attempts
invisible, in every table at once. A run that breaks off, or a batch that is run again while
others read, therefore never shows half a result.

``compact`` gathers what many small batches have left: their folders become one segment a table, their
commits one list, and the hashes of all stored documents an index by the first digits of the hash
with a filter of fixed size. A batch then reads the filter, and of the index only the parts whose
digits it needs. Commits after that go to a new epoch; only one compaction may run at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quillvault.operators.bits import key_filter, may_be_in

TABLES = {
    "documents": "document_id bigint, source_ref string, doc_sha256 string, "
    "ingested_at timestamp, ingested_by string, pii_stats map<string,int>",
    "chunks": "document_id bigint, doc_sha256 string, chunk_index int, content_enc binary, "
    "embedding array<float>, chunk_hmac string, created_at timestamp, embedding_model string",
    "quarantine": "source_ref string, reason string, score float, content_enc binary, "
    "detected_at timestamp",
    "ingest_log": "ts timestamp, operation string, detail string, ref_sha256 string",
    # Documents whose chunks are left out, since the model failed on one of them.
    "failed": "doc_sha256 string",
}
COMMITS = "batch string, attempt string, committed_at timestamp, failed boolean"
#: Commits that a compaction has gathered, with the segment that holds their rows.
GATHERED = f"{COMMITS}, segment string"
COMPACTIONS = "epoch string, previous string, made_at timestamp"
FIRST_EPOCH = "first"
#: Digits of a hash that part the index: 256 folders.
PREFIX = 2


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str

    def begin(self) -> str:
        return uuid.uuid4().hex

    def write(self, table: str, rows: DataFrame, batch: str, attempt: str) -> None:
        writer = rows.write
        if table == "chunks":
            # Sorted by document, so that a pushed filter on hashes skips most row groups.
            rows = rows.sortWithinPartitions("doc_sha256", "chunk_index")
            writer = rows.write.partitionBy("embedding_model")
        writer.parquet(f"{self.path}/{table}/batch={batch}/attempt={attempt}")

    def commit(self, batch: str, attempt: str, failed: bool = False) -> None:
        """Make the attempt the visible one of its batch; ``failed``: it has a table of failures."""
        row = self.spark.range(1).select(
            F.lit(batch).alias("batch"),
            F.lit(attempt).alias("attempt"),
            F.current_timestamp().alias("committed_at"),
            F.lit(failed).alias("failed"),
        )
        path = f"{self.path}/commits/epoch={self._epochs()[0]}"
        row.coalesce(1).write.mode("append").parquet(path)

    def _scan(self, paths: str | list[str], schema: str, base: str | None = None) -> DataFrame | None:
        reader = self.spark.read.schema(schema)
        if base:
            reader = reader.option("basePath", f"{self.path}/{base}")
        paths = [paths] if isinstance(paths, str) else paths
        try:
            return reader.parquet(*(f"{self.path}/{p}" for p in paths))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _epochs(self) -> list[str]:
        """The present epoch and the one before it, if there was a compaction."""
        made = self._scan("compactions", COMPACTIONS)
        newest = made and made.orderBy(F.desc("made_at")).first()
        return [newest["epoch"], newest["previous"]] if newest else [FIRST_EPOCH]

    def _commits(self) -> DataFrame:
        """All commits that may be visible, with their ``segment``; few and narrow rows per batch.

        Commits of the epoch before may have come while it was gathered.
        """
        epochs = self._epochs()
        gathered = self._scan(f"gathered/epoch={epochs[0]}", GATHERED)
        commits = self.spark.createDataFrame([], GATHERED) if gathered is None else gathered
        for epoch in epochs:
            single = self._scan(f"commits/epoch={epoch}", COMMITS)
            if single is not None:
                commits = commits.unionByName(single.withColumn("segment", F.lit(None).cast("string")))
        return commits

    def visible(self) -> DataFrame:
        """The newest commit of every batch: ``batch, attempt, failed, committed_at, segment``."""
        # Of a gathered commit and its original, the gathered one.
        fields = ["committed_at", "attempt", "segment", "failed"]
        newest = F.max(F.struct(*fields)).alias("c")
        return self._commits().groupBy("batch").agg(newest).select("batch", *(f"c.{f}" for f in fields))

    def read_attempt(self, table: str, batch: str, attempt: str, *more: str) -> DataFrame:
        """One table of an attempt that need not be committed, with ``more`` columns of its files."""
        schema = ", ".join([TABLES[table], *more])
        rows = self._scan(f"{table}/batch={batch}/attempt={attempt}", schema)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def _attempts(self, table: str, commits: list[Row]) -> DataFrame:
        """Rows of these commits with ``batch, attempt``. Only their folders are listed."""
        schema = f"{TABLES[table]}, batch string, attempt string"
        single = [c for c in commits if c["segment"] is None]
        rows = [self.spark.createDataFrame([], schema)]
        if single:
            paths = [f"{table}/batch={c['batch']}/attempt={c['attempt']}" for c in single]
            rows.append(self._scan(paths, schema, base=table))
        segments = sorted({c["segment"] for c in commits} - {None})
        if segments:
            paths = [f"segments/{table}/segment={s}" for s in segments]
            held = self._scan(paths, schema, base=f"segments/{table}")
            if held is not None:
                held = self._of(held.drop("segment"), [c for c in commits if c["segment"]])
                rows.append(held)
        return reduce(DataFrame.unionByName, [r for r in rows[1:] if r is not None] or rows)

    def _of(self, rows: DataFrame, commits: list[Row]) -> DataFrame:
        """The rows of these commits, by their columns; the list is in the driver's memory already."""
        wanted = self.spark.createDataFrame(
            [(c["batch"], c["attempt"]) for c in commits], "batch string, attempt string"
        )
        return rows.join(F.broadcast(wanted), ["batch", "attempt"], "left_semi")

    def read(self, table: str) -> DataFrame:
        """Rows of visible attempts, with their ``batch``."""
        commits = self.visible().collect()  # one narrow row per batch
        rows = self._attempts(table, commits)
        broken = [c for c in commits if c["failed"]]
        if table == "chunks" and broken:
            failed = self._attempts("failed", broken)
            rows = rows.join(failed, ["batch", "attempt", "doc_sha256"], "left_anti")
        columns = [c.split()[0] for c in TABLES[table].split(", ")]
        return rows.select(*columns, "batch")

    def known_hashes(self, keys: DataFrame, except_batch: str) -> DataFrame | None:
        """Content hashes of stored documents that ``keys`` (``doc_sha256``) may be among.

        None if no batch is stored. All of ``keys`` that are stored are there, the batch about to be replaced left out. The index
        is read only below the first digits of the keys that pass its filter.
        """
        commits = [c for c in self.visible().collect() if c["batch"] != except_batch]
        if not commits:
            return None
        out = self._attempts("documents", [c for c in commits if c["segment"] is None])
        out = out.select("doc_sha256")
        epoch = self._epochs()[0]
        gathered = [c for c in commits if c["segment"]]
        if not gathered:
            return out
        maps = self._scan(f"hash_filter/epoch={epoch}", "bucket bigint, bits binary")
        suspects = may_be_in(keys.select("doc_sha256"), "doc_sha256", maps)
        prefix = F.substring("doc_sha256", 1, PREFIX).alias("prefix")
        prefixes = [r["prefix"] for r in suspects.select(prefix).distinct().collect()]  # <= 256
        if not prefixes:
            return out
        schema = "doc_sha256 string, batch string, attempt string, prefix string"
        index = self._scan(f"hash_index/epoch={epoch}", schema).filter(F.col("prefix").isin(prefixes))
        return out.unionByName(self._of(index, gathered).select("doc_sha256"))

    def compact(self) -> str:
        """Gather the folders and commits of all batches since the last compaction; the new epoch.

        Readers go on as before until the last, one-row write. Gathered folders stay where they are
        for readers that have begun; no reader that begins later looks at them.
        """
        before, epoch = self._epochs()[0], uuid.uuid4().hex
        commits = self.visible().collect()
        single = [c for c in commits if c["segment"] is None]
        for table in TABLES:
            chosen = [c for c in single if c["failed"]] if table == "failed" else single
            if not chosen:
                continue
            rows = self._attempts(table, chosen)
            if "doc_sha256" in rows.columns:
                rows = rows.repartitionByRange(F.col("doc_sha256"))
                rows = rows.sortWithinPartitions("doc_sha256")
            writer = rows.write
            if table == "chunks":
                writer = writer.partitionBy("embedding_model")
            writer.parquet(f"{self.path}/segments/{table}/segment={epoch}")
        prefix = F.substring("doc_sha256", 1, PREFIX).alias("prefix")
        hashes = self._attempts("documents", single).select("doc_sha256", "batch", "attempt", prefix)
        index = self._scan(
            f"hash_index/epoch={before}",
            "doc_sha256 string, batch string, attempt string, prefix string",
        )
        if index is not None:
            hashes = hashes.unionByName(self._of(index, commits))
        path = f"{self.path}/hash_index/epoch={epoch}"
        hashes.repartitionByRange(F.col("doc_sha256")).sortWithinPartitions("doc_sha256").write.partitionBy(
            "prefix"
        ).parquet(path)
        stored = self.spark.read.schema(hashes.schema).parquet(path)
        maps = key_filter(stored, "doc_sha256")
        maps.coalesce(1).write.parquet(f"{self.path}/hash_filter/epoch={epoch}")
        gathered = [
            (c["batch"], c["attempt"], c["committed_at"], c["failed"], c["segment"] or epoch)
            for c in commits
        ]
        self.spark.createDataFrame(gathered, GATHERED).coalesce(1).write.parquet(
            f"{self.path}/gathered/epoch={epoch}"
        )
        self.spark.createDataFrame([(epoch, before)], "epoch string, previous string").withColumn(
            "made_at", F.current_timestamp()
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/compactions")
        return epoch

    def visible_chunks(self) -> DataFrame:
        """Chunks of finished batches."""
        return self.read("chunks")

    # Read access by role: an auditor sees metadata only, a reader never sees the quarantine.
    def audit_documents(self) -> DataFrame:
        return self.read("documents").select("pii_stats", "source_ref", "ingested_at")

    def audit_quarantine(self) -> DataFrame:
        return self.read("quarantine").select("source_ref", "reason", "score", "detected_at")

    def audit_log(self) -> DataFrame:
        return self.read("ingest_log").select("ts", "operation", "detail", "ref_sha256")

    def register_audit_views(self) -> None:
        """Make the auditor's columns available to SQL as temporary views."""
        self.audit_documents().createOrReplaceTempView("audit_documents")
        self.audit_quarantine().createOrReplaceTempView("audit_quarantine")
        self.audit_log().createOrReplaceTempView("audit_ingest_log")

    def reader_tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in ("documents", "chunks", "ingest_log")}
