"""The folder all executors share: staged tables and stream checkpoints live there."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_LOCAL: dict[str, str] = {}
_OWNED: ContextVar[list | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="quillvault-")
    return _LOCAL[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/quillvault/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch where whole texts go through Python: a few megabytes at a time.
TEXT_ROWS = "1000"


def session_for_texts(spark: SparkSession) -> SparkSession:
    """Set the session's Arrow batches to ``TEXT_ROWS`` rows, unless its user chose a size.

    For queries and the pipeline, not for operators: these leave settings alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, TEXT_ROWS)
    return spark


#: Shuffle files of a finished write are of no use any more; this lets Spark remove them at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end; the setting is put back afterwards."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (at ``path`` where given) and read it back.

    Costly columns are computed once, later steps read only the columns they need, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    with tidy_shuffles(spark):
        df.write.parquet(path)
    owned = _OWNED.get()
    if owned is not None:
        owned.append((path, df.schema))
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are emptied at the end; nothing lazy may read them afterwards."""
    token = _OWNED.set([])
    try:
        yield
    finally:
        owned = _OWNED.get() or []
        _OWNED.reset(token)
        for path, schema in owned:
            emptied(spark, path, schema)


def emptied(spark: SparkSession, path: str, schema: StructType) -> None:
    """Replace a staged table by an empty one; nothing lazy may read it afterwards."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(0, 0, 1, 1).select(*nothing).write.mode("overwrite").parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for row-wise work on a plain scan that arrives in fewer partitions.

    Large inputs already have more splits than cores and are returned as they are. Only for plain
    scans: counting the partitions of a plan with a shuffle would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
