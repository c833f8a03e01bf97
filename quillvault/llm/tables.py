"""Input tables and row-wise Arrow work shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillvault.sources.shared import session_for_texts, staged

__all__ = ["read", "map_rows", "session_for_texts", "staged"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HELD_BYTES = 16 << 20


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[..., Iterable[tuple]]],
    schema: str,
    rows: int = 2000,
) -> DataFrame:
    """``make()`` runs once per task; what it returns maps the values of a row to output rows.

    Output leaves in batches of at most ``rows`` rows and, but for single larger rows, about
    ``HELD_BYTES`` of text; Spark bounds the bytes of input batches.
    """
    spark = df.sparkSession
    target = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)
    texts = [i for i, f in enumerate(arrow) if pa.types.is_string(f.type) or pa.types.is_binary(f.type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        out: list[tuple] = []
        held = 0
        for batch in batches:
            columns = batch.columns
            for r in range(batch.num_rows):
                for row in apply(*(c[r].as_py() for c in columns)):
                    out.append(row)
                    for i in texts:
                        held += len(row[i] or "")
                    if len(out) >= rows or held >= HELD_BYTES:
                        yield packed(out, arrow)
                        out, held = [], 0
        if out:
            yield packed(out, arrow)

    return df.mapInArrow(run, target)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to be no column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def keep_rows(df: DataFrame, column: str, make: Callable[[], Callable[..., bool]]) -> DataFrame:
    """Rows of ``df`` for whose ``column`` the predicate of ``make()`` holds; all columns stay.

    Batches pass through as they are, so no second copy of a batch waits beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = make()
        for batch in batches:
            values = batch.column(column)
            yield batch.filter(pa.array([bool(holds(v.as_py())) for v in values], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
