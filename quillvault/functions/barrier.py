"""Keeping costly derived columns from being computed twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with ``columns`` passed through a one-row generator.

    The optimiser moves a filter below projections by writing the column's expression into it.
    For a chain of costly steps that repeats the whole chain, several times over. A filter on a
    generated column stays above the generator; filters on other columns still reach the scan.
    """
    others = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*others, f"inline(array(struct({', '.join(columns)})))")


def exploded(df: DataFrame, array: Column, names: Sequence[str], *keep: str) -> DataFrame:
    """One row per element of ``array`` with its position, next to the columns ``keep``.

    The optimiser puts a filter for non-empty arrays below an inner generator, which evaluates the
    array twice. An outer generator has no such filter; its row for an empty array is dropped here.
    """
    position, value = names
    return df.select(*keep, F.posexplode_outer(array).alias(position, value)).filter(
        F.col(position).isNotNull()
    )
