"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
HOT_ROWS = 1_000_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; stops counting there."""
    return df.limit(rows + 1).count() <= rows


def attach(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    weight: str,
    tie: str,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    few: bool | None = None,
) -> DataFrame:
    """Join ``right`` (few narrow rows per key) to every row of ``left``.

    ``right[weight]`` is the number of left rows of the key and ``tie`` a left column that varies
    within a key. A right side of checked size is broadcast. Otherwise both sides are shuffled,
    and the rows of a key above ``hot_rows`` go to several tasks: at most ``rows / hot_rows`` keys
    are that heavy, so their list is small enough to broadcast whatever the data. ``few`` tells
    the outcome of the size check where the caller has made it already.
    """
    if few is None:
        few = fits(right, broadcast_rows)
    if few:
        return left.join(F.broadcast(right.drop(weight)), key, how)
    copies = F.ceil(F.col(weight) / F.lit(hot_rows)).cast("int")
    hot = right.filter(F.col(weight) > hot_rows).select(key, copies.alias("_copies")).distinct()
    salted_left = (
        left.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_salt",
            F.pmod(F.xxhash64(tie), F.coalesce(F.col("_copies"), F.lit(1)).cast("long")).cast(
                "int"
            ),
        )
        .drop("_copies")
    )
    salted_right = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1))
    ).drop(weight)
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
