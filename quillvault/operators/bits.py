"""Sets of numbers as bit maps, and filters of keys made of them.

A set is a table of ``bucket, bits``: one bit map of 4 KB for every 32,768 numbers of which at least
one is in the set. Spark's own aggregate builds the maps, partly in every task, so a number that
comes often costs nothing. Looking numbers up is a join with a table whose bytes are known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers in a bit map, as Spark's aggregate has it.
BUCKET = 32_768
#: Bits of a filter of keys: at most 4,096 maps, 16 MB, whatever the number of keys.
FILTER_BITS = 1 << 27
#: Maps that are sent to all tasks at once: 64 MB.
SENT_MAPS = 16_384


def bit_maps(numbers: DataFrame, number: str) -> DataFrame:
    """The set of the values (not negative) of a column."""
    return numbers.groupBy(F.expr(f"`{number}` div {BUCKET}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.expr(f"`{number}` % {BUCKET}")).alias("bits")
    )


def _is_set(bits: str, number: str) -> Column:
    """Whether the bit of ``number`` is set in its map: the lowest bit of a byte comes first."""
    place = f"cast({number} % {BUCKET} AS int)"
    byte = f"cast(conv(hex(substring({bits}, {place} div 8 + 1, 1)), 16, 10) AS int)"
    return F.expr(f"getbit({byte}, {place} % 8) = 1")


def _looked_up(rows: DataFrame, maps: DataFrame, number: Column, flag: str) -> DataFrame:
    maps = maps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    return (
        rows.withColumn("_number", number)
        .withColumn("_bucket", F.expr(f"_number div {BUCKET}"))
        .join(F.broadcast(maps), "_bucket", "left")
        .withColumn(flag, F.coalesce(_is_set("_bits", "_number"), F.lit(False)))
        .drop("_bucket", "_bits", "_number")
    )


def marked(
    rows: DataFrame, maps: DataFrame, number: str, flag: str, sent_maps: int = SENT_MAPS
) -> DataFrame:
    """``rows`` with the column ``flag``: whether ``number`` is in the set. No row is moved.

    ``maps`` is a stored table. What it holds beyond ``sent_maps`` is looked up in further passes,
    each over the rows of one range of numbers; where the numbers rise within stored files, a pass
    skips the others.
    """
    held = maps.count()
    passes = -(-held // sent_maps)
    if passes <= 1:
        return _looked_up(rows, maps, F.col(number), flag)
    cuts = maps.approxQuantile("bucket", [i / (2 * passes) for i in range(1, 2 * passes)], 0.0)
    edges = sorted({int(c) for c in cuts})
    parts = []
    for a, b in zip([None, *edges], [*edges, None], strict=True):
        few, some = maps, rows
        if a is not None:
            few, some = few.filter(F.col("bucket") >= a), some.filter(F.col(number) >= a * BUCKET)
        if b is not None:
            few, some = few.filter(F.col("bucket") < b), some.filter(F.col(number) < b * BUCKET)
        parts.append(_looked_up(some, few, F.col(number), flag))
    return reduce(DataFrame.unionByName, parts)


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A filter of the values of a column: bit maps of bounded size, of hashes of the values."""
    return bit_maps(keys.select(_slot(key, bits).alias("_slot")), "_slot")


def may_be_in(rows: DataFrame, key: str, maps: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key may be among those of a filter of ``bits``; all rows whose key is are kept."""
    out = _looked_up(rows, maps, _slot(key, bits), "_held")
    return out.filter("_held").drop("_held")
