"""The event log: one JSON object per line."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv
from quillvault.sources.corpus import numbered_lines

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
    ]
)


def event_level(event: Column) -> Column:
    return F.when(event.isin(*fv.SECURITY_EVENTS), "WARNING").otherwise("INFO")


def event_line(
    ts: Column,
    event: Column,
    component: Column,
    detail: Column,
    request_id: Column | None = None,
    level: Column | None = None,
) -> Column:
    """One event as a JSON line; ``ts`` is a timestamp, written in UTC.

    A null or empty request id leaves its field out.
    """
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    request = F.nullif(request_id, F.lit("")) if request_id is not None else None
    fields = [
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'").alias("ts"),
        (level if level is not None else event_level(event)).alias("level"),
        event.alias("event"),
        component.alias("component"),
        *([request.alias("request_id")] if request is not None else []),
        detail.alias("detail"),
    ]
    return F.to_json(F.struct(*fields))


def write_events(lines: DataFrame, path: str) -> None:
    """Append a single string column of event lines."""
    lines.write.mode("append").text(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of a log; lines that are not JSON objects are skipped."""
    return (
        spark.read.schema(EVENT_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .filter(F.col("event").isNotNull())
    )


#: Bytes that are first read from the end of a file; more if its lines are long.
BLOCK_BYTES = 1 << 20
#: Names of files that cannot be read from the end.
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
BREAK = re.compile(rb"\r\n|\n|\r")


def _files_from_the_end(spark: SparkSession, path: str, at_once: int = 256) -> Iterator[tuple[str, int]]:
    """Files of a log with their bytes, last path first. Their content is not read."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    before = None
    while True:
        left = listed if before is None else listed.filter(F.col("path") < before)
        found = left.orderBy(F.desc("path")).limit(at_once).collect()
        for row in found:
            yield row["path"], row["length"]
        if len(found) < at_once:
            return
        before = found[-1]["path"]


def _last_of_file(spark: SparkSession, file: str, length: int, wanted: int) -> list[bytes]:
    """The last lines of a file, read block by block from its end until there are enough."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(file)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size, lines = BLOCK_BYTES, []
    while True:
        size = min(size, length)
        stream = files.open(place)
        try:
            stream.seek(length - size)
            raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)) if size else b""
        finally:
            stream.close()
        lines = BREAK.split(raw)
        if not lines[-1]:
            lines.pop()
        if size == length:
            return lines[-wanted:]
        if len(lines) > wanted:  # the first may have begun before the block
            return lines[-wanted:]
        size *= 4


def last_lines(spark: SparkSession, path: str, wanted: int) -> list[str]:
    """The last lines of a log in order, of its files in path order.

    Files are walked from the last one, and each is read from its end, so the time depends on the
    lines wanted and not on the log. Only files in a packed form are read whole, by Spark.
    """
    found: list[bytes] = []
    for file, length in _files_from_the_end(spark, path):
        if len(found) >= wanted:
            break
        rest = wanted - len(found)
        if file.lower().endswith(PACKED):
            last = numbered_lines(spark, file).orderBy(F.desc("line_number")).limit(rest).collect()
            found = [r["line"].encode() for r in reversed(last)] + found
        else:
            found = _last_of_file(spark, file, length, rest) + found
    return [line.decode("utf-8", "replace") for line in found]


def _events_in_order(lines: DataFrame) -> DataFrame:
    """Events of ``line_number, line``; lines that are no JSON object are dropped."""
    fields = "ts string, level string, event string, component string, request_id string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    row = F.from_json("line", f"{fields}, detail string, _bad string", options)
    read = lines.filter(F.ltrim("line").startswith("{")).select("line_number", row.alias("row"))
    detail = F.when(
        F.ltrim("row.detail").startswith("{"), F.from_json("row.detail", "map<string,string>")
    )
    return read.filter(F.col("row._bad").isNull()).select(
        "line_number",
        *[f"row.{f.split()[0]}" for f in fields.split(", ")],
        detail.alias("detail"),
    )


def read_log(spark: SparkSession, path: str, tail: int | None = None) -> DataFrame:
    """Events of a log in line order (``line_number``); of its last ``tail`` lines where given.

    The tail is taken of all lines, then lines that are no JSON object are dropped. An object
    without an event, or whose detail is no object, stays with null there. All lines are numbered;
    for the last lines alone, ``read_last`` looks at nothing else.
    """
    lines = numbered_lines(spark, path)
    if tail is not None:
        lines = lines.orderBy(F.desc("line_number")).limit(tail)
    return _events_in_order(lines)


def read_last(spark: SparkSession, path: str, wanted: int) -> DataFrame:
    """Events of the last lines of a log, as ``read_log`` with a tail, numbered from 0 within them."""
    rows = list(enumerate(last_lines(spark, path, wanted)))
    return _events_in_order(spark.createDataFrame(rows, "line_number bigint, line string").coalesce(1))


def typed_details(events: DataFrame) -> DataFrame:
    """Events of a log (``value``: a line) whose ``detail`` keeps its types, as a ``variant``.

    Numbers, lists and objects within the detail stay what they are; a line that is no JSON object
    is dropped, a line without detail has null there.
    """
    whole = F.try_parse_json("value")
    read = events.select(F.when(F.ltrim("value").startswith("{"), whole).alias("_event"))
    fields = ("ts", "level", "event", "component", "request_id")
    return read.filter(F.col("_event").isNotNull()).select(
        *(F.try_variant_get("_event", f"$.{f}", "string").alias(f) for f in fields),
        F.try_variant_get("_event", "$.detail", "variant").alias("detail"),
    )


def stream_events(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .filter(F.col("event").isNotNull())
    )
