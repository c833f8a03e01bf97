"""Phrases of two and three words that occur together more often than their parts would.

1. Every task splits its texts into words and stores them by the chunk: the chunk's own words, their
   counts, and the text as a sequence of numbers into them, 0 between pieces and documents.
2. The words of all chunks are summed. A phrase can only be frequent if each of its words is, so only
   frequent words get a number, the same in all chunks.
3. Every task turns its chunks into those numbers and counts two and three words in a row with a
   counting quotient filter (``quotient``), cut by bucket. Equal phrases of a task are one entry
   before anything is shuffled, and the permutation spreads hot and rare phrases alike.
4. The filters of a bucket are merged in sorted order; frequent phrases come out as word numbers.
5. Counts of the parts are joined, the least score of the cuts is kept, phrases that a longer one
   explains are dropped, and the best of every language are ranked.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillvault.llm.quotient import (
    Entries,
    Shape,
    buckets,
    counted,
    merged,
    merged_ranges,
    packed,
    permuted,
    shape_for,
    unpacked,
    words_of,
)
from quillvault.llm.tables import staged
from quillvault.plans.joins import attach

#: Bytes of text in a stored chunk, and of all the chunks a task has open.
CHUNK_BYTES = 4 << 20
OPEN_BYTES = 16 << 20
#: A long text is split into words by slices of about this many bytes.
SLICE_BYTES = 1 << 20
#: Entries a task gathers before it emits its filters, and those expected in a merged bucket.
TASK_ENTRIES = 2_000_000
BUCKET_ENTRIES = 1 << 20
#: Words of a chunk whose phrases are made and sorted at once.
SLICE_WORDS = 1 << 17

BREAKS = b".,;:!?\n\x0b\x0c\r"
TO_DOT = bytes.maketrans(BREAKS, b"." * len(BREAKS))
EDGES = frozenset(BREAKS + b" \t")


class _Numbers(dict):
    """Numbers words in order of appearance, from 1; the break has 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _slices(raw: bytes) -> Iterator[bytes]:
    """``raw`` in slices that end where no word does go on."""
    start = 0
    while len(raw) - start > SLICE_BYTES:
        end = start + SLICE_BYTES
        while end < len(raw) and raw[end] not in EDGES:
            end += 1
        yield raw[start:end]
        start = end
    yield raw[start:] if start else raw


class _Chunk:
    def __init__(self):
        self.numbers = _Numbers()
        self.sequence: list[np.ndarray] = []
        self.size = 0

    def add(self, raw: bytes) -> None:
        number = self.numbers.__getitem__
        for part in _slices(raw):
            words = part.lower().translate(TO_DOT).replace(b".", b" . ").split()
            self.sequence.append(np.fromiter(map(number, words), np.int32, len(words)))
        self.sequence.append(np.zeros(1, np.int32))
        self.size += len(raw)

    def row(self, lang: str) -> tuple:
        sequence = np.concatenate(self.sequence)
        counts = np.bincount(sequence, minlength=len(self.numbers))
        words = [w.decode("utf-8") for w in self.numbers]
        return uuid.uuid4().hex, lang, words[1:], counts[1:].tolist(), sequence.tobytes()


def _chunks(documents: DataFrame) -> DataFrame:
    schema = "chunk string, lang string, words array<string>, counts array<bigint>, tokens binary"
    arrow = pa.schema(
        [
            ("chunk", pa.string()),
            ("lang", pa.string()),
            ("words", pa.list_(pa.string())),
            ("counts", pa.list_(pa.int64())),
            ("tokens", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str, _Chunk] = {}

        def closed(lang: str) -> pa.RecordBatch:
            row = open_chunks.pop(lang).row(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow
            )

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, text = lang.as_py(), text.as_py()
                if not text:
                    continue
                chunk = open_chunks.setdefault(lang, _Chunk())
                chunk.add(text.encode("utf-8"))
                if chunk.size >= CHUNK_BYTES:
                    yield closed(lang)
                elif sum(c.size for c in open_chunks.values()) >= OPEN_BYTES:
                    yield closed(max(open_chunks, key=lambda c: open_chunks[c].size))
        for lang in list(open_chunks):
            yield closed(lang)

    texts = documents.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    return texts.mapInArrow(run, schema)


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """A stored copy of ``df`` with ``id`` from 1 without gaps; one row per partition is summed."""
    placed = staged(df.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(parts), "_part")
        .withColumn("id", F.col("_before") + within + 1)
        .drop("_part", "_place", "_before")
    )


def _filters(chunks: DataFrame, shape: Shape) -> DataFrame:
    """``bucket, n, filter``: the phrases of the chunks of a task (``tokens, places, ids``)."""

    def phrases(tokens: np.ndarray, most: int) -> Entries:
        """Those that begin in the first ``most`` words."""
        one, two = tokens[:-1][:most], tokens[1:][:most]
        three = np.append(tokens[2:], np.uint64(0))[: len(two)]
        pair = (one > 0) & (two > 0)
        triple = pair & (three > 0)
        none = np.zeros(int(pair.sum()), np.uint64)
        high, low = permuted(
            np.concatenate([one[pair], one[triple]]),
            np.concatenate([two[pair], two[triple]]),
            np.concatenate([none, three[triple]]),
            shape,
        )
        return counted(high, low, np.ones(len(high), np.int64), shape)

    def of_chunk(local: np.ndarray, numbers: np.ndarray) -> Entries:
        # Slices overlap by two words, so that each phrase begins in exactly one.
        slices = []
        for a in range(0, max(len(local) - 1, 1), SLICE_WORDS):
            slices.append(phrases(numbers[local[a : a + SLICE_WORDS + 2]], SLICE_WORDS))
        return merged(slices, shape)

    def emitted(parts: list[Entries]) -> Iterator[pa.RecordBatch]:
        for entries in merged_ranges(parts, shape):
            found = buckets(entries, shape)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in found], pa.int64()),
                    pa.array([len(e.high) for _, e in found], pa.int64()),
                    pa.array([packed(e, shape) for _, e in found], pa.binary()),
                ],
                ["bucket", "n", "filter"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Entries] = []
        held = 0
        for batch in batches:
            for raw, found in zip(batch.column(0), batch.column(1), strict=True):
                local = np.frombuffer(raw.as_buffer(), np.int32)
                numbers = np.zeros(int(local.max(initial=0)) + 1, np.uint64)
                places = found.values.field(0).to_numpy(zero_copy_only=False)
                numbers[places] = found.values.field(1).to_numpy(zero_copy_only=False)
                parts.append(of_chunk(local, numbers))
                held += len(parts[-1].high)
                if held >= TASK_ENTRIES:
                    yield from emitted(parts)
                    parts, held = [], 0
        if held:
            yield from emitted(parts)

    return chunks.mapInArrow(run, "bucket bigint, n bigint, filter binary")


def _merged_counts(filters: DataFrame, shape: Shape, least: int) -> DataFrame:
    """``i1, i2, i3, f`` of the phrases found at least ``least`` times; ``i3`` is 0 for two words."""

    def merge(table: pa.Table) -> pa.Table:
        parts = [
            unpacked(raw.as_py(), n.as_py(), b.as_py(), shape)
            for b, n, raw in zip(*(table.column(c) for c in ("bucket", "n", "filter")), strict=True)
        ]
        tables = []
        for total in merged_ranges(parts, shape, table.column("bucket")[0].as_py()):
            keep = total.count >= least
            words = words_of(total.high[keep], total.low[keep], shape)
            lanes = [w.astype(np.int64) for w in words] + [total.count[keep]]
            tables.append(pa.table([pa.array(x, pa.int64()) for x in lanes], ["i1", "i2", "i3", "f"]))
        return pa.concat_tables(tables)

    return filters.groupBy("bucket").applyInArrow(
        merge, "i1 bigint, i2 bigint, i3 bigint, f bigint"
    )


#: Rows that may compete for the places of a language in one task.
RANKED_ROWS = 400_000


def best_of(df: DataFrame, group: str, order: list[Column], tie: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank``, in rounds over dealt rows.

    A group of any size is first cut into parts by the hash of ``tie``; each keeps its first
    ``most`` rows, until what is left is small enough for one task a group.
    """
    rows = df.count()
    while rows > RANKED_ROWS:
        deals = rows // max(RANKED_ROWS // 2, 2 * most) + 1
        place = F.row_number().over(Window.partitionBy(group, "_deal").orderBy(*order))
        df = staged(
            df.withColumn("_deal", F.pmod(F.xxhash64(tie, F.lit(rows)), F.lit(deals)))
            .withColumn("_place", place)
            .filter(F.col("_place") <= most)
            .drop("_deal", "_place"),
            "ranked",
        )
        before, rows = rows, df.count()
        if rows * 2 > before:  # many groups: most of what is left is wanted
            break
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", place.cast("bigint")).filter(F.col("rank") <= most)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in integers of up to 38 digits."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    top = (F.lit(1_000_000).cast("decimal(7,0)") * a * a).cast("decimal(38,0)")
    return F.call_function("div", top, (left * right).cast("decimal(38,0)"))


def collocations(
    documents: DataFrame, least: int = 10, explained: int = 50, most: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the
    language. Candidates occur at least ``least`` times; one inside a candidate of three words with
    at least ``explained`` per cent of its count is dropped. A null text counts as empty, a null
    language as ``und``; empty texts have no phrases; repeated rows count as often as they are
    there; ties rank by phrase in byte order. An empty table gives no row. Other columns, doc_id
    included, are not read. Counts must stay below 10 ** 15.
    """
    chunks = staged(_chunks(documents), "chunks")
    words = chunks.select(
        "chunk", "lang", F.inline(F.arrays_zip("words", "counts")).alias("word", "count")
    )
    sums = staged(words.groupBy("lang", "word").agg(F.sum("count").alias("f")), "words")
    totals = sums.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = staged(_numbered(sums.filter(F.col("f") >= least), "frequent"), "numbered")
    size = frequent.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    shape = shape_for(size[0], 2 * size[1], BUCKET_ENTRIES)

    placed = chunks.select(
        "chunk", "lang", F.posexplode("words").alias("place", "word")
    ).join(frequent.select("lang", "word", "id"), ["lang", "word"])
    numbers = placed.groupBy("chunk").agg(
        F.collect_list(F.struct(F.col("place") + 1, "id")).alias("numbers")
    )
    coded = chunks.select("chunk", "tokens").join(numbers, "chunk").select("tokens", "numbers")
    filters = staged(_filters(coded, shape), "filters")
    grams = staged(_merged_counts(filters, shape, least), "grams")
    found = staged(_scored(grams, frequent), "phrases")

    longer = found.filter("i3 > 0")
    inside = reduce(
        DataFrame.unionByName,
        [
            longer.select(F.col(x).alias("i1"), F.col(y).alias("i2"), F.col("a").alias("longer"))
            for x, y in (("i1", "i2"), ("i2", "i3"))
        ],
    )
    inside = inside.groupBy("i1", "i2").agg(F.max("longer").alias("longer"))
    pairs = found.filter("i3 = 0").join(inside, ["i1", "i2"], "left")
    pairs = pairs.filter(
        F.col("longer").isNull() | (100 * F.col("longer") < F.lit(explained) * F.col("a"))
    ).drop("longer")
    kept = staged(
        pairs.unionByName(longer).select("lang", "phrase", "a", "l", "r", "score"), "kept"
    )
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    ranked = best_of(kept, "lang", order, "phrase", most)
    return ranked.join(F.broadcast(totals), "lang").select(  # at most `most` rows a language
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _scored(grams: DataFrame, frequent: DataFrame) -> DataFrame:
    """``i1, i2, i3, lang, phrase, a, l, r, score`` by the cut of the least score."""

    def with_word(df: DataFrame, place: int) -> DataFrame:
        # A word of f occurrences is in at most f / 10 phrases that occur ten times.
        names = {"id": f"i{place}", "word": f"w{place}", "f": f"f{place}"}
        side = frequent.select(
            *(F.col(a).alias(b) for a, b in names.items()),
            (F.col("f") / 10).cast("bigint").alias("_weight"),
            *(["lang"] if place == 1 else []),
        )
        tie = "i2" if place == 1 else "i1"
        return attach(df, side, f"i{place}", weight="_weight", tie=tie, how="inner", few=False)

    two = grams.filter("i3 = 0").withColumnRenamed("f", "a")
    three = grams.filter("i3 > 0").withColumnRenamed("f", "a")
    parts = two.select(
        F.struct(F.col("i1").alias("x"), F.col("i2").alias("y")).alias("_pair"),
        F.col("a").alias("_part"),
        (F.col("a") / 10).cast("bigint").alias("_weight"),
    )

    def with_pair(df: DataFrame, x: str, y: str, name: str, tie: str) -> DataFrame:
        df = df.withColumn("_pair", F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
        joined = attach(df, parts, "_pair", weight="_weight", tie=tie, how="inner", few=False)
        return joined.drop("_pair").withColumnRenamed("_part", name)

    two = with_word(with_word(two, 1), 2).select(
        "i1",
        "i2",
        "i3",
        "lang",
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
        "a",
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )
    three = with_pair(with_pair(three, "i1", "i2", "f12", "i3"), "i2", "i3", "f23", "i1")
    three = with_word(with_word(with_word(three, 1), 2), 3)
    first = _score(F.col("a"), F.col("f1"), F.col("f23"))
    second = _score(F.col("a"), F.col("f12"), F.col("f3"))
    three = (
        three.withColumn("_first", first)
        .withColumn("_second", second)
        .select(
            "i1",
            "i2",
            "i3",
            "lang",
            F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
            "a",
            F.when(F.col("_second") < F.col("_first"), F.col("f12")).otherwise(F.col("f1")).alias("l"),
            F.when(F.col("_second") < F.col("_first"), F.col("f3")).otherwise(F.col("f23")).alias("r"),
            F.least("_first", "_second").alias("score"),
        )
    )
    return two.unionByName(three)
