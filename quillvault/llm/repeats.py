"""Exact repeats of 100 bytes and more, with all their occurrences, by enhanced suffix arrays.

A suffix array of a whole corpus would be one sort of every byte. Here the suffixes are dealt by
content first: every 100-byte string has one anchor, the 32-byte piece in it with the least hash (the
last of equals), so equal strings have equal anchors at equal offsets, and only strings with one
anchor need to be sorted together. An anchor that occurs once ends there. For the others the bytes of
all strings of that anchor travel as one slice of at most 168 bytes; equal slices are one group.

Where an anchor has several different slices, their suffixes are sorted, neighbours' common
prefixes are counted, and a stack scan of these builds the tree of intervals with a common prefix of
100 bytes or more. An interval whose members differ in the byte to their left is a maximal repeat of
these slices. A repeat longer than its slice shows as a chain of repeats, which overlap.

A byte is covered by a 100-byte string that starts earlier elsewhere exactly if it lies in a
maximal repeat of which this is not the earliest occurrence; so these are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault.llm.tables import map_rows, staged
from quillvault.sources.shared import emptied, fresh_path

LENGTH = 100
GRAM = 32
#: Slices of one anchor that one task sorts; an anchor with more goes through grouped windows.
SORTED_SLICES = 2000
#: Suffixes sorted at once.
SORTED_AT_ONCE = 60_000
#: Places are packed with the distances to the first and last string of their anchor, 7 bits each.
SEGMENT = 1 << 19
LAST = (1 << 63) - 1
DIVERSE = 256

MULTIPLIERS = [
    0xBF58476D1CE4E5B9,
    0x94D049BB133111EB,
    0xD6E8FEB86659FD93,
    0xC2B2AE3D27D4EB4F,
    0x165667B19E3779F9,
]


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of every 32-byte piece, doubling the length five times."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    step = 1
    for m in MULTIPLIERS:
        h = h[:-step] * np.uint64(m) + h[step:]
        step *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, place, first, last) of every anchor: it is that of strings ``first`` to ``last``."""
    found = []
    for at in range(0, max(0, raw.size - length + 1), SEGMENT):
        h = gram_hashes(raw[at : at + SEGMENT + length - 1])
        n = h.size
        # High bits of the hash, then a smaller number for a later place.
        key = (h >> np.uint64(20) << np.uint64(20)) | np.arange(n - 1, -1, -1, dtype=np.uint64)
        width, least = 1, key
        while width * 2 <= length - GRAM + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = length - GRAM + 1 - width
        least = np.minimum(least[: least.size - rest], least[rest:])
        place = n - 1 - (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:] - 1, place.size - 1]
        found.append((h[place[first]], place[first] + at, first + at, last + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def identified(documents: DataFrame) -> DataFrame:
    """``doc`` orders the documents (a null id comes last); with ``tie`` it tells texts apart."""
    return documents.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """``k, doc, tie, place``; place holds the anchor's place and the reach of its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*held, strict=True)],
                names=["k", "doc", "tie", "place"],
            )

        for batch in batches:
            for doc, tie, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h, place, first, last = anchors(text_bytes(text), length)
                if not h.size:
                    continue
                reach = place << 14 | (place - first) << 7 | (place - last)
                held.append([h.view(np.int64), np.full(h.size, doc), np.full(h.size, tie), reach])
                size += h.size
                if size >= 100_000:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return texts.select("doc", "tie", "text").mapInArrow(
        run, "k bigint, doc bigint, tie bigint, place bigint"
    )


def compressed(texts: DataFrame) -> DataFrame:
    """``doc, tie, packed``: texts as zstandard, for shuffling."""

    def make():
        compress = zstandard.ZstdCompressor(level=1).compress
        return lambda doc, tie, text: [(doc, tie, compress(text.encode("utf-8", "surrogatepass")))]

    return map_rows(
        texts.select("doc", "tie", "text"), make, "doc bigint, tie bigint, packed binary", rows=200
    )


def slice_rows(joined: DataFrame, length: int) -> DataFrame:
    """``k, h, doc, tie, start, slice`` for the places of every document.

    ``h`` is a 128-bit hash of the slice; ``start`` the place of its first byte.
    """

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def one(doc, tie, packed, places):
            raw = unpack(packed)
            for p in places:
                place = p["place"] >> 14
                first = place - (p["place"] >> 7 & 127)
                piece = raw[first : place - (p["place"] & 127) + length]
                yield p["k"], xxhash.xxh3_128_digest(piece), doc, tie, first, piece

        return one

    return map_rows(
        joined.select("doc", "tie", "packed", "places"),
        make,
        "k bigint, h binary, doc bigint, tie bigint, start bigint, slice binary",
        rows=5000,
    )


class SuffixArray:
    """Sorted suffixes of at least ``length`` bytes of some slices, with their common prefixes.

    ``groups``: number of the anchor of every slice; suffixes of different anchors share nothing.
    """

    def __init__(self, slices: list[bytes], groups: np.ndarray, length: int = LENGTH):
        self.length = length
        sizes = np.array([len(s) for s in slices])
        counts = sizes - length + 1
        self.owner = np.repeat(np.arange(len(slices)), counts)
        self.offset = np.arange(self.owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
        width = int(sizes.max())
        buffer = np.frombuffer(b"".join(slices) + bytes(width), np.uint8)
        at = (np.cumsum(sizes) - sizes)[self.owner] + self.offset
        rest = sizes[self.owner] - self.offset
        rows = np.empty((at.size, width + 4), np.uint8)
        rows[:, :4] = groups[self.owner].astype(">u4").view(np.uint8).reshape(-1, 4)
        body = np.lib.stride_tricks.sliding_window_view(buffer, width)[at]
        body[np.arange(width) >= rest[:, None]] = 0
        rows[:, 4:] = body
        self.order = np.argsort(rows.view(f"S{width + 4}").ravel(), kind="stable")
        rows = rows[self.order]
        differ = rows[1:] != rows[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1) - 4, width)
        rest = rest[self.order]
        #: Common prefix of the i-th and the next suffix.
        self.common = np.minimum(first, np.minimum(rest[1:], rest[:-1]))
        # The byte to the left; before a slice's first byte anything may stand.
        left = np.where(self.offset > 0, buffer[at - 1].astype(np.int64), DIVERSE)
        self.left = left[self.order]

    def maximal_repeats(self) -> Iterator[tuple[int, int, int]]:
        """(first, last, length): intervals of the order that are maximal repeats.

        A stack holds the intervals that are still open, each with its common prefix, first suffix
        and the left byte of its members (``DIVERSE`` if they differ).
        """
        common, left = self.common, self.left
        long = common >= self.length
        starts = np.flatnonzero(long & ~np.r_[False, long[:-1]])
        ends = np.flatnonzero(long & ~np.r_[long[1:], False]) + 1
        pair = ends - starts == 1
        a = starts[pair]
        mixed = (left[a] != left[a + 1]) | (left[a] == DIVERSE)
        yield from zip(
            a[mixed].tolist(), (a[mixed] + 1).tolist(), common[a[mixed]].tolist(), strict=True
        )
        for a, b in zip(starts[~pair].tolist(), ends[~pair].tolist(), strict=True):
            heights = [*common[a:b].tolist(), 0]
            stack: list[list[int]] = []
            for i, (height, byte) in enumerate(zip(heights, left[a : b + 1].tolist(), strict=True), a):
                begin = i
                while stack and stack[-1][0] > height:
                    size, begin, seen = stack.pop()
                    byte = byte if byte == seen else DIVERSE
                    if byte == DIVERSE:
                        yield begin, i, size
                if stack and stack[-1][0] == height:
                    if stack[-1][2] != byte:
                        stack[-1][2] = DIVERSE
                elif height:
                    stack.append([height, begin, byte])

    def later_occurrences(self, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
        """(slice, from, to) of bytes in a maximal repeat that also occurs earlier, merged.

        ``doc`` and ``start`` place the slices; earlier is a smaller document, or a smaller place
        in the same one.
        """
        place = start[self.owner] + self.offset
        by = np.lexsort((place, doc[self.owner]))
        d, p = doc[self.owner][by], place[by]
        rank = np.empty(by.size, np.int64)
        rank[by] = np.cumsum(np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1])])
        longest = np.zeros(by.size, np.int64)
        twos: list[tuple[int, int]] = []
        for a, b, size in self.maximal_repeats():
            if b == a + 1:
                twos.append((a, size))
                continue
            members = self.order[a : b + 1]
            ranks = rank[members]
            later = members[ranks > ranks.min()]
            longest[later] = np.maximum(longest[later], size)
        if twos:
            a, size = np.array(twos).T
            x, y = self.order[a], self.order[a + 1]
            later = np.where(rank[x] > rank[y], x, y)
            differ = rank[x] != rank[y]
            np.maximum.at(longest, later[differ], size[differ])
        hit = np.flatnonzero(longest)
        begin = self.owner[hit] << 20 | self.offset[hit]
        reach = np.maximum.accumulate(begin + longest[hit]) if hit.size else begin
        new = np.r_[True, begin[1:] > reach[:-1]] if hit.size else np.zeros(0, bool)
        last = np.r_[np.flatnonzero(new)[1:] - 1, hit.size - 1] if hit.size else np.zeros(0, int)
        low = (1 << 20) - 1
        return self.owner[hit[new]], begin[new] & low, reach[last] & low


def in_batches(
    rows: DataFrame, apply: Callable[[list[tuple]], Iterator[tuple]], schema: str, length: int
) -> DataFrame:
    """``apply`` on the rows of whole anchors, several at once, sorted by anchor in each task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = rows.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def done():
            columns = list(zip(*apply(held), strict=True)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SORTED_AT_ONCE and row[0] != held[-1][0]:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[-1]) - length + 1
        if held:
            yield done()

    return (
        rows.select("k", "h", "doc", "tie", "start", "slice")
        .repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(run, target)
    )


def array_of(held: list[tuple], length: int) -> SuffixArray:
    groups = np.unique(np.array([r[0] for r in held]), return_inverse=True)[1]
    return SuffixArray([r[5] for r in held], groups, length)


def later_in_sorted(rows: DataFrame, length: int) -> DataFrame:
    """``doc, tie, start, end`` of later occurrences among the different slices of each anchor."""

    def apply(held):
        doc = np.array([r[2] for r in held])
        start = np.array([r[4] for r in held])
        for i, a, b in zip(*array_of(held, length).later_occurrences(doc, start), strict=True):
            row = held[i]
            yield row[2], row[3], row[4] + int(a), row[4] + int(b)

    return in_batches(rows, apply, "doc bigint, tie bigint, start bigint, end bigint", length)


def later_in_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different slices, by grouping single strings.

    Least places per string are summed up in each task before they are shuffled, so no task holds an
    anchor.
    """

    def make():
        def one(doc, tie, start, piece):
            for i in range(len(piece) - length + 1):
                yield xxhash.xxh3_128_digest(piece[i : i + length]), doc, tie, start + i

        return one

    strings = staged(
        map_rows(
            rows.select("doc", "tie", "start", "slice"),
            make,
            "w binary, doc bigint, tie bigint, start bigint",
            rows=20000,
        ),
        "strings",
    )
    first = (
        strings.groupBy("w")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "start")).alias("first"))
        .filter("n > 1")
        .drop("n")
    )
    first = staged(first, "firsts")
    return (
        strings.join(first, "w")
        .filter(F.struct("doc", "start") > F.col("first"))
        .select("doc", "tie", "start", (F.col("start") + length).alias("end"))
    )


def differ(column: str) -> Column:
    """Whether the bytes of a group differ; ``DIVERSE`` differs from itself."""
    return (F.min(column) != F.max(column)) | (F.max(column) == DIVERSE)


def groups_of_many(rows: DataFrame, length: int) -> DataFrame:
    """``repeat, size, k, h, at``: maximal repeats of anchors with very many different slices.

    Equal strings lie at one distance from their anchor, so a group has each slice once. Only a single
    string that follows different bytes can start a maximal repeat; of these, all extensions are
    grouped, and those that different bytes follow as well are maximal. These are sums that each task
    begins, so no task holds an anchor.
    """

    def make():
        def one(k, h, piece):
            for i in range(len(piece) - length + 1):
                left = piece[i - 1] if i else DIVERSE
                yield xxhash.xxh3_128_digest(piece[i : i + length]), k, h, i, left

        return one

    strings = staged(
        map_rows(rows.select("k", "h", "slice"), make, "w binary, k bigint, h binary, at bigint, left int", rows=20000),
        "strings",
    )
    starts = strings.groupBy("w").agg(F.count("*").alias("n"), differ("left").alias("open"))
    starts = staged(starts.filter("n > 1 AND open").select("w"), "starts")
    begun = strings.join(starts, "w").groupBy("k", "h").agg(F.collect_list(F.struct("at", "left")).alias("starts"))
    begun = staged(begun, "begun")

    def extend():
        def one(k, h, piece, starts):
            for s in starts:
                at = s["at"]
                for end in range(at + length, len(piece) + 1):
                    after = piece[end] if end < len(piece) else DIVERSE
                    yield hashlib.sha256(piece[at:end]).digest(), end - at, k, h, at, s["left"], after

        return one

    longer = staged(
        map_rows(
            rows.select("k", "h", "slice").join(begun, ["k", "h"]).select("k", "h", "slice", "starts"),
            extend,
            "repeat binary, size bigint, k bigint, h binary, at bigint, left int, after int",
            rows=20000,
        ),
        "extensions",
    )
    maximal = longer.groupBy("repeat").agg(
        F.count("*").alias("n"), differ("left").alias("open"), differ("after").alias("ends")
    )
    maximal = staged(maximal.filter("n > 1 AND open AND ends").select("repeat"), "maximal")
    return longer.join(maximal, "repeat").select(
        F.lower(F.hex("repeat")).alias("repeat"), "size", "k", "h", "at"
    )


class Found:
    """Stored tables that repeats are read from; large ones are emptied once they are used up."""

    def __init__(self, documents: DataFrame, length: int):
        self.length = length
        self.spark = documents.sparkSession
        self.stored: dict[str, tuple[str, DataFrame]] = {}
        self.texts = texts = identified(documents)
        self.base = base = staged(
            texts.select(
                "doc_id", "doc", "tie", F.octet_length("text").cast("bigint").alias("n_bytes"),
                F.sha2("text", 256).alias("sha"),
            ),
            "texts",
        )
        # Sides that come from sums are stored before a join, since only plain exchanges on both
        # sides let Spark split the rows of a hot key over several tasks.
        first = base.groupBy("sha").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n"))
        first = staged(first.filter("n > 1").drop("n"), "repeated")
        #: Texts that a smaller document has as well: nothing of them is an earliest occurrence.
        self.copies = staged(
            base.join(first, "sha")
            .filter("doc > first_doc")
            .select("doc", "tie", "first_doc")
            .distinct(),
            "copies",
        )
        places = self.store(anchor_rows(texts, length), "anchors")
        often = places.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k")
        often = self.store(often, "often")
        by_text = (
            places.join(often, "k")
            .groupBy("doc", "tie")
            .agg(F.collect_list(F.struct("k", "place")).alias("places"))
            .join(self.copies, ["doc", "tie"], "left_anti")
        )
        by_text = self.store(by_text, "places")
        self.drop("anchors", "often")
        #: One row per slice of an anchor that occurs more than once.
        self.slices = self.store(
            slice_rows(compressed(texts).join(by_text, ["doc", "tie"]), length), "slices"
        )
        self.drop("places")
        #: One row per different slice, with its earliest occurrence.
        self.distinct = self.store(
            self.slices.groupBy("k", "h")
            .agg(
                F.count("*").alias("n"),
                F.min(F.struct("doc", "start", "tie", "slice")).alias("first"),
            )
            .select("k", "h", "n", "first.*"),
            "different",
        )
        several = self.distinct.groupBy("k").agg(F.count("*").alias("m")).filter("m > 1")
        several = staged(several, "several")
        #: The different slices of anchors that have several.
        self.contested = self.store(self.distinct.join(several, "k"), "contested")

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        table = staged(df, name, path)
        self.stored[name] = (path, table)
        return table

    def drop(self, *names: str) -> None:
        for name in names:
            path, table = self.stored.pop(name)
            emptied(self.spark, path, table.schema)

    def later(self) -> DataFrame:
        """``doc, tie, start, end`` (may overlap) of all later occurrences outside of copies."""
        first = self.distinct.filter("n > 1").select(
            "k", "h", F.struct("doc", "start").alias("first")
        )
        again = (
            self.slices.select("k", "h", "doc", "tie", "start", F.octet_length("slice").alias("size"))
            .join(first, ["k", "h"])
            .filter(F.struct("doc", "start") > F.col("first"))
            .select("doc", "tie", "start", (F.col("start") + F.col("size")).alias("end"))
        )
        few = self.contested.filter(F.col("m") <= SORTED_SLICES)
        many = self.contested.filter(F.col("m") > SORTED_SLICES)
        return again.unionByName(later_in_sorted(few, self.length)).unionByName(
            later_in_windows(many, self.length)
        )


def repeat_groups(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``repeat, size, doc_id, start``: maximal repeats of the slices with all their occurrences.

    ``repeat`` is the SHA-256 of the bytes. A copy of a whole earlier text has the occurrences of that
    text. A null doc_id is null here as well.
    """
    found = Found(documents, length)

    def apply(held):
        array = array_of(held, length)
        for a, b, size in array.maximal_repeats():
            for s in array.order[a : b + 1].tolist():
                row, at = held[array.owner[s]], int(array.offset[s])
                name = hashlib.sha256(row[5][at : at + size]).hexdigest()
                yield name, size, row[0], row[1], at

    inner = in_batches(
        found.contested.filter(F.col("m") <= SORTED_SLICES),
        apply,
        "repeat string, size bigint, k bigint, h binary, at bigint",
        length,
    )
    many = groups_of_many(found.contested.filter(F.col("m") > SORTED_SLICES), length)
    # A slice that occurs more than once, be it in a copy, is a repeat as a whole.
    copied = staged(
        found.copies.select(F.col("first_doc").alias("doc"), "tie").distinct(), "copied"
    )
    again = found.distinct.filter("n > 1").select("k", "h", "slice")
    again = again.unionByName(found.slices.join(copied, ["doc", "tie"]).select("k", "h", "slice"))
    whole = again.select(
        F.sha2("slice", 256).alias("repeat"), F.octet_length("slice").cast("bigint").alias("size"),
        "k", "h", F.lit(0).cast("bigint").alias("at"),
    )
    groups = staged(inner.unionByName(many).unionByName(whole).distinct(), "groups")
    places = groups.join(found.slices.select("k", "h", "doc", "tie", "start"), ["k", "h"]).select(
        "repeat", "size", "doc", "tie", (F.col("start") + F.col("at")).alias("start")
    )
    places = staged(places, "occurrences")
    copies = found.copies.select(F.col("doc").alias("copy"), F.col("first_doc").alias("doc"), "tie")
    in_copies = places.join(copies, ["doc", "tie"]).select(
        "repeat", "size", F.col("copy").alias("doc"), "start"
    )
    return (
        places.drop("tie")
        .unionByName(in_copies)
        .select(
            "repeat", "size", F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "start"
        )
        .distinct()
    )


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without ``spans``, bytes removed, and maximal runs removed."""
    out, at, removed, runs = [], 0, 0, 0
    end = -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            out.append(raw[at:a])
            removed += b - a
            end = at = b
        elif b > end:
            removed += b - end
            end = at = b
    return b"".join([*out, raw[at:]]), removed, runs


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a ``length``-byte string over it also starts earlier: in a smaller doc_id, or at
    a smaller place of the same one; strings are judged on the input. A null text is empty. A null
    doc_id comes after all others. Rows with one doc_id are one document: equal places in them are
    not earlier than each other, and repeated rows get equal results. Other columns are not read.
    """
    found = Found(documents, length)
    spans = (
        found.later()
        .groupBy("doc", "tie")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    spans = staged(spans, "spans")
    found.drop("slices", "different", "contested")

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def one(doc, tie, packed, spans):
            kept, removed, runs = kept_bytes(unpack(packed), [(s["start"], s["end"]) for s in spans])
            return [(doc, tie, removed, runs, hashlib.sha256(kept).hexdigest())]

        return one

    cut = map_rows(
        compressed(found.texts).join(spans, ["doc", "tie"]).select("doc", "tie", "packed", "spans"),
        make,
        "doc bigint, tie bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )
    cut = staged(cut, "cut").dropDuplicates(["doc", "tie"])
    whole = (F.col("first_doc").isNotNull()) & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("bigint")

    def pick(when_copy: Column, otherwise: Column, name: str) -> Column:
        return F.when(whole, when_copy).otherwise(F.coalesce(F.col(name), otherwise)).alias(name)

    return (
        found.base.join(found.copies, ["doc", "tie"], "left")
        .join(cut, ["doc", "tie"], "left")
        .select(
            "doc_id",
            "n_bytes",
            pick(F.col("n_bytes"), zero, "n_removed"),
            pick(F.lit(1).cast("bigint"), zero, "n_spans"),
            pick(F.sha2(F.lit(""), 256), F.col("sha"), "kept_sha256"),
        )
    )
