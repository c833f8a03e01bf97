"""Personal data: four fixed forms, and identifiers that bootstrapped contexts give away.

Base spans come from fixed patterns and checks. They are the seeds. A text is cut into words at white
space, once and for all purposes. Every seed, and every other word or run of numbers after single
blanks that looks like an identifier, is linked to its lexical patterns: the two words before it,
and the word before with the word after. The weight of a pattern is the share of **all** words in its
context in the corpus that are known identifiers of a kind; the weight of an instance is the chance
that at least one of its strong patterns is right. A few rounds of this over the pattern-instance
graph, each two grouped sums in Spark, let strong patterns find new identifiers, and these
strengthen further patterns.

The graph alone tells which patterns could ever be strong: those with enough seeds, or with enough
instances of patterns that could be. Only their contexts are counted over the corpus.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillvault.llm.tables import map_rows, staged, unused

KINDS = ("email", "ip", "card", "phone")

#: The base forms. The look-behind of IP only saves time: a match always starts at
#: the first digit of its run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WORD = re.compile(r"\S+")
EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*#%&$"
#: Where a word with four digits or an @ is; from a digit on, no word is read more than three times.
LIKELY = re.compile(r"@|[0-9](?:[^0-9\s]*+[0-9]){3}")
#: Numbers after single blanks, as in "(020) 7946 0018" or "555 - 123 4567".
NUMBER = r"[0-9]++(?:[.()\[\]-]{1,2}[0-9]++)*"
RUN = re.compile(
    rf"(?<![^\x00-\x20{re.escape(EDGES)}])[+(\[]{{0,2}}{NUMBER}(?:[)\]]?\x20(?:-\x20)?[(\[]?{NUMBER})+"
    rf"(?![^\x00-\x20{re.escape(EDGES)}])"
)
BLANK = re.compile(r"[0-9][)\]]?\x20(?:-\x20)?[(\[]?[0-9]")

STRONG = 0.8
SEEDS = 3
ROUNDS = 3
#: Bits of the filters that say which words and contexts are worth counting; a constant, whatever the
#: input.
BITS = 1 << 23
#: Words of which a task remembers whether a wanted context has them before its place.
HELD_WORDS = 200_000
#: The place of an identifier in its patterns; no word holds white space.
PLACE = "\t"
#: Words and instances longer than this are known by their digest.
SHOWN_CHARS = 64
#: Contexts that a task counts before it hands on their sums.
HELD_COUNTS = 100_000

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches. Looking back from every @ keeps long runs of letters linear."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then by kind as listed."""
    found = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def named(word: str) -> str:
    """A word as patterns and the graph hold it: itself, or its digest if it is long."""
    if len(word) <= SHOWN_CHARS:
        return word
    return "#" + hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def plain(word: str) -> str:
    return named(word.strip(EDGES).lower())


def looks_like_identifier(word: str) -> bool:
    return len(word) >= 6 and ("@" in word or sum(map(word.count, "0123456789")) >= 4)


def pattern_before(two: str, one: str) -> str | None:
    """The pattern of a place by the two words before it."""
    return f"{two} {one} {PLACE}" if two and one else None


def pattern_around(one: str, after: str) -> str | None:
    """The pattern of a place by the word before and the word after it."""
    return f"{one} {PLACE} {after}" if one and after else None


def runs_between(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """(start, end) of identifiers written with blanks: the longest runs of numbers between base spans."""
    out = []
    at = 0
    for x, y in [*sorted((a, b) for _, a, b in base), (len(text), len(text))]:
        for m in RUN.finditer(text, at, x) if x > at else ():
            a, b = m.span()
            for left, right in ("()", "[]"):
                if text[a] == left and right not in m[0]:
                    a += 1
            if looks_like_identifier(text[a:b]):
                out.append((a, b))
        at = max(at, y)
    return out


def occurrences(text: str, base: list[Span]) -> list[tuple]:
    """(kind or None, start, end, instance, patterns, more) of seeds and other likely identifiers.

    The place of an identifier is the words that it touches. ``more`` are those of its patterns whose
    context has one place more than the words of the text tell: a place of several words, and a
    place that an earlier identifier has too.
    """
    blanks = BLANK.search(text)
    if not base and not blanks and not LIKELY.search(text):
        return []
    spots = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in spots]
    found = [(kind, a, b) for kind, a, b in base]
    found += [(None, a, b) for a, b in single_words(text, spots, base)]
    if blanks:
        found += [(None, a, b) for a, b in runs_between(text, base)]

    def word(i: int) -> str:
        return plain(text[slice(*spots[i])]) if 0 <= i < len(spots) else ""

    out = []
    firsts: set[int] = set()
    alone: set[int] = set()
    for kind, a, b in found:
        i, j = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
        before = pattern_before(word(i - 2), word(i - 1))
        around = pattern_around(word(i - 1), word(j + 1))
        more = [before] if before and i in firsts else []
        if around and (j > i or i in alone):
            more.append(around)
        firsts.add(i)
        if i == j:
            alone.add(i)
        patterns = [p for p in (before, around) if p]
        out.append((kind, a, b, named(text[a:b].lower()), patterns, more))
    return out


def single_words(text: str, spots: list[tuple[int, int]], base: list[Span]) -> Iterator[tuple[int, int]]:
    """(start, end) of words that look like identifiers and touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    t = 0
    for x, y in spots:
        if y - x < 6:
            continue
        word = text[x:y].strip(EDGES)
        if not looks_like_identifier(word):
            continue
        a = text.index(word, x, y)
        b = a + len(word)
        while t < len(taken) and taken[t][1] <= a:
            t += 1
        if t == len(taken) or taken[t][0] >= b:
            yield a, b


def slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BITS


class Filter:
    """Bits of the values of a column; ``in`` may be wrong for others, rarely."""

    def __init__(self, values: DataFrame):
        """``values`` has one column of strings."""
        name = values.columns[0]
        # The bitmap functions count from 1.
        slot_of = F.pmod(F.crc32(F.col(name).cast("binary")), F.lit(BITS)) + 1
        filled = (
            values.select(slot_of.alias("s"))
            .groupBy(F.bitmap_bucket_number("s").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
            .collect()  # at most BITS / 32768 rows of 4 KB
        )
        self.bits = {row["bucket"]: bytes(row["bits"]) for row in filled}

    def __contains__(self, value: str) -> bool:
        s = slot(value)
        position = s % 32768
        bucket = self.bits.get(s // 32768 + 1)
        return bucket is not None and bool(bucket[position // 8] >> (position % 8) & 1)


class _Heads(dict):
    """Word of a text -> whether a wanted context may have it before its place."""

    def __init__(self, heads: Filter):
        super().__init__()
        self.heads = heads

    def __missing__(self, word: str) -> bool:
        if len(self) >= HELD_WORDS:
            self.clear()
        held = plain(word) in self.heads
        if len(word) <= SHOWN_CHARS:
            self[word] = held
        return held


def found_in(documents: DataFrame) -> DataFrame:
    """Stored, one row per input row: base spans with counts, and occurrences with patterns."""

    def make():
        def one(doc_id, text):
            text = text or ""
            base = base_spans(text)
            kinds = [k for k, _, _ in base]
            spans = joined(base)
            return [
                (
                    doc_id,
                    *(kinds.count(k) for k in KINDS),
                    hashlib.sha256(spans.encode()).hexdigest(),
                    spans,
                    occurrences(text, base),
                )
            ]

        return one

    rows = map_rows(
        documents.select("doc_id", "text"),
        make,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, base string, occurrences array<struct<kind: string, start: bigint, "
        "end: bigint, instance: string, patterns: array<string>, more: array<string>>>",
    )
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "personal")


def context_totals(documents: DataFrame, wanted: DataFrame, more: DataFrame) -> DataFrame:
    """``pattern, total``: how many places of the corpus each wanted context has.

    Every word is a place; ``more`` (``pattern, n``) are those beyond. Two filters of constant size
    say which words a wanted context may have before its place, and which contexts are wanted; what
    they let through by chance falls out in the join.
    """
    words = F.split("pattern", " ")
    head = F.when(words[2] == PLACE, words[1]).otherwise(words[0])
    known, heads = Filter(wanted.select("pattern")), Filter(wanted.select(head.alias("head")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        held = _Heads(heads)

        def summed():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["pattern", "n"],
            )

        for batch in batches:
            for value in batch.column(0):
                words = (value.as_py() or "").split()
                last = len(words) - 1
                for i in [i for i, w in enumerate(words) if held[w]]:
                    if i == last:
                        continue
                    one = plain(words[i])
                    for p in (
                        pattern_before(plain(words[i - 1]), one) if i else None,
                        pattern_around(one, plain(words[i + 2])) if i + 2 <= last else None,
                    ):
                        if p and p in known:
                            counts[p] = counts.get(p, 0) + 1
                if len(counts) >= HELD_COUNTS:
                    yield summed()
                    counts.clear()
        if counts:
            yield summed()

    counted = documents.select("text").mapInArrow(run, "pattern string, n bigint")
    # An inner join stays above the sums; a semi-join would be moved below them.
    sums = counted.unionByName(more).groupBy("pattern").agg(F.sum("n").alias("total"))
    return sums.join(wanted, "pattern")


def could_be_strong(edges: DataFrame) -> DataFrame:
    """``pattern``: those with enough seeds of a kind, or enough instances of such patterns.

    Shares are at most 1 whatever the totals, so no other pattern is strong in any round.
    """
    seeds = edges.filter("kind IS NOT NULL").select("pattern", "instance", "kind")
    others = edges.filter("kind IS NULL").select("pattern", "instance")
    known, patterns = seeds, None
    for _ in range(ROUNDS):
        patterns = staged(
            known.groupBy("pattern", "kind").count().filter(F.col("count") >= SEEDS).drop("count"),
            "possible",
        )
        instances = others.join(patterns, "pattern").select("instance", "kind").distinct()
        known = seeds.unionByName(others.join(instances, "instance").select(*seeds.columns))
    return patterns.select("pattern").distinct()


def strong_instances(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``instance, kind`` of identifiers that are no seeds and follow from strong patterns."""
    listed = found.select(F.explode("occurrences").alias("o"))
    edges = (
        listed.select("o.kind", "o.instance", F.explode("o.patterns").alias("pattern"))
        .groupBy("pattern", "instance", "kind")
        .agg(F.count("*").alias("n"))
    )
    edges = staged(edges, "patterns")
    wanted = staged(could_be_strong(edges), "wanted")
    more = listed.select(F.explode("o.more").alias("pattern"), F.lit(1).cast("bigint").alias("n"))
    totals = staged(context_totals(documents, wanted, more), "contexts")
    graph = staged(edges.join(totals, "pattern"), "graph")
    seeds = graph.filter("kind IS NOT NULL").select("pattern", "instance", "kind", "n", "total")
    others = graph.filter("kind IS NULL").select("pattern", "instance", "n", "total")
    known = seeds.withColumn("weight", F.lit(1.0))
    accepted = None
    for _ in range(ROUNDS):
        patterns = (
            known.groupBy("pattern", "kind")
            .agg(
                (F.sum(F.col("n") * F.col("weight")) / F.max("total")).alias("share"),
                F.count("*").alias("support"),
            )
            .filter((F.col("share") >= STRONG) & (F.col("support") >= SEEDS))
        )
        accepted = staged(
            others.select("pattern", "instance")
            .join(patterns.select("pattern", "kind", "share"), "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(1.000001 - F.least("share", F.lit(1.0)))))).alias("weight"))
            .filter(F.col("weight") >= STRONG),
            "accepted",
        )
        known = seeds.withColumn("weight", F.lit(1.0)).unionByName(
            others.join(accepted, "instance").select(*seeds.columns, "weight")
        )
    return accepted.groupBy("instance").agg(
        F.max_by("kind", F.struct("weight", "kind")).alias("kind")
    )


def personal_data(documents: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, counts and digest of base spans, and all ``spans``.

    Offsets count code points. Null and empty texts have no spans. Repeated rows stay repeated with
    equal results; a null doc_id stays null; other columns are not read. Spans are ordered by
    start, then kind as listed; an added span never overlaps a base span, and a number within an
    added run of numbers is not listed again.
    """
    found = found_in(documents)
    accepted = strong_instances(documents, found)
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    added = (
        found.select("row", F.explode("occurrences").alias("o"))
        .filter("o.kind IS NULL")
        .select("row", "o.start", "o.end", "o.instance")
        .join(accepted, "instance")
        .withColumn("reach", F.max("end").over(earlier))
        .filter("reach IS NULL OR end > reach")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    both = found.join(added, "row", "left")
    return both.select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        "base_sha256",
        F.when(F.col("added").isNull(), F.col("base")).otherwise(_merged()).alias("spans"),
    )


def _merged():
    """Base and added spans as one string in order."""
    base = F.transform(
        F.filter("occurrences", lambda o: o["kind"].isNotNull()),
        lambda o: F.struct(o["start"], o["kind"], o["end"]),
    )
    added = F.transform("added", lambda o: F.struct(o["start"], o["kind"], o["end"]))
    rank = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(
        F.transform(
            F.concat(base, added),
            lambda o: F.struct(
                o["start"].alias("start"),
                F.array_position(rank, o["kind"]).alias("rank"),
                o["end"].alias("end"),
                o["kind"].alias("kind"),
            ),
        )
    )
    return F.array_join(
        F.transform(ordered, lambda o: F.concat_ws(":", o["kind"], o["start"], o["end"])), ","
    )


def mask_personal_data(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of its texts replaced by its kind, as ``[EMAIL]``.

    Overlapping spans become one mark, named after the first. ``n_chars``, where it exists, is set
    to the new length. All columns and rows stay; null texts stay null.
    """
    row, found_spans = unused(documents, "_row"), unused(documents, "_spans")
    kept = staged(documents.withColumn(row, F.monotonically_increasing_id()), "masking")
    found = found_in(kept.select(F.col(row).alias("doc_id"), "text"))
    accepted = strong_instances(kept, found)
    spans = (
        found.select(F.col("doc_id").alias(row), F.explode("occurrences").alias("o"))
        .select(row, "o.kind", "o.start", "o.end", "o.instance")
        .join(accepted.withColumnRenamed("kind", "found_kind"), "instance", "left")
        .select(row, "start", "end", F.coalesce("kind", "found_kind").alias("kind"))
        .filter("kind IS NOT NULL")
        .groupBy(row)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias(found_spans))
    )
    # Merged whatever the size, so that a small run has the plan of a large one.
    both = kept.hint("merge").join(spans, row, "left").select(*documents.columns, found_spans)
    counted = "n_chars" in documents.columns
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(found_spans)
            columns = {name: batch.column(name) for name in schema.names}
            hit = {i for i in range(batch.num_rows) if spans[i].is_valid}
            if hit:
                texts = [
                    mask(t.as_py(), spans[i].as_py()) if i in hit else t.as_py()
                    for i, t in enumerate(columns["text"])
                ]
                columns["text"] = pa.array(texts, batch.schema.field("text").type)
                if counted:
                    lengths = [
                        len(texts[i]) if i in hit else n.as_py()
                        for i, n in enumerate(columns["n_chars"])
                    ]
                    columns["n_chars"] = pa.array(lengths, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return both.mapInArrow(run, schema)


def mask(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    out, at = [], 0
    for s in spans:
        start, end, kind = s["start"], s["end"], s["kind"]
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
