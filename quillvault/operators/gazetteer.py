"""Entity spans from a dictionary of names.

A name is one or more words with what is between them. The dictionary goes to the tasks as a trie of
two levels: a first word leads to the numbers of words that names beginning with it have, and a run of
so many words is a name or not. Found names are put beside a text in the task that reads it, so no text
is shuffled. Of a dictionary too large for one task only the names whose first word is in a text are
kept, which one pass over the texts and a join of words tell; what is still too large is dealt into
parts of bounded size, each with a pass of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv
from quillvault.functions.pii import NO_SPANS
from quillvault.operators.bits import key_filter, may_be_in
from quillvault.sources.shared import staged

#: Text of the names that go to the tasks at once; names of one word take about ten times as much there.
PART_BYTES = 16 << 20

#: Different words and characters of text after which a task hands its words on.
HELD_WORDS = 1 << 18
HELD_CHARS = 64 << 20
#: A text with more different first words of names than this is gone through word by word.
SOUGHT_WORDS = 16
#: A text with more kinds of breaks than this, beyond ASCII, is translated by characters.
BREAKS = 32

#: Signs inside words that no word ends with.
_MARKS = "#&'.-"
_SIGN = rf"{fv.WORD}#&\x27.\-"
# The look-behind keeps a long run of signs without a letter from being tried at every place.
WORDS = regex.compile(rf"(?<![{_SIGN}])[{_SIGN}]*[{fv.WORD}]")

_GOES_ON = regex.compile(rf"[#&\x27.\-]*[{fv.WORD}]")
_ONE_SIGN = regex.compile(rf"[{_SIGN}]")


class _Signs(dict):
    """A character's code -> the code, or a blank where no word has it; each is looked at once."""

    def __missing__(self, code: int) -> int:
        self[code] = kept = code if _ONE_SIGN.match(chr(code)) else 32
        return kept


_SIGNS = _Signs()
_ASCII = bytes(range(128))
_ASCII_SIGNS = bytes(_SIGNS[c] if c < 128 else c for c in range(256))

MENTION = "struct<start:int,end:int,category:string,value:string>"
_MENTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("category", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )
)

Trie = tuple[dict[str, tuple[int, ...]], dict[str, tuple[str, ...]]]
#: What a first word leads to where the trie has nothing else: names of one word need no entry.
ONE_WORD = (1,)


def trie(names: list[tuple[str, str]]) -> Trie:
    """First word -> numbers of words, fewest first; name -> its categories. Others cannot be found.

    Most dictionaries are names of one word with a category each. Such a name is one entry, and equal
    categories are one tuple.
    """
    lengths: dict[str, tuple[int, ...]] = {}
    categories: dict[str, tuple[str, ...]] = {}
    same: dict[tuple[str, ...], tuple[str, ...]] = {}
    single = set()
    for name, category in names:
        words = [m.span() for m in WORDS.finditer(name)]
        if words and words[0][0] == 0 and words[-1][1] == len(name):
            if len(words) > 1:
                first = name[: words[0][1]]
                lengths[first] = tuple(sorted({*lengths.get(first, ()), len(words)}))
            else:
                single.add(name)
            every = tuple(sorted({*categories.get(name, ()), category}))
            categories[name] = same.setdefault(every, every)
    return {w: (1, *n) if w in single else n for w, n in lengths.items()}, categories


def _runs(text: str) -> set[str]:
    """The different runs of signs in a text; a word is a run without the marks at its end."""
    if text.isascii():
        return set(text.translate(_SIGNS).split())
    # Bytes translate many times faster than characters beyond ASCII, of which a text has few kinds.
    raw = text.encode("utf-8")
    others = {c for c in raw.translate(None, _ASCII).decode("utf-8") if _SIGNS[ord(c)] == 32}
    if len(others) > BREAKS:
        return set(text.translate(_SIGNS).split())
    for c in others:
        raw = raw.replace(c.encode("utf-8"), b" ")
    return set(raw.translate(_ASCII_SIGNS).decode("utf-8").split())


def _places(text: str, word: str) -> Iterator[int]:
    """Where ``word`` stands as a whole word."""
    at = text.find(word)
    while at >= 0:
        end = at + len(word)
        whole = not at or _SIGNS[ord(text[at - 1])] == 32
        if whole and not _GOES_ON.match(text, end):
            yield at
        at = text.find(word, end if whole else at + 1)


def found_in(text: str, names: Trie) -> list[tuple[int, int, str, str]]:
    """All occurrences as (start, end, category, value), overlapping ones included, by start.

    Most words of a text begin no name. Their places are not needed; where the few others stand, a
    search for them tells.
    """
    lengths, categories = names
    words = (run.rstrip(_MARKS) for run in _runs(text))
    sought = {w for w in words if w in categories or w in lengths}
    out = []
    if len(sought) > SOUGHT_WORDS:
        words = [m.span() for m in WORDS.finditer(text)]
        for i, (start, end) in enumerate(words):
            for n in lengths.get(text[start:end], ONE_WORD):
                if i + n > len(words):
                    break
                value = text[start : words[i + n - 1][1]]
                out += [(start, start + len(value), c, value) for c in categories.get(value, ())]
        return out
    for start, word in sorted((at, word) for word in sought for at in _places(text, word)):
        most = lengths.get(word, ONE_WORD)
        ends = [start + len(word)]
        if most[-1] > 1:
            ends = [m.end() for m in islice(WORDS.finditer(text, start), most[-1])]
        for n in most:
            if n > len(ends):
                break
            value = text[start : ends[n - 1]]
            out += [(start, ends[n - 1], c, value) for c in categories.get(value, ())]
    return out


def _with_first_words(names: DataFrame) -> DataFrame:
    """``name, category, word``: the names that can be found, with their first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [WORDS.match(n) for n in batch.column("name").to_pylist()]
            first = pa.array([w and w.group() for w in words], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), batch.column("category"), first], ["name", "category", "word"]
            ).filter(first.is_valid())

    return names.select("name", "category").mapInArrow(run, "name string, category string, word string")


def _words_of(docs: DataFrame, text: str) -> DataFrame:
    """``word``: the words of all texts, each about once a task."""

    def batch_of(runs: set[str]) -> pa.RecordBatch:
        words = {run.rstrip(_MARKS) for run in runs} - {""}
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: set[str] = set()
        chars = 0
        for batch in batches:
            for value in batch.column(0):
                found = value.as_py()
                if not found:
                    continue
                runs |= _runs(found)
                chars += len(found)
                if len(runs) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield batch_of(runs)
                    runs, chars = set(), 0
        if runs:
            yield batch_of(runs)

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word string")


def occurring(names: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The names of a stored dictionary whose first word is in a text, stored: no other can be found.

    Words that no name begins with are dropped by a filter of fixed size where they are found; only
    what is left of them and the dictionary are shuffled.
    """
    known = staged(_with_first_words(names), "first_words")
    maps = staged(key_filter(known, "word"), "first_words_filter")
    words = may_be_in(_words_of(docs, text), "word", maps).distinct()
    return staged(known.join(words, "word", "left_semi").select("name", "category"), "names")


def _bytes_of(names: DataFrame) -> int:
    return names.agg(F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()[0]


def dictionary_parts(
    names: DataFrame, part_bytes: int = PART_BYTES, docs: DataFrame | None = None, text: str = "text"
) -> list[DataFrame]:
    """The different names in parts of about ``part_bytes`` of text.

    With ``docs``, names that occur in none of their texts are left out of a dictionary of several parts.
    """
    names = staged(
        names.select("name", "category").filter(F.col("name").isNotNull()).distinct(), "names"
    )
    known = _bytes_of(names)
    if names.filter(F.col("name").rlike(WORDS.pattern)).isEmpty():
        raise ValueError("the dictionary holds no name")
    if docs is not None and known > part_bytes:
        names = occurring(names, docs, text)
        known = _bytes_of(names)
    parts = -(-known // part_bytes)
    deal = F.pmod(F.xxhash64("name"), F.lit(parts))
    return [names.filter(deal == p) for p in range(parts)]


def mentions_of(part: DataFrame) -> Callable[[str], Column]:
    """Finds the names of a part in a text column: ``array<struct<start, end, category, value>>``."""
    rows = [tuple(r) for r in part.collect()]  # bounded by the bytes of a part
    shared = part.sparkSession.sparkContext.broadcast(trie(rows))

    @F.arrow_udf(_MENTIONS)
    def mentions(texts: pa.Array) -> pa.Array:
        names = shared.value
        every: list[tuple[int, int, str, str]] = []
        offsets = [0]
        for text in texts:
            every += found_in(text.as_py(), names) if text.is_valid else []
            offsets.append(len(every))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
        columns = zip(*every, strict=True) if every else [()] * len(kinds)
        found = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        spans = pa.StructArray.from_arrays(found, ["start", "end", "category", "value"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)

    return lambda text: mentions(F.col(text))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def leftmost(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Places of the spans (sorted by start) that begin at or after the end of the last one taken."""
    out = []
    for row, stops in zip(starts.to_pylist(), ends.to_pylist(), strict=True):
        taken, at = [], 0
        for i, (start, end) in enumerate(zip(row, stops, strict=True)):
            if start >= at:
                taken.append(i)
                at = end
        out.append(taken)
    return pa.array(out, pa.list_(pa.int32()))


def entity_mentions(
    docs: DataFrame, key: str, text: str, names: DataFrame, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Occurrences of dictionary names: ``key, start, end, category, value``.

    ``names`` has ``name, category``. A null text has none; a name with two categories occurs as both.
    """
    out = None
    for part in dictionary_parts(names, part_bytes):
        found = docs.select(key, F.explode(mentions_of(part)(text)).alias("m")).select(key, "m.*")
        out = found if out is None else out.unionByName(found)
    return out


def with_entities(
    docs: DataFrame,
    key: str,
    text: str,
    names: DataFrame,
    out: str = "entities",
    part_bytes: int = PART_BYTES,
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add the non-overlapping entity spans of every text: the leftmost first, the longer one at a tie.

    The array is empty where none is named. Every row stays in its task. Of a dictionary of several
    parts only names that occur are looked for; between the parts of what is left the rows with what is found so far go through ``between``, which stores them; by
    default as they are.
    """
    found = f"_{out}_found"
    docs = docs.withColumn(found, F.expr(f"cast(array() AS array<{MENTION}>)"))
    parts = dictionary_parts(names, part_bytes, docs, text)
    for i, part in enumerate(parts):
        if i:
            docs = between(docs) if between else staged(docs, "named")
        docs = docs.withColumn(found, F.concat(found, mentions_of(part)(text)))
    ordered = F.array_sort(
        F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"),
                (-m["end"]).alias("neg_end"),
                m["end"].alias("end"),
                m["category"].alias("category"),
                m["value"].alias("value"),
            ),
        )
    )
    docs = docs.withColumn("_ordered", F.when(F.size(found) > 0, ordered))
    starts = F.coalesce(F.col("_ordered.start"), F.array().cast("array<int>"))
    ends = F.coalesce(F.col("_ordered.end"), F.array().cast("array<int>"))
    docs = docs.withColumn("_taken", leftmost(starts, ends)).withColumn(
        out,
        F.expr(
            f"""CASE WHEN _ordered IS NULL THEN {NO_SPANS} ELSE transform(_taken, i -> named_struct(
            'start', _ordered[i].start, 'end', _ordered[i].end,
            'category', _ordered[i].category, 'value', _ordered[i].value)) END"""
        ),
    )
    return docs.drop(found, "_ordered", "_taken")
