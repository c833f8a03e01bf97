"""Personal-data spans, pseudonym tokens and answer masking as native column expressions.

A span is ``struct<start:int, end:int, category:string, value:string>`` with 0-based character
offsets. All work stays inside one row, so none of it shuffles, and all of it is linear in the
spans of a text (but for sorting them). Built-in functions find and check the matches. Running
sums, numbering and cutting have no built-in that is linear, so these go through Arrow batches,
with null in place of every text and list that has no span. The expressions are SQL text over
column names; the names of columns to work on must be plain identifiers.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv
from quillvault.functions.barrier import settled
from quillvault.functions.text import canonical_url

SPANS = "array<struct<start:int,end:int,category:string,value:string>>"
NO_SPANS = f"cast(array() AS {SPANS})"
NO_STRINGS = "cast(array() AS array<string>)"

_PATTERNS = {
    "URL": fv.URL,
    "EMAIL": fv.EMAIL,
    "IBAN": fv.IBAN,
    "IP": fv.IP,
    "PHONE": fv.PHONE,
}
# What a text must hold before a pattern can match: spares the regex on most texts. A plain class at the
# head is much faster to search for than a look-ahead.
_PHONE_PART = (
    r"[+(\p{Nd}](?:(?<=[+(])\p{Nd}|(?<=\p{Nd})[.\-]\p{Nd}"
    rf"|(?<=0)0\p{{Nd}}(?:[{fv.WS}.\-()]{{0,2}}\p{{Nd}}){{7}})"
)
_REQUIRED = {
    "URL": "contains({0}, '://')",
    "EMAIL": "contains({0}, '@')",
    "IBAN": r"rlike({0}, r'[A-Z][A-Z]\p{{Nd}}\p{{Nd}}')",
    "IP": r"rlike({0}, r'\p{{Nd}}\.\p{{Nd}}')",
    "PHONE": f"rlike({{0}}, r'{_PHONE_PART.replace('{', '{{').replace('}', '}}')}')",
}
# What a match must satisfy beyond its pattern.
_PLAUSIBLE = {
    "URL": f"rlike(s.value, r'{fv.URL_NOMINATIVE}')",
    "IP": r"forall(split(s.value, r'\.'), o -> coalesce(try_cast(o AS int) <= 255, true))",
    "PHONE": f"NOT rlike(s.value, r'{fv.ISO_DATE}') AND regexp_count(s.value, r'\\p{{Nd}}') "
    f"BETWEEN {fv.PHONE_DIGITS[0]} AND {fv.PHONE_DIGITS[1]}",
}


def matches_sql(text: str, pattern: str) -> str:
    """All non-overlapping matches, left to right."""
    return f"regexp_extract_all({text}, r'{pattern}', 0)"


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def match_starts(gaps: pa.Array, lengths: pa.Array) -> pa.Array:
    """Where every match starts, from the lengths of the text between and of the matches."""
    counts = pc.fill_null(pc.list_value_length(gaps), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    between = gaps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    matched = lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(between + matched)])
    starts = ends[1:] - matched - np.repeat(ends[offsets[:-1]], counts)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(starts.astype(np.int32)))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def free_spans(layers: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Places of the spans that overlap no kept span of an earlier layer."""
    return pa.array(
        [
            None if layer is None else _free(layer, start, end)
            for layer, start, end in zip(
                layers.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True
            )
        ],
        pa.list_(pa.int32()),
    )


def _free(layers: list[int], starts: list[int], ends: list[int]) -> list[int]:
    kept: list[int] = []
    taken: list[tuple[int, int]] = []  # of earlier layers, sorted; none overlaps another
    fresh: list[tuple[int, int]] = []
    now = None
    for i in sorted(range(len(layers)), key=layers.__getitem__):
        if layers[i] != now:
            for span in fresh:
                insort(taken, span)
            fresh, now = [], layers[i]
        before = bisect_left(taken, (ends[i], -1))
        if not before or taken[before - 1][1] <= starts[i]:
            kept.append(i)
            fresh.append((starts[i], ends[i]))
    return kept


def _numbered(categories: list[str], keys: list[str]) -> list[str]:
    """``[CATEGORY_n]``: n is the place of the key among first appearances in its category."""
    known: dict[str, dict[str, int]] = {}
    tokens = []
    for category, key in zip(categories, keys, strict=True):
        numbers = known.setdefault(category, {})
        tokens.append(f"[{category}_{numbers.setdefault(key, len(numbers) + 1)}]")
    return tokens


def _spliced(text: str, starts: list[int], ends: list[int], tokens: list[str]) -> str:
    parts, at = [], 0
    for start, end, token in zip(starts, ends, tokens, strict=True):
        parts += [text[at:start], token]
        at = end
    return "".join([*parts, text[at:]])


@F.arrow_udf(T.StringType())
def with_numbered_tokens(
    texts: pa.Array, starts: pa.Array, ends: pa.Array, categories: pa.Array, keys: pa.Array
) -> pa.Array:
    """Texts with their sorted, non-overlapping spans replaced by numbered tokens."""
    out = []
    for i, text in enumerate(texts):
        if not text.is_valid:
            out.append(None)
            continue
        tokens = _numbered(categories[i].as_py(), keys[i].as_py())
        out.append(_spliced(text.as_py(), starts[i].as_py(), ends[i].as_py(), tokens))
    return pa.array(out, pa.string())


@F.arrow_udf(T.StringType())
def spliced(texts: pa.Array, starts: pa.Array, ends: pa.Array, tokens: pa.Array) -> pa.Array:
    """Texts with their sorted, non-overlapping spans replaced by tokens."""
    out = []
    for i, text in enumerate(texts):
        if not text.is_valid:
            out.append(None)
            continue
        spans = (part[i].as_py() for part in (starts, ends, tokens))
        out.append(_spliced(text.as_py(), *spans))
    return pa.array(out, pa.string())


def with_match_spans(
    df: DataFrame, text: str, found: dict[str, tuple[str, str]], prefix: str = "_spans_"
) -> DataFrame:
    """Add ``<prefix><category>``: spans of the matches in column ``found[category]``.

    ``found`` gives per category the pattern and the column that holds its matches.
    """
    sizes, starts, spans = {}, {}, {}
    for c, (pattern, column) in found.items():
        sizes[f"_gaps_{c}"] = (
            f"CASE WHEN size({column}) > 0 THEN transform(slice(split({text}, r'{pattern}', -1), "
            f"1, size({column})), g -> length(g)) END"
        )
        sizes[f"_lengths_{c}"] = (
            f"CASE WHEN size({column}) > 0 THEN transform({column}, v -> length(v)) END"
        )
        starts[f"_starts_{c}"] = match_starts(F.col(f"_gaps_{c}"), F.col(f"_lengths_{c}"))
        spans[f"{prefix}{c}"] = (
            f"CASE WHEN size({column}) > 0 THEN zip_with(_starts_{c}, {column}, (s, v) -> "
            f"named_struct('start', s, 'end', s + length(v), 'category', '{c}', 'value', v)) "
            f"ELSE {NO_SPANS} END"
        )
    df = _add(df, sizes).withColumns(starts)
    return _add(df, spans).drop(*sizes, *starts)


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


def with_pii_spans(
    df: DataFrame,
    text: str,
    out: str = "pii_spans",
    categories: Sequence[str] = fv.PII_PRIORITY,
    entities: str | None = None,
) -> DataFrame:
    """Add the non-overlapping spans of ``text``, sorted by position.

    Categories are taken in priority order; a match of a later category survives only where no
    kept span overlaps it. ``entities`` names a column of further spans, tried last.
    """
    chosen = [c for c in fv.PII_PRIORITY if c in categories]
    given = df.columns
    df = _add(
        df,
        {
            f"_found_{c}": f"CASE WHEN {_REQUIRED[c].format(text)} "
            f"THEN {matches_sql(text, _PATTERNS[c])} ELSE {NO_STRINGS} END"
            for c in chosen
        },
    )
    df = with_match_spans(df, text, {c: (_PATTERNS[c], f"_found_{c}") for c in chosen})
    layers = [
        f"filter(_spans_{c}, s -> {_PLAUSIBLE[c]})" if c in _PLAUSIBLE else f"_spans_{c}"
        for c in chosen
    ] + ([f"coalesce({entities}, {NO_SPANS})"] if entities else [])
    if not layers:
        return df.selectExpr(*[f"`{c}`" for c in given], f"{NO_SPANS} AS {out}")
    df = with_free_spans(df, {str(i): layer for i, layer in enumerate(layers)}, "_kept")
    spans = "array_sort(transform(_kept, k -> k.span))"
    df = df.selectExpr(*[f"`{c}`" for c in given], f"{spans} AS {out}")
    return settled(df, out)


def with_free_spans(df: DataFrame, layers: dict[str, str], out: str) -> DataFrame:
    """Add ``out``: the spans of all ``layers`` (name -> list) that overlap none kept before.

    An earlier layer goes first. Elements are ``struct<layer:string, span>``.
    """
    ranked = ", ".join(
        f"transform({sql}, s -> named_struct('layer', '{name}', 'depth', {depth}, 'span', s))"
        for depth, (name, sql) in enumerate(layers.items())
    )
    given = df.columns
    df = settled(_add(df, {"_every": f"concat({ranked})"}), "_every")

    def part(field: str) -> Column:
        return F.expr(f"CASE WHEN size(_every) > 0 THEN _every.{field} END")

    df = df.withColumn("_free", free_spans(part("depth"), part("span.start"), part("span.end")))
    kept = "transform(coalesce(_free, cast(array() AS array<int>)), i -> _every[i])"
    return df.selectExpr(*[f"`{c}`" for c in given], f"{kept} AS {out}")


def with_edits_made(df: DataFrame, text: str, edits: str, out: str) -> DataFrame:
    """Add ``out``: ``text`` with ``edits`` (sorted, non-overlapping ``start, end, token``) made."""

    def part(field: str) -> Column:
        return F.expr(f"CASE WHEN size({edits}) > 0 THEN {edits}.{field} END")

    edited = F.expr(f"CASE WHEN size({edits}) > 0 THEN {text} END")
    made = spliced(edited, part("start"), part("end"), part("token"))
    return df.withColumn("_made", made).withColumn(
        out, F.when(F.expr(f"size({edits}) > 0"), F.col("_made")).otherwise(F.col(text))
    ).drop("_made")


def category_counts_sql(spans: str) -> str:
    """Occurrences per category as ``map<string,int>``."""
    return f"""cast(map_from_entries(transform(
        array_distinct(transform({spans}, s -> s.category)),
        c -> struct(c, size(filter({spans}, s -> s.category = c))))) AS map<string,int>)"""


_STRIPPED = f"regexp_replace(s.value, r'^[{fv.WS}]+|[{fv.WS}]+\\z', '')"
# Equal keys share a token; the case of an e-mail address does not matter.
_KEYS = f"""CASE WHEN size(_spans) > 0 THEN transform(_spans, s ->
    CASE WHEN s.category = 'EMAIL' THEN lower({_STRIPPED}) ELSE {_STRIPPED} END) END"""


def pseudonymise(
    df: DataFrame,
    text: str,
    out: str = "text_pseudo",
    stats: str = "pii_stats",
    categories: Sequence[str] = fv.PII_PRIORITY,
    entities: str | None = None,
) -> DataFrame:
    """Replace personal data by numbered tokens and count occurrences; not reversible."""
    given = [f"`{c}`" for c in df.columns]
    df = with_pii_spans(df, text, "_spans", categories, entities)

    def part(sql: str) -> Column:
        return F.expr(f"CASE WHEN size(_spans) > 0 THEN {sql} END")

    made = with_numbered_tokens(
        part(text), part("_spans.start"), part("_spans.end"), part("_spans.category"), F.expr(_KEYS)
    )
    df = df.withColumn("_made", made).withColumn(
        out, F.when(F.expr("size(_spans) > 0"), F.col("_made")).otherwise(F.col(text))
    )
    df = df.selectExpr(*given, out, f"{category_counts_sql('_spans')} AS {stats}")
    return settled(df, out, stats)


def tokens_passed(text: Column) -> Column:
    """Pseudonym tokens present in a text, counted per category."""
    names = F.regexp_extract_all(text, F.lit(fv.TOKEN), F.lit(1))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(names),
            lambda c: F.struct(c, F.size(F.filter(names, lambda n: n == c))),
        )
    ).cast("map<string,int>")


def text_urls(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("://")), matches(text, fv.URL)).otherwise(
        F.array().cast("array<string>")
    )


def filter_answers(
    df: DataFrame,
    text: str,
    allowed: str,
    out: str = "answer_safe",
    categories: Sequence[str] = tuple(c for c in fv.PII_PRIORITY if c != "URL"),
    strict: bool = False,
) -> DataFrame:
    """Mask raw personal data and neutralise URLs outside ``allowed`` (an array column).

    Adds ``out``, ``masked``, ``urls_neutralized``, ``tokens_passed`` and ``has_masking``. A URL
    that overlaps a masked span is left as it is around the mask; ``strict`` neutralises it.
    """
    given = [f"`{c}`" for c in df.columns]
    body = F.col(text)
    df = with_pii_spans(df, text, "_spans", categories)
    df = df.withColumns(
        {
            "_urls": text_urls(body),
            "_tokens": tokens_passed(body),
            "_allowed": F.transform(
                F.coalesce(F.col(allowed), F.array().cast("array<string>")), canonical_url
            ),
        }
    )
    df = with_match_spans(df, text, {"URL": (fv.URL, "_urls")}, prefix="_url_spans_")
    df = df.withColumnRenamed("_url_spans_URL", "_url_spans")
    df = df.withColumn(
        "_foreign",
        F.filter(
            F.col("_url_spans"),
            lambda s: ~F.array_contains(F.col("_allowed"), canonical_url(s["value"])),
        ),
    )
    first, second = ("cut", "mask") if strict else ("mask", "cut")
    found = {"mask": "_spans", "cut": "_foreign"}
    df = with_free_spans(df, {kind: found[kind] for kind in (first, second)}, "_kept")
    df = _add(
        df,
        {
            "_masks": "transform(filter(_kept, k -> k.layer = 'mask'), k -> k.span)",
            "_cuts": "filter(_kept, k -> k.layer = 'cut')",
            "_edits": f"""array_sort(transform(_kept, k -> named_struct(
                'start', k.span.start, 'end', k.span.end, 'token',
                CASE WHEN k.layer = 'cut' THEN '{fv.URL_NEUTRALISED}'
                ELSE concat('[', k.span.category, '{fv.MASK_SUFFIX}') END)))""",
        },
    )
    df = with_edits_made(settled(df, "_edits", "_masks", "_cuts"), text, "_edits", out)
    df = df.selectExpr(
        *given,
        out,
        f"{category_counts_sql('_masks')} AS masked",
        "size(_cuts) AS urls_neutralized",
        "_tokens AS tokens_passed",
        "size(_edits) > 0 AS has_masking",
    )
    return settled(df, out, "masked", "urls_neutralized", "tokens_passed", "has_masking")
