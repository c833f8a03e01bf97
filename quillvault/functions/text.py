"""Text normalisation as column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv
from quillvault.functions.barrier import settled

# Blocks in which a character that is already in NFKC form and has combining class 0 can be
# neither changed nor merged by normalisation, whatever its neighbours are.
_STABLE_BLOCKS = (
    (0x0000, 0x024F),  # Latin
    (0x0370, 0x052F),  # Greek, Cyrillic
    (0x1E00, 0x1EFF),  # Latin additional
    (0x2010, 0x2027),  # dashes, quotes
    (0x20A0, 0x20BF),  # currency
    (0x3001, 0x30FF),  # Japanese
    (0x4E00, 0x9FFF),  # CJK
)


def _stable_ranges() -> list[tuple[int, int]]:
    """Code-point ranges whose text NFKC leaves untouched, derived from the Unicode tables."""
    ranges: list[tuple[int, int]] = []
    for low, high in _STABLE_BLOCKS:
        for cp in range(low, high + 1):
            ch = chr(cp)
            if unicodedata.combining(ch) or not unicodedata.is_normalized("NFKC", ch):
                continue
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1] = (ranges[-1][0], cp)
            else:
                ranges.append((cp, cp))
    return ranges


_STABLE = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _stable_ranges() if b > 0x7F)
# An intersection is one step for most characters; a look-ahead is several for each.
NEEDS_NFKC = rf"[[^\x00-\x7F]&&[^{_STABLE}]]"

# Whitespace runs that are not already exactly one blank.
_FOLDABLE = rf"(?![!-~])[{fv.WS}](?:(?<! )|(?=[{fv.WS}]))[{fv.WS}]*"


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return pa.array(
        [None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()],
        pa.string(),
    )


def beyond_ascii(text: Column) -> Column:
    """Whether a text holds a character beyond ASCII; only counts bytes."""
    return F.octet_length(text) > F.length(text)


def nfkc(text: Column) -> Column:
    """NFKC form. Only texts holding a character that NFKC may alter visit a Python worker."""
    altered = beyond_ascii(text) & text.rlike(NEEDS_NFKC)
    return F.coalesce(_nfkc(F.when(altered, text)), text)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(text, rf"^[{fv.WS}]+|[{fv.WS}]+\z", "")


def is_blank(text: Column) -> Column:
    """Whether nothing is left after ``strip``; looks no further than the first other character."""
    return ~text.rlike(rf"[^{fv.WS}]")


def fold_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _FOLDABLE, " "))


def content_hash(text: Column) -> Column:
    """SHA-256 hex of the NFKC, whitespace-folded, trimmed text: the deduplication key."""
    return F.sha2(fold_whitespace(nfkc(text)), 256)


def with_content_hash(df: DataFrame, text: str, out: str = "doc_sha256") -> DataFrame:
    return settled(df.withColumn(out, content_hash(F.col(text))), out)


def neutralise_frames(text: Column) -> Column:
    """Make prompt frame marks inside untrusted text harmless."""
    return F.replace(text, F.lit(fv.FRAME_MARK), F.lit(fv.FRAME_MARK_SAFE))


def canonical_url(url: Column) -> Column:
    """Strip, drop trailing punctuation, then drop trailing slashes: once, in that order."""
    no_punctuation = F.regexp_replace(strip(url), rf"[{fv.URL_TRAILING}]+\z", "")
    return F.regexp_replace(no_punctuation, r"/+\z", "")


def source_ref(source_id: Column, prefix: str = fv.SOURCE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), source_id.cast("string"))
