"""Splitting texts into overlapping chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = ("\n\n", "\n", " ", "")


def char_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters starting every ``size - overlap``; none for empty text."""
    if not 0 < overlap < size:
        raise ValueError("overlap must lie strictly between 0 and size")
    step = size - overlap
    # One pass cuts the text into pieces of ``step`` characters; a window is its piece and as much
    # of the next ones as it needs. Counting from the start for every window would be quadratic.
    # The pieces go through an array of one element: written out, they would be cut at every mention.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    needed = -(-size // step)

    def joined(pieces: Column) -> Column:
        def window(piece: Column, i: Column) -> Column:
            more = [F.coalesce(F.get(pieces, i + j), F.lit("")) for j in range(1, needed)]
            return F.substr(F.concat(piece, *more), F.lit(1), F.lit(size))

        return F.transform(pieces, window)

    last = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / F.lit(step)).cast("int"))
    windows = F.slice(F.transform(F.array(pieces), joined)[0], F.lit(1), last)
    return F.when(F.length(text) > 0, windows).otherwise(F.array().cast("array<string>"))


def _cut(text: str, separator: str) -> list[str]:
    """Pieces of ``text``, each separator staying at the head of the piece it opens."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def _pack(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join pieces greedily up to ``size``, each chunk reusing a tail of at most ``overlap``."""
    first, total = 0, 0
    for i, piece in enumerate(pieces):
        if total + len(piece) > size and i > first:
            yield "".join(pieces[first:i])
            while first < i and (total > overlap or total + len(piece) > size):
                total -= len(pieces[first])
                first += 1
        total += len(piece)
    if first < len(pieces):
        yield "".join(pieces[first:])


def split_recursively(
    text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS
) -> list[str]:
    """Split on the coarsest separator present; pieces still too long go on to the finer ones."""
    level = next(i for i, s in enumerate(separators) if s in text)
    finer = separators[level + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _cut(text, separators[level]):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks.extend(_pack(short, size, overlap))
        short = []
        if finer:
            chunks.extend(split_recursively(piece, size, overlap, finer))
        else:
            chunks.append(piece)
    chunks.extend(_pack(short, size, overlap))
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def recursive_chunks(text: Column, size: int, overlap: int) -> Column:
    """``array<string>`` of chunks no longer than ``size`` characters, cut at natural breaks."""
    if not 0 < overlap < size:
        raise ValueError("overlap must lie strictly between 0 and size")

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else split_recursively(t, size, overlap) for t in texts.to_pylist()],
            pa.list_(pa.string()),
        )

    return split(text)


REPORTED = T.StructType(
    [T.StructField("value", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())]
)


def reporting_splitter(split: Callable[[str, int, int], list[str]]) -> Callable[[Column, int, int], Column]:
    """A splitter from a plain function; ``struct<value, error>`` with the message where it fails."""

    def splitter(text: Column, size: int, overlap: int) -> Column:
        @F.arrow_udf(REPORTED)
        def pieces(texts: pa.Array) -> pa.Array:
            found: list[list[str] | None] = []
            errors: list[str | None] = []
            for text in texts.to_pylist():
                try:
                    found.append(None if text is None else list(split(text, size, overlap)))
                    errors.append(None)
                except Exception as problem:
                    found.append(None)
                    errors.append(str(problem) or type(problem).__name__)
            return pa.StructArray.from_arrays(
                [pa.array(found, pa.list_(pa.string())), pa.array(errors, pa.string())],
                ["value", "error"],
            )

        return pieces(text)

    return splitter
