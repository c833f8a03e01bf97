"""Text vectors. The default model hashes words; any other model plugs in as a column function."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv

Embedder = Callable[[Column], Column]


#: Words whose dimension a worker remembers: a small batch shares most of its words with those before.
KNOWN_WORDS = 1 << 17


@lru_cache(KNOWN_WORDS)
def _bucket(word: str, dim: int) -> int:
    return int.from_bytes(hashlib.md5(word.encode("utf-8")).digest()[:4], "big") % dim


def hashing_embedder(dim: int) -> Embedder:
    """Unit-length word-count vectors: each lower-cased word adds one to its hashed dimension."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pa.Array) -> pa.Array:
        words = pc.split_pattern_regex(
            pc.fill_null(pc.utf8_lower(texts), ""), r"[^\p{L}\p{N}]+"
        )
        coded = pc.dictionary_encode(words.flatten())
        vocabulary = coded.dictionary.to_numpy(zero_copy_only=False)
        buckets = np.fromiter(map(_bucket, vocabulary, repeat(dim)), np.int64, len(vocabulary))
        buckets[vocabulary == ""] = -1
        column = buckets[np.asarray(coded.indices)] if len(vocabulary) else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(words)))
        real = column >= 0
        counts = np.bincount(
            row[real] * dim + column[real], minlength=len(texts) * dim
        ).reshape(len(texts), dim)
        norms = np.sqrt((counts.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
        vectors = (counts / np.where(norms > 0, norms, 1.0)).astype(np.float32)
        offsets = np.arange(0, len(texts) * dim + 1, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    return lambda text: embed(text)


def _or_message(call: Callable[[], object]) -> tuple[object, str | None]:
    """What a call gives, or the text of the exception it ends with."""
    try:
        return call(), None
    except Exception as problem:
        return None, str(problem) or type(problem).__name__


def _in_halves(embed: Callable[[list[str]], list], texts: list[str]) -> list[tuple[object, str | None]]:
    """Vector and error of every text. A batch that fails is halved until single texts are left."""

    def batch() -> list:
        found = list(embed(texts))
        if len(found) != len(texts):
            raise ValueError("as many vectors as texts are needed")
        return found

    found, problem = _or_message(batch)
    if problem is None:
        return [(vector, None) for vector in found]
    if len(texts) == 1:
        return [(None, problem)]
    half = len(texts) // 2
    return _in_halves(embed, texts[:half]) + _in_halves(embed, texts[half:])


def tolerant_embedder(embed: Callable[[list[str]], list[list[float] | None]]) -> Embedder:
    """An embedder from a plain function over texts; a text it fails on gets a null vector.

    When a whole batch fails its halves are tried, so a bad text costs only itself.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(texts: pa.Array) -> pa.Array:
        found = _in_halves(embed, [t or "" for t in texts.to_pylist()]) if len(texts) else []
        return pa.array([vector for vector, _ in found], pa.list_(pa.float32()))

    return lambda text: vectors(text)


REPORTED = T.StructType(
    [T.StructField("value", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
)


def reporting_embedder(embed: Callable[[list[str]], list[list[float] | None]]) -> Embedder:
    """As ``tolerant_embedder``, with the message of the failure: ``struct<value, error>``."""

    @F.arrow_udf(REPORTED)
    def vectors(texts: pa.Array) -> pa.Array:
        found = _in_halves(embed, [t or "" for t in texts.to_pylist()]) if len(texts) else []
        return pa.StructArray.from_arrays(
            [
                pa.array([vector for vector, _ in found], pa.list_(pa.float32())),
                pa.array([error for _, error in found], pa.string()),
            ],
            ["value", "error"],
        )

    return lambda text: vectors(text)


def checked(vector: Column, dim: int) -> Column:
    """The vector as float32; null where its length is not ``dim`` or an element is null."""
    return F.when(
        (F.size(vector) == dim) & ~F.exists(vector, lambda x: x.isNull()),
        vector.cast("array<float>"),
    )


def embed_documents(text: Column, model: Embedder, dim: int) -> Column:
    return checked(model(F.concat(F.lit(fv.DOCUMENT_PREFIX), text)), dim)


def embed_questions(text: Column, model: Embedder, dim: int) -> Column:
    return checked(model(F.concat(F.lit(fv.QUERY_PREFIX), text)), dim)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; null where either norm is zero."""

    def total(products: Column) -> Column:
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    def times(x: Column, y: Column) -> Column:
        return x.cast("double") * y.cast("double")

    norms = F.sqrt(total(F.zip_with(a, a, times))) * F.sqrt(total(F.zip_with(b, b, times)))
    return F.when(norms > 0, total(F.zip_with(a, b, times)) / norms)
