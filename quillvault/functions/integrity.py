"""Chunk seals (HMAC-SHA256) and text encryption.

Keys reach a plan only as scalar subqueries, so neither ``explain`` nor the event log shows them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvault import fixed_values as fv

_BLOCK = 64  # SHA-256 block size in bytes


def hidden(spark: SparkSession, value: bytes) -> Column:
    """A binary constant whose value does not appear in plan text."""
    return spark.createDataFrame([(bytearray(value),)], "value binary").scalar()


@F.arrow_udf(T.BinaryType())
def _float_bytes(vectors: pa.Array) -> pa.Array:
    offsets = np.asarray(vectors.offsets, dtype=np.int64) * 4
    values = vectors.values
    if values.null_count:
        raise ValueError("a vector holds a null element")
    data = np.ascontiguousarray(values.to_numpy(zero_copy_only=False), dtype="<f4")
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(vectors),
        [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data)],
    )
    return pc.if_else(vectors.is_valid(), packed, None).cast(pa.binary())


def vector_bytes(vector: Column) -> Column:
    """Little-endian float32 bytes of a non-empty vector."""
    quantised = vector.cast("array<float>")
    checked = F.when(F.size(quantised) > 0, quantised).otherwise(
        F.raise_error(F.lit("a seal needs a non-empty vector"))
    )
    return _float_bytes(checked)


def seal_message(text: Column, doc_sha256: Column, chunk_index: Column, packed: Column) -> Column:
    separator = F.lit(fv.FIELD_SEPARATOR)
    return F.concat(
        F.encode(text, "UTF-8"),
        separator,
        F.encode(doc_sha256, "UTF-8"),
        separator,
        F.encode(chunk_index.cast("int").cast("string"), "UTF-8"),
        separator,
        packed,
    )


def hmac_sha256(spark: SparkSession, message: Column, key: bytes) -> Column:
    """HMAC-SHA256 hex built from two SHA-256 calls over padded keys."""
    if not key:
        raise ValueError("the seal key must not be empty")
    short = hashlib.sha256(key).digest() if len(key) > _BLOCK else key
    padded = short.ljust(_BLOCK, b"\0")
    inner = hidden(spark, bytes(b ^ 0x36 for b in padded))
    outer = hidden(spark, bytes(b ^ 0x5C for b in padded))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def seal(
    spark: SparkSession,
    text: Column,
    doc_sha256: Column,
    chunk_index: Column,
    vector: Column,
    key: bytes,
) -> Column:
    """Seal binding a chunk's text, document, position and vector."""
    message = seal_message(text, doc_sha256, chunk_index, vector_bytes(vector))
    return hmac_sha256(spark, message, key)


def seal_matches(computed: Column, stored: Column) -> Column:
    """Compare seals, tolerating the blanks a fixed-width column may add."""
    return F.coalesce(computed == F.trim(stored), F.lit(False))


def _cipher_key(spark: SparkSession, passphrase: str) -> Column:
    if not passphrase:
        raise ValueError("the encryption key must not be empty")
    return hidden(spark, hashlib.sha256(passphrase.encode("utf-8")).digest())


def encrypt(spark: SparkSession, text: Column, passphrase: str) -> Column:
    return F.aes_encrypt(F.encode(text, "UTF-8"), _cipher_key(spark, passphrase), F.lit("GCM"))


def decrypt(spark: SparkSession, content: Column, passphrase: str) -> Column:
    """Plain text, or null where the key is wrong or the bytes were altered."""
    return F.decode(
        F.try_aes_decrypt(content, _cipher_key(spark, passphrase), F.lit("GCM")), "UTF-8"
    )
