from __future__ import annotations

import hashlib
import hmac
import math
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.chunking import char_windows, recursive_chunks, split_recursively
from quillvault.functions.embedding import checked, cosine, embed_documents, hashing_embedder
from quillvault.functions.integrity import decrypt, encrypt, seal, seal_matches, vector_bytes
from quillvault.queries import sql

KEY = b"integrity key for the tests"
VECTOR = [0.1, -0.2, 0.30000001, 4.5e-3, -1.0, 0.0, 123.456, -7.89]
SHA = "a" * 64


def brute_seal(text, sha, index, vector, key):
    message = b"\x1f".join(
        [text.encode(), sha.encode(), str(index).encode(), np.asarray(vector, "<f4").tobytes()]
    )
    return hmac.new(key, message, hashlib.sha256).hexdigest()


def sealed(spark, rows, key=KEY, kind="double"):
    df = spark.createDataFrame(rows, f"n int, text string, sha string, i int, v array<{kind}>")
    value = seal(spark, F.col("text"), F.col("sha"), F.col("i"), F.col("v"), key)
    return [r.s for r in df.select("n", value.alias("s")).orderBy("n").collect()]


def test_seal_equals_hmac_and_depends_on_every_field(spark):
    altered = [VECTOR[0] + 1e-3, *VECTOR[1:]]
    rows = [
        (0, "texte éàü.", SHA, 3, VECTOR),
        (1, "texte éàü..", SHA, 3, VECTOR),
        (2, "texte éàü.", "b" * 64, 3, VECTOR),
        (3, "texte éàü.", SHA, 4, VECTOR),
        (4, "texte éàü.", SHA, 3, altered),
    ]
    got = sealed(spark, rows)
    assert got == [brute_seal(*r[1:], KEY) for r in rows]
    assert len(set(got)) == len(rows)
    assert sealed(spark, rows, kind="float") == got
    long_key = b"k" * 100
    assert sealed(spark, rows[:1], long_key) == [brute_seal(*rows[0][1:], long_key)]


def test_seal_rejects_bad_input(spark):
    with pytest.raises(ValueError):
        sealed(spark, [(0, "t", SHA, 0, VECTOR)], b"")
    with pytest.raises(Exception, match="non-empty vector"):
        sealed(spark, [(0, "t", SHA, 0, [])])


def test_vector_bytes_with_nulls_and_slices(spark):
    rows = [(i, None if i % 3 == 0 else [float(i), i / 7]) for i in range(50)]
    df = spark.createDataFrame(rows, "i int, v array<float>").repartition(3)
    got = {
        r.i: r.b
        for r in df.withColumn("b", vector_bytes(F.when(F.col("v").isNotNull(), F.col("v")))).filter("i % 3 != 0").collect()
    }
    for i, v in rows:
        if v is not None:
            assert bytes(got[i]) == np.asarray(v, "<f4").tobytes()


def test_stored_seal_may_be_padded(spark):
    df = spark.createDataFrame([("ab", "ab  "), ("ab", "ac"), ("ab", None)], "a string, b string")
    assert [r.ok for r in df.select(seal_matches(F.col("a"), F.col("b")).alias("ok")).collect()] == [
        True,
        False,
        False,
    ]


def test_encryption_round_trip_and_hidden_keys(spark):
    df = spark.createDataFrame([("secret é text",)], "t string")
    out = df.withColumn("c", encrypt(spark, F.col("t"), "pass phrase")).select(
        decrypt(spark, F.col("c"), "pass phrase").alias("same"),
        decrypt(spark, F.col("c"), "wrong").alias("wrong"),
    )
    row = out.first()
    assert (row.same, row.wrong) == ("secret é text", None)
    plan = out._jdf.queryExecution().toString()
    assert hashlib.sha256(b"pass phrase").hexdigest() not in plan.lower()
    assert "pass phrase" not in plan


def test_char_windows(spark):
    texts = ["", "a" * 3, "ab" * 500, "x" * 1000, "x" * 1001, "é" * 1850, "z" * 1851]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", char_windows(F.col("t"), 1000, 150).alias("w")).orderBy("i").collect()
    for text, row in zip(texts, rows):
        n = 0 if not text else 1 if len(text) <= 1000 else math.ceil((len(text) - 150) / 850)
        assert row.w == [text[j * 850 : j * 850 + 1000] for j in range(n)]


def test_recursive_split_examples():
    assert split_recursively("", 10, 3) == []
    assert split_recursively("  \n\n ", 10, 3) == []
    assert split_recursively("one two", 10, 3) == ["one two"]
    assert split_recursively("para one\n\npara two", 10, 3) == ["para one", "para two"]
    assert split_recursively("aaa bbb ccc ddd", 8, 4) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert split_recursively("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]


def test_recursive_split_invariants():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("ab é \n\n.") for _ in range(rng.randint(0, 400)))
        size = rng.randint(5, 60)
        overlap = rng.randint(1, size - 1)
        chunks = split_recursively(text, size, overlap)
        assert all(0 < len(c) <= size for c in chunks)
        assert all(c in text for c in chunks)
        at = 0
        for chunk in chunks:  # chunks follow the text, with at most the overlap repeated
            found = text.find(chunk, max(0, at - overlap - size))
            assert found >= 0
            at = max(at, found + len(chunk))
        kept = set("".join("".join(c.split()) for c in chunks))
        assert set("".join(text.split())) <= kept


def test_recursive_chunks_column(spark):
    df = spark.createDataFrame([("one two three four five",), (None,)], "t string")
    rows = df.select(recursive_chunks(F.col("t"), 10, 4).alias("c")).collect()
    assert rows[0].c == split_recursively("one two three four five", 10, 4)
    assert rows[1].c is None


def brute_embedding(text, dim):
    import re

    counts = np.zeros(dim)
    for word in re.findall(r"[^\W_]+", text.lower()):
        counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = np.sqrt((counts**2).sum())
    return (counts / norm if norm else counts).astype(np.float32)


def test_hashing_embedder(spark):
    texts = ["Hello hello world", "", "  ", "Éa été — 42!", "x " * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    vector = embed_documents(F.col("t"), hashing_embedder(32), 32)
    rows = df.select("i", vector.alias("v")).orderBy("i").collect()
    for text, row in zip(texts, rows):
        np.testing.assert_allclose(row.v, brute_embedding(fv.DOCUMENT_PREFIX + text, 32), rtol=1e-6)


def test_unusable_vectors_become_null(spark):
    rows = [([1.0, 2.0],), ([1.0, None, 3.0],), (None,), ([1.0, 2.0, 3.0],)]
    df = spark.createDataFrame(rows, "v array<float>")
    got = [r.v for r in df.select(checked(F.col("v"), 3).alias("v")).collect()]
    assert got == [None, None, None, [1.0, 2.0, 3.0]]


def test_windows_take_time_linear_in_the_text(spark):
    def seconds(n):
        df = spark.createDataFrame([("é x" * n,)], "t string")
        started = time.time()
        count = df.select(F.size(char_windows(F.col("t"), 100, 15)).alias("n")).first().n
        assert count == max(1, -(-(3 * n - 15) // 85))
        return time.time() - started

    seconds(10)
    assert seconds(1_000_000) < 12 * max(0.5, seconds(100_000))


@pytest.mark.parametrize("size,overlap", [(10, 3), (10, 9), (7, 1), (1000, 150)])
def test_windows_against_slices(spark, size, overlap):
    texts = ["", "a", "ab\ncd🙂é" * 7, "x" * size, "y" * (size + 1), "z" * (3 * size)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", char_windows(F.col("t"), size, overlap).alias("w")).orderBy("i").collect()
    step = size - overlap
    for text, row in zip(texts, got, strict=True):
        n = max(1, -(-(len(text) - overlap) // step)) if text else 0
        assert row.w == [text[i * step : i * step + size] for i in range(n)]


def test_cosine(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>"
    )
    rows = df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert rows[0].c == pytest.approx(1 / math.sqrt(2))
    assert rows[1].c is None


@pytest.mark.parametrize("size, overlap", [(20, 5), (30, 10), (12, 11)])
def test_the_equivalent_sql_of_the_recursive_splitter(size, overlap):
    rnd = random.Random(size)
    parts = ["a", "bb", "ccc ", "\n", "\n\n", " ", "  ", "dddddd", "\t", "é", "x" * 30]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(200)]
    texts += ["z" * 100, "", " ", "\n\n\n\n\n", "q" * 35 + " " + "r" * 50]
    db = duckdb.connect()
    db.sql("CREATE TABLE t (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    got = db.sql(sql.recursive_chunks("t", size, overlap)).fetchall()
    want = [
        (i, j, c) for i, t in enumerate(texts) for j, c in enumerate(split_recursively(t, size, overlap))
    ]
    assert sorted(got) == want


def test_windows_cut_a_text_once(spark):
    df = spark.createDataFrame([("ab" * 40,), ("",), (None,)], "t string")
    windows = df.select(char_windows(F.col("t"), 10, 7).alias("w"))
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    text = "ab" * 40
    want = [text[i : i + 10] for i in range(0, len(text) - 7, 3)]
    assert [r.w for r in windows.collect()] == [want, [], []]
