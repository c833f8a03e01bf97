from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillvault.llm.quality import (
    WIDTH,
    features,
    fit,
    is_held_out,
    keep_good,
    quality_scores,
    training_rows,
)


def junk(text, i):
    words = text.split()
    if i % 3 == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if i % 3 == 1:
        return " | ".join(words)
    return " ".join(w + "$$$" for w in words)


@pytest.fixture
def tables(spark, documents, prose):
    rows = [(i, prose(i, 20 + i % 60) if i % 6 else junk(prose(i, 40), i // 6)) for i in range(600)]
    labels = [(i, int(i % 6 != 0), 0) for i in range(600) if i % 7 < 4]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = quality_scores(docs, labels).collect()
    assert len(got) == 600
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == int(r.doc_id % 6 != 0) for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    turned = labels.withColumn(
        "quality", F.when(is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_risk_is_low_and_its_second_part_not_negative(tables):
    rows = training_rows(*tables)
    model = fit(rows)
    train = [r for r in rows.collect() if not r.held_out]
    x = np.array([r.x for r in train], np.float64)
    positive = np.array([r.label == 1 for r in train])

    def parts(w):
        z = x @ w
        known = model.prior * np.logaddexp(0, -z[positive]).mean()
        return known, np.logaddexp(0, z).mean() - model.prior * np.logaddexp(0, z[positive]).mean()

    weights = np.array(model.weights)
    known, rest = parts(weights)
    risk = known + max(0.0, rest) + 0.5 * 1e-3 * (weights[1:] ** 2).sum()
    assert risk == pytest.approx(model.risk, abs=1e-6)
    assert risk < 0.3 * sum(parts(np.zeros(WIDTH)))
    assert rest > -0.02


@pytest.mark.parametrize("every", [2, 4, 10])
def test_the_prior_is_estimated_from_unlabelled_texts(spark, documents, prose, every):
    """Only good texts are labelled, so no label tells how many texts are good."""
    rows = [(i, prose(i, 30 + i % 40) if i % every else junk(prose(i, 40), i // every)) for i in range(800)]
    labels = [(i, 1, 0) for i in range(800) if i % every and i % 3 == 0]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = fit(training_rows(documents(rows), table))
    assert abs(model.prior - (1 - 1 / every)) < 0.1
    zeros = [(i, 0, 0) for i in range(800) if i % every == 0]
    more = table.unionByName(spark.createDataFrame(zeros, table.schema))
    assert fit(training_rows(documents(rows), more)).weights == pytest.approx(model.weights, abs=1e-6)


def test_the_minimum_is_that_of_plain_numpy(tables):
    """Gradient descent on the whole matrix ends at the weights that the passes have found."""
    rows = training_rows(*tables)
    model = fit(rows, passes=40)
    train = [r for r in rows.collect() if not r.held_out]
    x = np.array([r.x for r in train], np.float64)
    positive = np.array([r.label == 1 for r in train])
    ridge = 1e-3 * np.r_[0.0, np.ones(WIDTH - 1)]
    p = model.prior

    def risk(w):
        z = x @ w
        rest = np.logaddexp(0, z).mean() - p * np.logaddexp(0, z[positive]).mean()
        return p * np.logaddexp(0, -z[positive]).mean() + max(0.0, rest) + 0.5 * (ridge * w) @ w

    assert risk(np.array(model.weights)) == pytest.approx(model.risk, abs=1e-6)
    w, least = np.zeros(WIDTH), risk(np.zeros(WIDTH))
    for _ in range(4000):
        z = x @ w
        s = 1 / (1 + np.exp(-z))
        rest = np.logaddexp(0, z).mean() - p * np.logaddexp(0, z[positive]).mean()
        g = s @ x / len(x) - p * x[positive].mean(axis=0) + ridge * w
        if rest < 0:
            g = -(s @ x / len(x) - p * s[positive] @ x[positive] / positive.sum())
        w = w - 2.0 * g
        least = min(least, risk(w))
    assert model.risk <= least + 2e-3


def test_features_are_bounded():
    for text in ("", " ", "a", "\n\n", "!!!!", "A" * 50000, "x y " * 3000, "\x00\x01", "🙂 é"):
        x = features(text)
        assert len(x) == WIDTH and all(0 <= v <= 1 for v in x)


def test_edge_rows(spark, documents, tables):
    _, labels = tables
    odd = labels.unionByName(
        spark.createDataFrame([(1, None, None), (None, 1, 0), (1, 0, 0)], labels.schema)
    )
    docs = documents([(1, "fine text"), (1, "fine text"), (2, None), (3, ""), (None, "other")])
    got = quality_scores(docs, odd).collect()
    assert len(got) == 5
    scores = {(r.doc_id, r.score) for r in got}
    assert len([s for s in scores if s[0] == 1]) == 1
    assert len({s for i, s in scores if i in (2, 3)}) == 1
    assert next(r.held_out for r in got if r.doc_id is None) is False


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in quality_scores(documents([(1, "a b c")]), none).collect()] == [0.5]
    assert quality_scores(documents([]), none).count() == 0


def test_filter_keeps_columns_and_good_rows(tables):
    docs, labels = tables
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert all(r[c] == "theirs" for r in kept.collect() for c in docs.columns[2:])
    good = {i for i in range(600) if i % 6}
    assert len(good - ids) <= 3 and len(ids - good) <= 6
