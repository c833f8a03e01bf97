"""Quality of texts learned from trusted positives and unlabelled text (non-negative PU risk).

With class prior p, logistic loss l and a linear score z, the risk

    p E_pos[l(z)] + max(0, E_unl[l(-z)] - p E_pos[l(-z)])

needs no negative rows, and none is used. While its second part is positive the whole is convex,
because l(z) - l(-z) = -z; Newton steps then reach the minimum in a few passes. Where that part turns
negative (the sign of overfitting) a step climbs back along it instead, as the non-negative
estimator prescribes.

The prior is estimated from the unlabelled texts: above any score there are at least p times as many
of all texts as of the positives, and about p times as many where no bad text scores as high. A first
fit gives the scores, the least ratio of the two upper tails the prior of the second fit.

Every pass sums gradient and Hessian over **all** unlabelled rows in Spark, so nothing is sampled;
only a few thousand sums reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvault.llm.tables import keep_rows, map_rows, staged

#: Share measured -> places where its effect may bend.
BENDS = {
    "symbols": (0.01, 0.05, 0.2),
    "shouting": (0.02, 0.1, 0.5),
    "digits": (0.05, 0.2),
    "repeated words": (0.05, 0.15, 0.5),
    "few distinct words": (0.2, 0.5, 0.9),
    "lone signs": (0.02, 0.1, 0.3),
    "repeated lines": (0.1, 0.3, 0.7),
    "top word": (0.15, 0.3, 0.7),
    "long words": (0.05, 0.2),
    "unusual signs after words": (0.02, 0.1, 0.4),
}
WIDTH = 3 + sum(map(len, BENDS.values()))
PASSES = 12
RIDGE = 1e-3
KEEP_FROM = 0.3
#: Share of good texts that the first fit assumes; bins of scores, and positives a tail must hold.
FIRST_PRIOR = 0.5
BINS = 1000
TAIL = 0.3


def features(text: str) -> list[float]:
    """Constant, two lengths, and every share of ``BENDS`` cut off at each of its bends (0 to 1)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = max(1, codes.size)
    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 192) & (codes <= 222))
    lower = ((codes >= 97) & (codes <= 122)) | ((codes >= 223) & (codes <= 591))
    letter = upper | lower | (codes > 591)
    digit = (codes >= 48) & (codes <= 57)
    common = (codes <= 32) | (codes == 44) | (codes == 46)
    symbol = ~(letter | digit | common)
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    # Short texts repeat few words; the measure starts where repeating says something.
    expected = m**0.75
    shares = {
        "symbols": symbol.sum() / n,
        "shouting": (upper[1:] & upper[:-1]).sum() / n,
        "digits": digit.sum() / n,
        "repeated words": sum(map(str.__eq__, words, words[1:])) / m,
        "few distinct words": max(0.0, 1 - len(counts) / expected) if m > 20 else 0.0,
        "lone signs": sum(len(w) == 1 and not w.isalnum() for w in words) / m,
        "repeated lines": 1 - len(set(lines)) / max(1, len(lines)),
        "top word": (max(counts.values(), default=0) / m) if m > 20 else 0.0,
        "long words": sum(len(w) > 25 for w in words) / m,
        "unusual signs after words": (letter[:-1] & symbol[1:]).sum() / m if n > 1 else 0.0,
    }
    out = [1.0, min(1.0, math.log1p(m) / 10), min(1.0, n / m / 12)]
    for name, bends in BENDS.items():
        out += [min(1.0, float(shares[name]) / b) for b in bends]
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the features; all zero (every score 0.5) when nothing could be learned."""

    weights: tuple[float, ...]
    prior: float
    risk: float = math.nan

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.asarray(self.weights), -40, 40)))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves no remainder by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def measured(documents: DataFrame) -> DataFrame:
    """``doc_id, features`` of every whole text (null counts as empty)."""

    def make():
        return lambda doc_id, text: [(doc_id, features(text or ""))]

    return map_rows(documents.select("doc_id", "text"), make, "doc_id bigint, x array<float>")


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored ``doc_id, x, held_out, positive``; labels of held-out ids are never looked at.

    Of several labels of one id the highest counts; null labels and null ids count for nothing.
    """
    trusted = (
        labels.filter(F.col("quality").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
    )
    rows = (
        measured(documents)
        .join(trusted, "doc_id", "left")
        .select("doc_id", "x", is_held_out(F.col("doc_id")).alias("held_out"), "label")
    )
    return staged(rows, "quality")


def _sums(rows: DataFrame, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over all training rows at ``weights``: partial per task, then by position."""
    d = WIDTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * d + d * d + 4)
        for batch in batches:
            x = batch.column(0).values.to_numpy(zero_copy_only=False).reshape(-1, d)
            x = x.astype(np.float64)
            pos = batch.column(1).to_numpy(zero_copy_only=False)
            z = x @ weights
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            plus = np.logaddexp(0, z)
            total += np.concatenate(
                [
                    s @ x,
                    pos @ x,
                    (pos * s) @ x,
                    ((x * (s * (1 - s))[:, None]).T @ x).ravel(),
                    [plus.sum(), pos @ plus, len(z), pos.sum()],
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int64()), pa.array(total)], names=["i", "v"]
        )

    sums = rows.mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v"))
    flat = np.zeros(3 * d + d * d + 4)
    for i, v in sums.collect():  # as many rows as sums, whatever the input
        flat[i] = v
    return {
        "unlabelled": flat[:d],
        "positive": flat[d : 2 * d],
        "positive_s": flat[2 * d : 3 * d],
        "hessian": flat[3 * d : 3 * d + d * d].reshape(d, d),
        "rest": flat[-4:],
    }


def fit(rows: DataFrame, passes: int = PASSES) -> Model:
    """Minimise the risk over ``training_rows``; held-out rows and labels other than 1 take no part.

    Without any document or positive label the model is all zero.
    """
    train = rows.filter(~F.col("held_out"))
    ones = train.agg(F.coalesce(F.sum((F.col("label") >= 1).cast("long")), F.lit(0))).first()[0]
    if not ones:
        return Model((0.0,) * WIDTH, FIRST_PRIOR)
    train = train.select(
        "x", F.coalesce((F.col("label") >= 1).cast("double"), F.lit(0.0)).alias("positive")
    )
    first = minimised(train, FIRST_PRIOR, passes)
    return minimised(train, estimated_prior(train, first), passes, first.weights)


def estimated_prior(train: DataFrame, model: Model) -> float:
    """Least ratio of the shares of all and of positive texts above a score.

    Scores are counted in ``BINS`` bins over all rows. Only tails that hold ``TAIL`` of the positives
    count, and a ratio is taken with one standard error of that share: small tails say little.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            x = batch.column(0).values.to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            place = np.minimum((model.score(x.astype(np.float64)) * BINS).astype(int), BINS - 1)
            positive = batch.column(1).to_numpy(zero_copy_only=False) > 0
            counts[0] += np.bincount(place, minlength=BINS)
            counts[1] += np.bincount(place[positive], minlength=BINS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(2 * BINS), pa.int64()), pa.array(counts.ravel())], names=["i", "n"]
        )

    flat = np.zeros(2 * BINS)
    sums = train.mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    for i, n in sums.collect():  # as many rows as bins
        flat[i] = n
    every, positive = flat.reshape(2, BINS)[:, ::-1].cumsum(axis=1)
    share = positive / positive[-1]
    enough = share >= TAIL
    error = np.sqrt(share * (1 - share) / positive[-1])
    ratios = (every / every[-1] + error)[enough] / share[enough]
    return float(np.clip(ratios.min(), 1 / BINS, 1 - 1 / BINS))


def minimised(
    train: DataFrame, prior: float, passes: int = PASSES, start: tuple[float, ...] | None = None
) -> Model:
    weights = np.zeros(WIDTH) if start is None else np.asarray(start)
    best = base = None  # the least risk met; where the present step began
    step, size = None, 1.0
    ridge = RIDGE * np.r_[0.0, np.ones(WIDTH - 1)]
    for _ in range(passes):
        s = _sums(train, weights)
        plus_u, plus_p, n_u, n_p = s["rest"]
        mean_p = s["positive"] / n_p
        negative = plus_u / n_u - prior * plus_p / n_p
        known = prior * (plus_p / n_p - mean_p @ weights)
        risk = known + max(0.0, negative) + 0.5 * (ridge * weights) @ weights
        if best is None or risk < best[0]:
            best = risk, weights
        if base is not None and risk > base[0] + 1e-12 and size > 1 / 64:
            size /= 2
            weights = base[1] + size * step
            continue
        if base is not None and base[0] - risk < 1e-9 and negative >= 0:
            break
        size = 1.0
        if negative >= 0:
            gradient = s["unlabelled"] / n_u - prior * mean_p + ridge * weights
            hessian = s["hessian"] / n_u + np.diag(ridge + 1e-9)
            step = -np.linalg.solve(hessian, gradient)
            base = risk, weights
        else:  # a step back is taken whatever it does to the first part
            step = s["unlabelled"] / n_u - prior * s["positive_s"] / n_p
            base = None
        weights = weights + step
    return Model(tuple(map(float, best[1])), prior, float(best[0]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of ``training_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).values.to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            score = model.score(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score),
                    pa.array((score >= KEEP_FROM).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.select("doc_id", "held_out", "x").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Only texts enter a score. Empty and null texts get the score of an empty text; repeated rows
    get equal scores; an empty table gives an empty result.
    """
    rows = training_rows(documents, labels)
    return scored(rows, fit(rows))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = KEEP_FROM) -> DataFrame:
    """The rows of ``documents`` that score ``threshold`` or more, all columns unchanged.

    Null and empty texts stay if an empty text scores that much; repeated rows stay or go together.
    """
    model = fit(training_rows(documents, labels))

    def make():
        return lambda text: model.score(np.array([features(text or "")]))[0] >= threshold

    return keep_rows(documents, "text", make)
