"""Quality classifier from positive and unlabelled texts (operator 5).

Trusted positives are the rows labelled good; everything else is learnt from
unlabelled web text, of which a share, the class prior, is good too. A linear
model minimises the non-negative unbiased risk: where the estimated risk on
the negatives would fall below zero, the step goes back up instead. The
prior comes from the same two samples: the share of unlabelled texts among
those that score as high as the best positives. Labels never enter a score.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import id_and_text, text_or_empty

#: Positives and unlabelled texts to learn from, at most; good texts score this or more.
SAMPLE, THRESHOLD, FOLDS = 8_000, 0.3, 5
#: Hashed byte pairs, and the shares that follow them in a row of features.
PAIRS, SHARES = 512, 14
ROUNDS, RATE, DECAY = 400, 0.05, 1e-4
#: Bytes whose pairs are counted at once.
SLICE = 1 << 20


def features(raw: bytes) -> np.ndarray:
    """Shares of hashed byte pairs (square roots) and of kinds of characters and words; zeros of an empty text."""
    out = np.zeros(PAIRS + SHARES, np.float32)
    if not raw:
        return out
    data = np.frombuffer(raw, np.uint8)
    of_byte = np.zeros(256, np.int64)
    pairs = np.zeros(PAIRS, np.int64)
    for a in range(0, len(data), SLICE):
        some = data[a: a + SLICE + 1].astype(np.uint32)
        of_byte += np.bincount(some[:SLICE], minlength=256)
        pairs += np.bincount(((some[:-1] << 8 | some[1:]) * np.uint32(2654435769)) >> np.uint32(23), minlength=PAIRS)
    n = len(data)
    out[:PAIRS] = np.sqrt(pairs / max(1, n - 1))
    words = raw.lower().split()
    count = max(1, len(words))
    distinct = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    share = lambda lo, hi: of_byte[lo:hi].sum() / n
    out[PAIRS:] = (
        share(65, 91), share(97, 123), share(48, 58), share(32, 33), share(10, 11), share(128, 256),
        share(33, 48) + share(58, 65) + share(91, 97) + share(123, 127), of_byte[124] / n, of_byte[33] / n,
        again / count, distinct / count, min(n / count, 50) / 50, np.log10(n) / 6, np.sqrt(of_byte.max() / n))
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, gradient, rounds: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on standardised features; weights for the features as they are."""
    n = len(positive) + len(unlabelled)
    mean = (positive.sum(0, dtype=np.float64) + unlabelled.sum(0, dtype=np.float64)) / n
    square = (np.square(positive).sum(0, dtype=np.float64) + np.square(unlabelled).sum(0, dtype=np.float64)) / n
    spread = np.sqrt(np.maximum(square - mean ** 2, 0)) + 1e-3
    # single precision: half the driver's memory
    p, u = (((x - mean.astype(x.dtype)) / spread.astype(x.dtype)) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, rounds + 1):
        single = w.astype(p.dtype)
        on_p, on_u = gradient((p @ single).astype(np.float64) + b, (u @ single).astype(np.float64) + b)
        g = np.append(on_p.astype(p.dtype) @ p + on_u.astype(p.dtype) @ u + DECAY * w, on_p.sum() + on_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w / spread, b - float((w / spread) @ mean)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good texts among the unlabelled ones, from one half of each sample after fitting on the other.

    Above a cut in the scores, the share of the unlabelled over that of the positives is the prior plus what
    negatives add; it is taken where it is least, with an allowance for chance.
    """
    def apart(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -_sigmoid(-gp) / len(gp), _sigmoid(gu) / len(gu)

    w, b = _fit(positive[::2], unlabelled[::2], apart, ROUNDS // 4)
    sp, su = np.sort(positive[1::2] @ w + b), np.sort(unlabelled[1::2] @ w + b)
    if not len(sp) or not len(su):
        return 0.5
    in_p = 1 - np.searchsorted(sp, sp) / len(sp)
    in_u = 1 - np.searchsorted(su, sp) / len(su)
    allow = np.sqrt(np.log(20) / (2 * len(su))) + np.sqrt(np.log(20) / (2 * len(sp)))
    bound = (in_u + allow) / in_p
    best = int(np.argmin(bound))
    return float(np.clip(in_u[best] / in_p[best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """Minimise prior E_p[loss(g)] + max(0, E_u[loss(-g)] - prior E_p[loss(-g)]) with the logistic loss.

    Without positives or unlabelled texts every score is 0.5.
    """
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(PAIRS + SHARES), 0.0, 0.5)
    prior = class_prior(positive, unlabelled) if prior is None else prior

    def gradient(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        on_p = -prior * _sigmoid(-gp) / len(gp)
        less_p, more_u = -prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
        if negative < 0:  # overfitted: step back up on this part alone
            return -less_p, -more_u
        return on_p + less_p, more_u

    w, b = _fit(positive, unlabelled, gradient, ROUNDS)
    return Model(w, b, prior)


def held_out(id_col: Column, folds: int = FOLDS) -> Column:
    """Rows whose labels are not learnt from: crc32 of the id as text leaves 0; also rows without an id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(True))


def _features_of(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of the documents with these (few, distinct) ids, a row each."""
    @F.pandas_udf("binary")
    def row(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t.encode()).tobytes())

    found = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", row("text").alias("row")).collect()
    found.sort(key=lambda r: (r["doc_id"], r["row"]))
    if not found:
        return np.zeros((0, PAIRS + SHARES), np.float32)
    return np.frombuffer(b"".join(r["row"] for r in found), np.float32).reshape(len(found), -1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
          folds: int = FOLDS) -> Model:
    """Fit on at most ``sample`` positives and ``sample`` unlabelled texts, those whose ids hash lowest.

    Only rows that are not held out are used. ``labels`` has doc_id and quality; rows with nulls teach nothing.
    """
    texts = id_and_text(docs, id_col, text_col).filter(~held_out(F.col("doc_id"), folds))
    good = labels.select("doc_id", "quality").filter((F.col("quality") == 1) & ~held_out(F.col("doc_id"), folds))

    def lowest(rows: DataFrame, seed: int) -> DataFrame:
        return rows.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)

    return fit(_features_of(texts, lowest(good, 1)), _features_of(texts, lowest(texts, 2)))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.stack([features(t.encode()) for t in texts]) if len(texts) else np.zeros((0, PAIRS + SHARES))
        return pd.Series(model.scores(rows.astype(np.float64)))

    return score


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD, folds: int = FOLDS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of ``docs``; null and empty texts score alike."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), scorer(model)("text").alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their own columns."""
    rows = docs.select(F.struct("*").alias("doc"), text_or_empty(text_col).alias("text"))
    return rows.filter(scorer(model)("text") >= threshold).select("doc.*")
