"""Quality classifier by positive-unlabelled learning.

A linear model over whole-text features minimises the non-negative unbiased risk

    prior * E_P[loss(f, +1)]  +  max(0, E_U[loss(f, -1)] - prior * E_P[loss(f, -1)])

with the logistic loss, P the trusted positives and U unlabelled web text. The class
prior is estimated as the share of label 1 among the rows labelled at all; rows
labelled 0 serve for nothing else.

Fitting reads a bounded sample: rows are drawn by a hash of the id, about
``positives`` trusted positives and ``unlabelled`` texts; the driver holds their
feature vectors only. Scoring covers every whole text, without a shuffle.

Nulls: a null or empty text gets the features of a text without words and a score
like any other. Null ids and ids without labels are unlabelled; an id with
conflicting labels is not trusted. Without any positive all scores are the prior.
Clashing input columns give way to results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, hash_share

FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


@dataclass(frozen=True)
class Quality:
    threshold: float = 0.3
    positives: int = 8_000
    unlabelled: int = 16_000
    rounds: int = 1_200
    rate: float = 0.02
    decay: float = 1e-3
    piece: int = 200      # words over which variety is measured


N_BYTES = 129             # ASCII bytes one by one, all others together


def features(raw: bytes | None, piece: int = 200) -> np.ndarray:
    """Byte frequencies, variety and repetition of words and lines, capitals, symbols."""
    raw = raw or b""
    size = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    by_byte = np.sqrt(np.append(counts[:128], counts[128:].sum()) / size)
    words = raw.split()
    n = max(1, len(words))
    lines = raw.split(b"\n")
    variety = np.mean([len(set(words[i:i + piece])) / len(words[i:i + piece])
                       for i in range(0, len(words), piece)] or [1.0])
    echo = sum(map(bytes.__eq__, words, words[1:])) / n
    same_lines = 1 - len(set(lines)) / len(lines)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    capitals = upper / (1 + upper + lower + counts[128:].sum())
    digits = counts[48:58].sum()
    symbols = counts[33:127].sum() - upper - lower - digits - counts[44] - counts[46]
    return np.concatenate((by_byte, [
        len(set(words)) / n, variety, abs(variety - 0.8), echo, min(1.0, 5 * echo), echo > 0.1,
        same_lines, min(1.0, 2 * same_lines), same_lines > 0.3, capitals, capitals > 0.5,
        min(1.0, 10 * symbols / size), min(1.0, symbols / n), symbols / n > 0.3, digits / size,
        min(1.0, 2 * counts[124] / n), min(1.0, 2 * counts[33] / n), math.log(n + 1) / 10, min(5.0, size / n / 10)]))


@dataclass
class Model:
    params: Quality
    prior: float
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray   # the last one is the constant

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(_scaled(rows, self.mean, self.spread) @ self.weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scaled(rows: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.hstack([np.clip((rows - mean) / spread, -8, 8), np.ones((len(rows), 1))])


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, params: Quality) -> np.ndarray:
    """Weights at the end of Adam steps down the non-negative risk; where the risk of
    negatives falls under zero the step goes up that part instead."""
    w = np.zeros(positive.shape[1])
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, params.rounds + 1):
        zp, zu = positive @ w, unlabelled @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        toward = unlabelled.T @ _sigmoid(zu) / len(zu) - prior * (positive.T @ _sigmoid(zp)) / len(zp)
        step = prior * (positive.T @ -_sigmoid(-zp)) / len(zp) + toward if negative >= 0 else -toward
        step[:-1] += params.decay * w[:-1]
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step * step
        w = w - params.rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", params: Quality = Quality()) -> Model:
    """Learn from ``docs`` (all rows unlabelled text) and the ids that ``labels`` trusts."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).cast("string").alias("id"))
             .agg(F.min(label).alias("low"), F.max(label).alias("high")))
    known = marks.agg(F.sum((F.col("low") == 1).cast("long")), F.count(F.lit(1))).first()
    trusted, labelled = known[0] or 0, known[1]
    total = docs.count()
    size = len(features(None))
    if not trusted or not total:
        return Model(params, trusted / max(1, labelled), np.zeros(size), np.ones(size), np.zeros(size + 1))
    prior = trusted / labelled
    drawn = hash_share(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), salt="quality")
    for_p, for_u = min(1.0, params.positives / trusted), min(1.0, params.unlabelled / total)
    piece = params.piece
    sample = (docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), drawn.alias("drawn"))
              .where(F.col("drawn") < max(for_p, for_u)))
    vector = T.StructField("vector", T.ArrayType(T.DoubleType()))
    positives = marks.where("low = 1").select("id")
    sample = sample.join(positives.withColumn("trusted", F.lit(True)), "id", "left")
    sample = sample.where((F.col("drawn") < for_u) | F.col("trusted"))
    rows = append_columns(sample, "text", [vector], lambda raws: [[features(r, piece).tolist() for r in raws]])
    got = rows.select("drawn", "trusted", "vector").toArrow()
    x = np.array(got.column("vector").combine_chunks().flatten()).reshape(-1, size)
    drawn_at = np.array(got.column("drawn"))
    trust = np.array(got.column("trusted").fill_null(False))
    order = np.lexsort((*x.T[::-1], drawn_at))  # the same order whatever the partitions
    x, drawn_at, trust = x[order], drawn_at[order], trust[order]
    p, u = x[trust & (drawn_at < for_p)], x[drawn_at < for_u]
    if not len(p) or not len(u):
        return Model(params, prior, np.zeros(size), np.ones(size), np.append(np.zeros(size), math.log((prior + 1e-9) / (1 - prior + 1e-9))))
    mean, spread = u.mean(axis=0), u.std(axis=0) + 1e-3
    weights = minimise(_scaled(p, mean, spread), _scaled(u, mean, spread), prior, params)
    return Model(params, prior, mean, spread, weights)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""

    def run(raws: list) -> list[list]:
        scores = model.scores(np.array([features(raw, model.params.piece) for raw in raws])).tolist()
        return [scores, [int(s >= model.params.threshold) for s in scores]]

    return append_columns(docs, text, FIELDS, run)
