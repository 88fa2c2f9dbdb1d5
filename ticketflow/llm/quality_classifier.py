"""Quality classifier learned from positive and unlabelled documents.

A linear model is fitted by minimising the non-negative unbiased risk: trusted
positives, unlabelled web text and an estimated class prior, no negatives. The
prior is the smallest ratio, over the upper score regions of a plain
positive-against-unlabelled fit, of the unlabelled share to the positive share
in the region; that ratio cannot fall below the share of positives.

Features are the shares of hashed word endings and a few shape figures of the
text; nothing else of a row is used. The fit runs on at most MAX_POSITIVE
trusted rows and MAX_UNLABELLED rows of web text, those with the smallest hash
of their id: documented bounds, so that the fit is the same work at every
corpus size. Scoring covers every row and the whole text, in Arrow batches.

Defined cases: a missing text scores like an empty one; repeated rows are
scored each; an empty table gives an empty result; without any trusted
positive every score is 0.5; missing or unknown labels count as unlabelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import Words, chunks, mix

MAX_POSITIVE = 6_000
MAX_UNLABELLED = 12_000
BUCKETS = 256
SHAPES = 10
WIDTH = BUCKETS + SHAPES
_BATCH = 2_000
RIDGE_ROWS = 10


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


_KIND = np.zeros(256, dtype=np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[ord(c) for c in "#*$%&|<>"]] = 3
_KIND[[ord(c) for c in "!?"]] = 4
_KIND[[ord(c) for c in ".,;:"]] = 5


def features(texts: list) -> np.ndarray:
    """One row of WIDTH figures per text."""
    out = [_chunk_features(held) for _, _, held in chunks(texts)]
    return np.concatenate(out) if out else np.zeros((0, WIDTH), dtype=np.float32)


def _chunk_features(held: list[bytes]) -> np.ndarray:
    n = len(held)
    w = Words(held)
    size = w.ends - w.starts
    ending = np.zeros(len(size), dtype=np.uint64)
    for k in range(1, 4):
        has = size >= k
        ending[has] = ending[has] * np.uint64(256) + w.data[w.ends[has] - k]
    bucket = (mix(ending) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(w.doc * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    words = np.maximum(np.diff(w.first), 1)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    out[:, :BUCKETS] = np.sqrt(counts / words[:, None])
    of = np.repeat(np.arange(n), np.diff(w.at))[: len(w.data)]
    kinds = np.bincount(of * 6 + _KIND[w.data], minlength=n * 6).reshape(n, 6)
    length = np.maximum(kinds.sum(axis=1), 1)
    for k in range(1, 6):
        out[:, BUCKETS + k - 1] = kinds[:, k] / length
    hashes = w.hashes()
    if len(hashes) > 1:
        same = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
        out[:, BUCKETS + 5] = np.bincount(w.doc[1:][same], minlength=n) / words
    if len(hashes):
        order = np.lexsort((hashes, w.doc))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
        out[:, BUCKETS + 6] = np.bincount(w.doc[order][new], minlength=n) / words
        out[:, BUCKETS + 7] = np.bincount(w.doc, weights=size, minlength=n) / words / 10
        out[:, BUCKETS + 8] = np.bincount(w.doc, weights=size == 1, minlength=n) / words
    out[:, BUCKETS + 9] = np.log1p(np.diff(w.first)) / 10
    return out


def _logits(x: np.ndarray, model: Model) -> np.ndarray:
    return ((x - model.mean) / model.scale) @ model.weights + model.bias


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 300) -> np.ndarray:
    """Weights (the last is the bias) that minimise the logistic risk, by Adam over all given rows.

    With a prior the risk is the non-negative unbiased one; without, plain
    positive against unlabelled.
    """
    theta = np.zeros(positive.shape[1] + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    add = lambda x: np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    p, u = add(positive), add(unlabelled)
    # The fewer rows, the stronger the pull to zero.
    ridge = 1e-3 + RIDGE_ROWS / len(p)
    for step in range(1, steps + 1):
        short = theta.astype(np.float32)
        zp, zu = np.clip(p @ short, -80, 80), np.clip(u @ short, -80, 80)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        as_positive = p.T @ (sp - 1) / len(p)  # of the loss of positives taken as positive
        as_negative = p.T @ sp / len(p)
        rest = u.T @ su / len(u)
        if prior is None:
            slope = as_positive + rest
        else:
            risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            slope = prior * as_positive + rest - prior * as_negative if risk >= 0 else prior * as_negative - rest
        slope = slope + ridge * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta = theta - 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.2) -> float:
    """The share of positives in `unlabelled`, from scores: the smallest ratio over regions with at least `least`
    of the positives."""
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 81))
    ratios = [(unlabelled >= c).mean() / max((positive >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratios), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model from feature rows; half of them fit the scores that the prior is read from, the other half reads it."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    theta = _descend(p[::2], u[::2], None, 150)
    prior = estimate_prior(p[1::2] @ theta[:-1], u[1::2] @ theta[:-1])
    theta = _descend(p, u, prior)
    return Model(mean, scale, theta[:-1], float(theta[-1]), prior)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), _BATCH):
            part = batch.iloc[at : at + _BATCH]
            yield pd.DataFrame({"positive": part["positive"], "x": list(features(list(part["text"])))})


def train(
    docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED
) -> Model | None:
    """A model from the rows that are not held out; None without both kinds of rows."""
    usable = lambda df: df.filter("doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    pick = lambda df, n: df.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    good = pick(usable(labels).filter("quality = 1"), max_positive).withColumn("positive", F.lit(True))
    some = pick(usable(docs), max_unlabelled).withColumn("positive", F.lit(False))
    ids = F.broadcast(good.unionByName(some).withColumnRenamed("doc_id", "_id"))
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id")).select("text", "positive")
    sample = rows.mapInPandas(_feature_rows, "positive boolean, x array<float>").toPandas()
    x = np.array(sample["x"].tolist(), dtype=np.float32).reshape(len(sample), WIDTH)
    positive = sample["positive"].to_numpy(dtype=bool)
    if not positive.any() or positive.all():
        return None
    # Rows come in no fixed order; sorted, the fit gives the same model each time.
    order = lambda a: a[np.lexsort(a.T[::-1])]
    return fit(order(x[positive]), order(x[~positive]))


def score(docs: DataFrame, model: Model | None, threshold: float) -> DataFrame:
    """The columns of `docs` with score (0 to 1) and predicted (1 if score >= threshold)."""
    if model is None:
        out = docs.withColumn("score", F.lit(0.5))
    else:

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                parts = [
                    1 / (1 + np.exp(-np.clip(_logits(features(list(texts.iloc[at : at + _BATCH])), model), -500, 500)))
                    for at in range(0, len(texts), _BATCH)
                ]
                yield pd.Series(np.concatenate(parts) if parts else np.zeros(0), dtype="float64")

        out = docs.withColumn("score", scored.asNondeterministic()("text"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
