"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learned from. With class prior p,
the risk of the classifier is p R+(P) + max(0, R-(U) - p R-(P)): the negative part, that
unlabelled texts stand in for, is corrected by the positives among them and never let
below zero, which keeps the fit from turning on the positives hidden there.

The classifier is linear on hashed words (present or not), trained in numpy on the
driver from a bounded sample: at most ``Settings.positives`` and ``Settings.unlabelled``
texts. Scoring is a map over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import normal_words, share, utf8


@dataclass(frozen=True)
class Settings:
    positives: int = 4_000  # most toxic texts learned from
    unlabelled: int = 12_000  # most unlabelled texts learned from
    buckets: int = 1 << 18
    rare: int = 3  # words in fewer sampled texts are left out
    surprise: float = 4.5  # standard errors by which a word's share of toxic texts must stand out
    rounds: int = 200
    rate: float = 0.1
    decay: float = 1e-4
    prior: float | None = None  # share of toxic texts; by default that of the labels


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def word_buckets(text: bytes | None, buckets: int) -> np.ndarray:
    """Distinct hashed words of a text, in order."""
    found = {xxhash.xxh32_intdigest(w) % buckets for w in set(normal_words(text))}
    return np.fromiter(found, np.int32, len(found))


_SAMPLE = "toxic boolean, features array<int>"


def _bounded(rows: DataFrame, key: str, most: int, seed: int) -> Column:
    """A condition that holds for a hashed sample of about ``most`` rows at most."""
    n = rows.count()
    return share(F.col(key), seed) < F.lit(min(1.0, most / max(1, n)))


def training_rows(docs: DataFrame, positives: DataFrame, s: Settings, id_column: str, text: str) -> DataFrame:
    """(toxic, features) of the sampled positives and of the sampled unlabelled texts.

    ``positives`` has one column of ids. A positive text may be among the unlabelled as
    well: these are a sample of all texts.
    """
    c = F.col
    ids = positives.select(c(f"`{positives.columns[0]}`").alias("id")).filter("id IS NOT NULL").distinct()
    ids = ids.filter(_bounded(ids, "id", s.positives, 1)).withColumn("toxic", F.lit(True))
    own = docs.select(c(f"`{id_column}`").alias("id"), c(f"`{text}`").alias("text"))
    unlabelled = F.coalesce(_bounded(own, "id", s.unlabelled, 2), F.lit(False))
    # at most Settings.positives ids: bounded
    met = own.join(F.broadcast(ids), "id", "left").withColumn("other", unlabelled)
    met = met.filter("toxic OR other").select("text", F.coalesce("toxic", F.lit(False)).alias("toxic"), "other")
    copies = F.explode(
        F.filter(F.array(F.when(c("toxic"), True), F.when(c("other"), False)), lambda x: x.isNotNull())
    )
    met = met.select("text", copies.alias("toxic"))
    buckets = s.buckets

    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("toxic", pa.bool_()), ("features", pa.list_(pa.int32()))])
        for batch in stream:
            features = [word_buckets(t, buckets) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(features, pa.list_(pa.int32()))], schema=schema
            )

    return met.mapInArrow(hashed, _SAMPLE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, prior: float, s: Settings) -> Model:
    """Full-batch Adam on the non-negative risk with the logistic loss.

    Without positives or without unlabelled texts every text scores the prior.
    """
    prior = float(np.clip(prior, 1e-4, 0.9))
    flat = Model(np.zeros(s.buckets, np.float32), float(np.log(prior / (1 - prior))))
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return flat
    cols = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # only words that tell the positives from the rest beyond chance are fitted
    in_pos = np.bincount(cols[positive[owner]], minlength=s.buckets)
    in_unl = np.bincount(cols[~positive[owner]], minlength=s.buckets)
    p0 = (in_unl + 1) / (n_unl + 2)
    z = (in_pos / n_pos - p0) / np.sqrt(p0 * (1 - p0) * (1 / n_pos + 1 / n_unl))
    telling = (in_pos + in_unl >= s.rare) & (np.abs(z) >= s.surprise)
    cols, owner = cols[telling[cols]], owner[telling[cols]]
    used, cols = np.unique(cols, return_inverse=True)
    w = np.zeros(len(used))
    bias = flat.bias
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, s.rounds + 1):
        f = np.bincount(owner, w[cols], len(rows)) + bias
        p = _sigmoid(f)
        # logistic loss: -log p if positive, -log(1 - p) if negative
        loss = np.logaddexp(0, f)
        negative = loss[~positive].mean() - prior * loss[positive].mean()
        g = np.zeros(len(rows))
        if negative >= 0:
            g[positive] = prior * (p[positive] - 1) / n_pos - prior * p[positive] / n_pos
            g[~positive] = p[~positive] / n_unl
        else:  # step back from the negative part, as in non-negative estimation
            g[positive] = prior * p[positive] / n_pos
            g[~positive] = -p[~positive] / n_unl
        slope = np.append(np.bincount(cols, g[owner], len(used)) + s.decay * w, g.sum())
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope * slope
        move = s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(s.buckets, np.float32)
    weights[used] = w
    return Model(weights, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    s: Settings = Settings(),
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on ``docs`` with the ids that ``labels`` marks 1; no other label is learned from.

    The prior is the share of 1 among the labels unless the settings give it.
    """
    marked = labels.filter(F.col(f"`{label}`").isNotNull())
    prior = s.prior
    if prior is None:
        prior = marked.agg(F.avg((F.col(f"`{label}`") == 1).cast("int")).alias("p")).first()["p"] or 0.0
    positives = marked.filter(F.col(f"`{label}`") == 1).select(f"`{id_column}`")
    sample = training_rows(docs, positives, s, id_column, text).toArrow()
    positive = np.array(sample.column("toxic").to_pylist(), bool)
    rows = [np.array(r, np.int32) for r in sample.column("features").to_pylist()]
    # the order of rows, and with it every sum, is the same on every run
    order = sorted(range(len(rows)), key=lambda i: (not positive[i], rows[i].tobytes()))
    return fit_nnpu([np.sort(rows[i]) for i in order], positive[order], prior, s)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1; null, empty and wordless texts score as a text of no words."""
    weights, bias = model.weights, model.bias

    @F.arrow_udf("double")
    def toxic(column: pa.Array) -> pa.Array:
        n = len(weights)
        f = np.array([bias + float(weights[word_buckets(t, n)].sum()) for t in utf8(column)], np.float64)
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(f, -30, 30))))

    return toxic(text)


def remove_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score at the threshold or above."""
    return docs.filter(score(F.col(f"`{text}`"), model) < threshold)
