"""Logistic regression over hashed features, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, share
from .ngrams import grams, runs, words


@dataclass(frozen=True)
class Settings:
    """What a model looks at and how it learns.

    kinds: see `ngrams.grams`. presence: a feature counts 1 however often it
    occurs; else its value is the root of its share of the text's grams of all kinds.
    sample_rows / sample_bytes: the model learns from a sample of labelled rows of about
    this many rows, and stops reading at this many bytes of text. Classes are not rebalanced.
    """

    kinds: tuple
    presence: bool
    dims: int = 1 << 20
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    sample_rows: int = 8000
    sample_bytes: int = 48 << 20


@dataclass
class Model:
    settings: Settings
    bias: float
    features: np.ndarray
    weights: np.ndarray
    dense: np.ndarray | None = field(default=None, repr=False)

    def table(self) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros(self.settings.dims, dtype=np.float32)
            self.dense[self.features] = self.weights
        return self.dense


def examples(texts: pa.Array, s: Settings):
    """(features, values) of each text; values None where all are 1."""
    for _, run in runs(texts):
        doc, found = words(run)
        parts = list(grams(doc, found, s.kinds, s.dims))
        if not parts:
            yield from ((np.zeros(0, dtype=np.int32), None if s.presence else np.zeros(0)) for _ in range(len(run)))
            continue
        d, f = (np.concatenate(p) for p in zip(*parts))
        key, count = np.unique(d * s.dims + f, return_counts=True)
        total = np.bincount(d, minlength=len(run))
        at = np.searchsorted(key, np.arange(len(run) + 1) * s.dims)
        for i in range(len(run)):
            own = slice(at[i], at[i + 1])
            value = None if s.presence else np.sqrt(count[own] / total[i]).astype(np.float32)
            yield (key[own] - i * s.dims).astype(np.int32), value


def follow(data: list, s: Settings) -> Model:
    """FTRL-proximal: z gathers gradients less what the weights already hold, n squared
    gradients; a weight is 0 while |z| is within l1, and its rate falls with its own n."""
    z, n = np.zeros(s.dims), np.zeros(s.dims)
    ones = sum(y for _, _, y in data)
    bias = float(np.log((ones + 0.5) / (len(data) - ones + 0.5)))
    bias_n = 0.0

    def weight(zi, ni):
        return np.where(np.abs(zi) <= s.l1, 0.0, (np.sign(zi) * s.l1 - zi) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for f, v, y in data:
            zi, ni = z[f], n[f]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(bias + (w.sum() if v is None else w @ v), -35, 35)))
            g = p - y if v is None else (p - y) * v
            z[f] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha * w
            n[f] = ni + g * g
            bias_n += (p - y) ** 2
            bias -= s.alpha * (p - y) / (s.beta + np.sqrt(bias_n))
    w = weight(z, n)
    some = np.flatnonzero(w)
    return Model(s, bias, some, w[some].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str, s: Settings, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learn ``label`` (0 or 1) from the rows that aren't held out.

    A doc_id labelled more than once has its commoner label (1 on a tie); null
    labels don't count. About sample_rows labelled ids are drawn by hash and
    broadcast; their texts (whole) go to one task, which reads them in hash order
    up to sample_bytes. Without labelled rows every score is 0.5. The weights brought to the driver are dims at most.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
             .groupBy(F.col(doc_id).cast("long").alias("_id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_y")))
    rate = min(1.0, s.sample_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("_id", F.lit("draw")), F.lit(1_000_000)) < max(1, round(rate * 1e6)))
    sample = (docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
              .join(F.broadcast(drawn), on="_id").select(F.xxhash64("_id", F.lit("order")).alias("_at"), "text", "_y"))

    def learn(batches):
        data, size = [], 0
        for b in batches:
            if size > s.sample_bytes:
                continue
            ys = b.column("_y").to_pylist()
            size += b.column("text").nbytes
            data += [(f, v, y) for (f, v), y in zip(examples(b.column("text"), s), ys)]
        m = follow(data, s) if data else Model(s, 0.0, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32))
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"feature": np.r_[-1, m.features], "weight": np.r_[m.bias, m.weights].astype(float)}),
                                         preserve_index=False)

    got = sample.repartition(1).sortWithinPartitions("_at", "text").mapInArrow(learn, "feature long, weight double").toPandas()
    own = got["feature"] >= 0
    bias = float(got.loc[~own, "weight"].iloc[0]) if (~own).any() else 0.0
    return Model(s, bias, got.loc[own, "feature"].to_numpy(), got.loc[own, "weight"].to_numpy(dtype=np.float32))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 for each text: sparse dot products with the features that have weight."""
    s, table = model.settings, model.table()
    out = np.full(len(texts), model.bias)
    for at, run in runs(texts):
        doc, found = words(run)
        total, hits = np.zeros(len(run)), []
        for d, f in grams(doc, found, s.kinds, s.dims):
            total += np.bincount(d, minlength=len(run))
            some = table[f] != 0
            hits.append(d[some] * s.dims + f[some])
        if not hits:
            continue
        key, count = np.unique(np.concatenate(hits), return_counts=True)
        d = key // s.dims
        value = np.ones(len(key)) if s.presence else np.sqrt(count / np.maximum(total[d], 1))
        out[at:at + len(run)] += np.bincount(d, table[key % s.dims] * value, minlength=len(run))
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def score(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """Column of scores; the weights, at most dims floats, are broadcast."""
    shared = share(spark, model)

    @F.arrow_udf(T.DoubleType())
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, shared()))

    return scores(F.col(text))
