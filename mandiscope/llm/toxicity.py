"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import held_out, sample_ids, whole_text

#: Labelled documents the model is fitted on at most.
FIT_ROWS = 12_000
#: Hash space of the features; it bounds the weights that go to the tasks.
BITS = 20
PASSES = 5

_WORD = re.compile(r"[^\W_]+")


class Weights(NamedTuple):
    """The features with a weight, and the weight that every document has."""

    features: np.ndarray
    values: np.ndarray
    bias: float


class _Ids(dict):
    """A number for each word; forgotten and made again when there are many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        number = self[word] = zlib.crc32(word.encode("utf-8", "replace"))
        return number


_IDS = _Ids()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str) -> np.ndarray:
    """Hashed words, pairs of neighbours, and pairs with one word between, of the whole text; with repeats."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words))
    pair, gap = np.uint64(0x100000001B3), np.uint64(0x1000193000F1)
    return _mixed(np.concatenate((h, h[:-1] * pair + h[1:] + np.uint64(1 << 40), h[:-2] * gap + h[2:] + np.uint64(1 << 41))))


class Ftrl:
    """Follow the regularised leader: a rate for each coordinate, L1 keeps coordinates without evidence at zero."""

    def __init__(self, alpha: float = 2.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(at == 1 << BITS, 0.0, self.l1), 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, passes: int = PASSES) -> Weights:
    """Weights from documents with a label whose id is not held out, ``rows`` of them at most (picked by hash).

    A document with several labels is toxic if any says so. The sample is bounded, so one task fits it, in an order
    that depends on ids only. Without a labelled document all weights are zero.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.where(~held_out()).select("doc_id").join(marked.select("doc_id"), "doc_id", "left_semi")
    picked = sample_ids(known, rows).join(marked, "doc_id")
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id")

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"])
        bias = np.array([1 << BITS])
        seen = [np.concatenate((np.unique(features(t)), bias)).astype(np.int32) for t in group["text"]]
        model, order = Ftrl(), np.random.default_rng(0)
        for _ in range(passes):
            for k in order.permutation(len(seen)):
                model.learn(seen[k], int(group["toxic"].iat[k] > 0))
        at = np.arange((1 << BITS) + 1)
        w = model.weights(at)
        kept = np.flatnonzero(w)
        return pd.DataFrame({"feature": kept, "weight": w[kept]})

    found = sample.groupBy(F.lit(0).alias("all")).applyInPandas(train, "feature long, weight double").toPandas()
    at, w = found["feature"].to_numpy(), found["weight"].to_numpy()
    own = at < 1 << BITS
    return Weights(at[own], w[own], float(w[~own].sum()))


def score(docs: DataFrame, weights: Weights):
    """Column of the probability that ``text`` is toxic, from the set of features it has."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        table = np.zeros(1 << BITS)
        table[model.features] = model.values
        for batch in texts:
            logits = np.full(len(batch), model.bias)
            for k, text in enumerate(batch):
                at = features(text)
                hits = at[table[at] != 0]
                if len(hits):
                    logits[k] += table[np.unique(hits)].sum()
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(logits, -60, 60))))

    return probability(whole_text())


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of 0.5).

    Null and empty texts get the score of a text without features. A null id counts as the empty text for
    ``held_out`` and is never learnt from. Repeated rows are scored alike. Other columns, in ``docs`` also those named
    like results, are ignored. An empty table gives no rows.
    """
    weights = fit(docs, labels, rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted to be toxic; all columns stay."""
    return docs.where(score(docs, fit(docs, labels)) < 0.5)
