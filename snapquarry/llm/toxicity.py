"""Toxicity: a classifier chain over the labelled categories.

The categories are predicted one after another: the linear (logistic) model of category
j sees the text's features and the probabilities of categories 0..j-1. In training these
earlier probabilities are out-of-fold predictions, so that a later model learns from the
errors an earlier one really makes; the earlier models are then refitted on all rows of
the sample. Features are presences: letter words, their first 4 to 8 bytes, and byte
trigrams, hashed, of which those that depend most on a label are kept (chi-squared).
Presence, not frequency, so that one slur in a very long text still counts; each feature
is divided by its root mean square, so that a rare word is learned as fast as a common one.

The labels table marks two categories, junk (quality 0) and toxic (toxic 1); the chain
runs in that order. Any list of 0/1 label columns works.

Defined results: null and empty texts get the models' values without features; repeated
rows repeat; an empty table gives an empty result; a category without both labels in the
sample gets its frequency (0.5 without rows). Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import grams
from snapquarry.llm.common import buffers, held_out, labelled_texts, map_text, sample, table

BITS, FEATURES, FOLDS, PREFIXES = 18, 2048, 5, (4, 5, 6, 7, 8)
SAMPLE_PER_STRATUM = 2000  # bound of the training sample: rows of each combination of labels


def buckets(texts: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (bucket, document) of every feature place."""
    data, off = buffers(pc.utf8_lower(texts))
    if not len(data):
        return []
    move = np.uint32(32 - bits)
    s, e, doc = grams.words(data, off, grams.LETTER)
    out = [((grams.word_hashes(data, s, e) >> move).astype(np.int64), doc)]
    for n in PREFIXES:
        long = e - s >= n
        out.append((grams.ngram_hashes(data, n, bits)[s[long]], doc[long]))
    h = grams.ngram_hashes(data, 3, bits)
    at = np.repeat(np.arange(len(texts)), np.diff(off))[: len(h)]
    inside = np.arange(len(h)) + 3 <= off[1:][at]
    out.append((h[inside], at[inside]))
    return out


def presences(texts: pa.Array, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of each selected feature that a document has, once."""
    keys = [np.zeros(0, np.int64)]
    for h, doc in buckets(texts):
        f = index[h]
        hit = f >= 0
        keys.append(doc[hit] * n + f[hit])
    keys = np.unique(np.concatenate(keys))
    return keys // n, keys % n


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 300) -> np.ndarray:
    """Weights and, last, the bias, by accelerated gradient descent on the penalised log loss of the columns over their root mean squares."""
    size = np.sqrt((x**2).mean(0)) if len(x) else np.zeros(x.shape[1])
    scale = np.r_[np.where(size > 0, size, 1), 1].astype(np.float32)
    x = np.c_[x, np.ones(len(x), np.float32)].astype(np.float32) / scale
    if len(np.unique(y)) < 2:
        w = np.zeros(x.shape[1], np.float32)
        w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else 0.0
        return w
    ridge = np.full(x.shape[1], penalty, np.float32)
    ridge[-1] = 1e-3
    v = np.random.default_rng(0).random(x.shape[1]).astype(np.float32)
    for _ in range(12):
        v = x.T @ (x @ v)
        size = np.linalg.norm(v)
        v /= size
    rate = 1 / (0.25 * size + penalty)
    w = ahead = np.zeros(x.shape[1], np.float32)
    for i in range(steps):
        g = x.T @ (sigmoid(x @ ahead) - y).astype(np.float32) + ridge * ahead
        new = ahead - rate * g
        ahead = new + (i / (i + 3)) * (new - w)
        w = new
    return w / scale


@dataclass
class Chain:
    index: np.ndarray  # bucket -> feature, or -1
    categories: tuple
    weights: list = field(default_factory=list)  # one vector for each category: features, earlier categories, bias
    features: int = 0

    def probabilities(self, texts: pa.Array) -> list[np.ndarray]:
        doc, f = presences(texts, self.index, max(1, self.features))
        out: list[np.ndarray] = []
        for w in self.weights:
            z = np.bincount(doc, w[: self.features][f], len(texts)) + w[-1]
            for k, p in enumerate(out):
                z = z + w[self.features + k] * logit(p)
            out.append(sigmoid(z))
        return out


def select(texts: pa.Array, labels: np.ndarray, most: int) -> np.ndarray:
    """The buckets with the largest chi-squared against any category, in at least two documents."""
    n = len(texts)
    with_, hit = np.zeros(1 << BITS), np.zeros((labels.shape[1], 1 << BITS))
    for i in range(0, n, 256):
        part = buckets(texts.slice(i, 256))
        if not part:
            continue
        keys = np.unique(np.concatenate([d * (1 << BITS) + h for h, d in part]))
        doc, h = keys >> BITS, keys & ((1 << BITS) - 1)
        with_ += np.bincount(h, minlength=1 << BITS)
        for c in range(labels.shape[1]):
            hit[c] += np.bincount(h, labels[i + doc, c], 1 << BITS)
    best = np.zeros(1 << BITS)
    for c in range(labels.shape[1]):
        rate = labels[:, c].mean()
        spread = with_ * (1 - with_ / n) * rate * (1 - rate)
        best = np.maximum(best, np.where(with_ >= 2, (hit[c] - with_ * rate) ** 2 / np.maximum(spread, 1e-9), 0))
    chosen = np.argsort(-best, kind="stable")[:most]
    index = np.full(1 << BITS, -1, np.int32)
    index[chosen[best[chosen] > 0]] = np.arange((best[chosen] > 0).sum())
    return index


def out_of_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Each row's probability by a model of the rows of the other folds."""
    out = np.zeros(len(y), np.float32)
    for k in np.unique(fold).tolist():
        w = logistic(x[fold != k], y[fold != k])
        out[fold == k] = sigmoid(x[fold == k] @ w[:-1] + w[-1])
    return out


def train(texts: pa.Array, labels: np.ndarray, categories: Sequence[str], folds: int = FOLDS) -> Chain:
    if not len(texts):
        return Chain(np.full(1 << BITS, -1, np.int32), tuple(categories), [np.zeros(k + 1, np.float32) for k in range(len(categories))])
    index = select(texts, labels, FEATURES)
    n = int(index.max()) + 1
    x = np.zeros((len(texts), n), np.float32)
    for i in range(0, len(texts), 256):
        doc, f = presences(texts.slice(i, 256), index, max(1, n))
        x[i + doc, f] = 1
    chain, fold = Chain(index, tuple(categories), [], n), np.arange(len(texts)) % folds
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(np.float32)
        chain.weights.append(logistic(x, y))
        if c + 1 < labels.shape[1]:
            x = np.c_[x, logit(out_of_fold(x, y, fold)).astype(np.float32)]
    return chain


def fit(documents: DataFrame, labels: DataFrame, categories: Sequence[str], per_stratum: int = SAMPLE_PER_STRATUM) -> Chain:
    """``labels``: doc_id and a 0/1 column for each category. Held-out ids are never learned from."""
    cols = [F.max(c).cast("int").alias(c) for c in categories]
    known = labels.filter(~held_out(F.col("doc_id"))).dropna(subset=["doc_id", *categories]).groupBy("doc_id").agg(*cols)
    rows = labelled_texts(documents, sample(known, "doc_id", list(categories), per_stratum), categories)
    return train(rows["text"].combine_chunks(), np.stack([np.asarray(rows[c], np.int64) for c in categories], 1), categories)


def score(df: DataFrame, chain: Chain, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep`` and a probability column ``p_<category>`` for each category."""
    shared = df.sparkSession.sparkContext.broadcast(chain)

    def make():
        m = shared.value
        return m.probabilities

    return map_text(df, make, keep, ", ".join(f"p_{c} double" for c in chain.categories), text_col)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: both probabilities; ``score`` is the toxic one and ``predicted`` whether it reaches 0.5."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    chain = fit(docs, labels, ["junk", "toxic"])
    scored = score(docs, chain, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p_junk", "p_toxic", F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"))
