"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs and character
n-grams; a softmax over a linear map of that average gives the class probabilities. The
n-grams are of characters, not bytes, and lie within a word and the blanks beside it, which
mark its beginning and end. Vectors and map are learned together by stochastic gradient
descent (Adagrad steps) in numpy on a bounded sample of labelled rows. Since the map is
linear, scoring needs only one number for each bucket and class, so a worker holds a table
of 2^bits x classes floats and scores whole texts in a few array passes.

Defined results: null and empty texts are scored by the bias alone; a text shorter than
the n-grams by the features it has; repeated rows give repeated results; an empty table
gives an empty one; with no labelled rows, or one class only, every score is that
class's frequency (0.5 without any). Extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import grams
from snapquarry.llm.common import buffers, held_out, labelled_texts, map_text, sample, table

BITS, DIM, NGRAMS = 17, 12, (3, 4)
SAMPLE_PER_CLASS = 1500  # bound of the training sample: rows of each label


@dataclass
class Model:
    weights: np.ndarray  # 2^bits x classes, the embedding table times the linear map, less the first class's column
    bias: np.ndarray
    bits: int = BITS
    ngrams: tuple = NGRAMS

    def logits(self, texts: pa.Array) -> np.ndarray:
        k = self.weights.shape[1]
        total, count = np.zeros((len(texts), k)), np.zeros(len(texts))
        for h, doc in features(texts, self.bits, self.ngrams):
            for c in range(1, k):
                total[:, c] += np.bincount(doc, self.weights[:, c][h], len(texts))
            count += np.bincount(doc, minlength=len(texts))
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        z = self.logits(texts)
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def word_features(data: np.ndarray, off: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and documents of words and of word pairs. A pair's hash is the exclusive or of its words', so that any word said twice running falls into one bucket."""
    s, e, doc = grams.words(data, off, ~grams.SPACE)
    h, move = grams.word_hashes(data, s, e), np.uint32(32 - bits)
    same = doc[1:] == doc[:-1]
    return [((h >> move).astype(np.int64), doc), (((h[1:] ^ h[:-1])[same] * grams.STEP >> move).astype(np.int64), doc[1:][same])]


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the texts' offsets among them."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return codes, np.r_[0, np.cumsum((data & 0xC0) != 0x80)][off]


def subwords(codes: np.ndarray, off: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and documents of the n-grams of characters inside a text that have no blank but at their ends."""
    h = grams.ngram_hashes(codes, n, bits)
    inside = np.ones(len(h), bool)
    blank = grams.SPACE[np.minimum(codes, 255)]
    for k in range(1, n - 1):
        inside &= ~blank[k : k + len(h)]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(h)]
    inside &= np.arange(len(h)) + n <= off[1:][doc]
    return h[inside], doc[inside]


def features(texts: pa.Array, bits: int, ngrams: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and documents of every feature place."""
    data, off = buffers(texts)
    if not len(data):
        return []
    codes, places = characters(data, off)
    return [*(subwords(codes, places, n, bits) for n in ngrams), *word_features(data, off, bits)]


def shares(texts: pa.Array, bits: int, ngrams: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each document's buckets and their shares of its features."""
    out = []
    for i in range(len(texts)):
        ids, n = np.unique(np.concatenate([np.zeros(0, np.int64), *(h for h, _ in features(texts.slice(i, 1), bits, ngrams))]), return_counts=True)
        out.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    return out


def gradients(vectors: np.ndarray, share: np.ndarray, top: np.ndarray, bias: np.ndarray, label: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """A document's softmax loss and its derivatives by the average vector, the map and the bias; that by a bucket's vector is its share times the first."""
    h = share @ vectors
    z = h @ top + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    loss = -float(np.log(p[label]))
    p[label] -= 1
    return loss, top @ p, np.outer(h, p), p


def train(texts: pa.Array, labels: np.ndarray, classes: int = 2, bits: int = BITS, dim: int = DIM, ngrams: tuple = NGRAMS, epochs: int = 12, rate: float = 0.3, seed: int = 7) -> Model:
    """Stochastic gradient descent on the softmax loss, one document a step."""
    prior = np.log((np.bincount(labels, minlength=classes) + 0.5) / (len(labels) + 0.5 * classes))
    if len(np.unique(labels)) < 2:
        return Model(np.zeros((1 << bits, classes), np.float32), prior - prior[0], bits, ngrams)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    top, bias = np.zeros((dim, classes), np.float32), prior.astype(np.float32)
    seen, seen_top, seen_bias = np.full(1 << bits, 1e-6, np.float32), np.full_like(top, 1e-6), np.full_like(bias, 1e-3)
    docs = shares(texts, bits, ngrams)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            _, g_h, g_top, p = gradients(emb[ids], share, top, bias, labels[i])
            seen_top += g_top**2
            seen_bias += p**2
            top -= step * g_top / np.sqrt(seen_top)
            bias -= 0.1 * step * p / np.sqrt(seen_bias)
            if len(ids):
                seen[ids] += share**2 * (g_h @ g_h) / dim
                emb[ids] -= (0.3 * step * share / np.sqrt(seen[ids]))[:, None] * g_h
    w = emb @ top
    return Model(np.asfortranarray(w - w[:, :1], np.float32), (bias - bias[0]).astype(np.float64), bits, ngrams)


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on about ``per_class`` rows of each label (``labelled_texts`` bounds their bytes), never on held-out ids."""
    ids = labels.filter(F.col(label_col).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    rows = labelled_texts(documents, sample(ids, "doc_id", ["label"], per_class), ["label"])
    return train(rows["text"].combine_chunks(), np.asarray(rows["label"], np.int64))


def score(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and ``score`` (probability of class 1) of every row, from its whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        return lambda texts: [m.probabilities(texts)[:, 1]]

    return map_text(df, make, keep, "score double", text_col)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
