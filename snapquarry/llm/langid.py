"""Language ID: a bidirectional gated recurrent network over bytes, in numpy.

Texts are lower-cased; letters (ASCII ones and every byte of other characters) stay, and
what stands between words becomes one blank. Two gated recurrent layers read this text from
either end, across words; a softmax over both states labels every byte position with the
languages' probabilities, and a document's probabilities are the mean over its letters'
positions. Texts are read in windows of ``CORE`` positions with ``CONTEXT`` more on either
side, which the network reads but which another window labels; so a text of any length is
labelled whole, and windows of all texts of a batch go through the network together.

Gates are piecewise linear. Training is backpropagation through time with Adam on windows
from a bounded sample of documents.

Defined results: null texts and texts without any letter give ``und`` with score 0;
repeated rows repeat; ties go to the first language in sorted order; an empty table gives
an empty result; without a learned language all rows give ``und``. Extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import grams
from snapquarry.llm.common import buffers, held_out, labelled_texts, map_text, sample, table

HIDDEN, CORE, CONTEXT, TOGETHER = 12, 240, 12, 4096
SAMPLE_PER_LANG = 250  # bound of the training sample: documents of each language
WINDOW, WINDOWS_PER_LANG = 40, 6_000  # length of the training windows, and bound of those of each language
INSIDE = grams.LETTER.copy()
INSIDE[48:58] = False
GATE = 4.0  # a gate goes from 0 to 1 over -GATE / 2 .. GATE / 2


def spelled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the lower-cased letters, with one blank for what stands between them."""
    data, off = buffers(pc.utf8_lower(texts))
    letter = INSIDE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = letter[1:] | letter[:-1]
    keep[off[:-1][off[:-1] < len(data)]] = True
    return np.where(letter, data, np.uint8(32))[keep], np.r_[0, np.cumsum(keep)][off]


def windows(off: np.ndarray, core: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, first and end of the labelled part, document) of every window."""
    size = np.diff(off)
    parts = -(-size // core)
    doc = np.repeat(np.arange(len(size)), parts)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, end = k * core, np.minimum((k + 1) * core, size[doc])
    start, stop = np.maximum(first - context, 0), np.minimum(end + context, size[doc])
    return off[doc] + start, stop - start, first - start, end - start, doc


def grid(data: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Windows as columns of a (time, window) array of bytes."""
    t = int(n.max())
    at = np.minimum(s + np.arange(t)[:, None], len(data) - 1)
    return np.where(np.arange(t)[:, None] < n, data[at], 0).astype(np.intp)


def states(p: dict, side: str, x: np.ndarray, n: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, hidden, window) of one layer, which reads forward (f) or from the end (b); zero outside a window.

    ``trace`` gathers what the backward pass needs.
    """
    inp, rec = p[side + "in"], p[side + "rec"]
    hid, least = rec.shape[1], int(n.min())
    h = np.zeros((hid, x.shape[1]), inp.dtype)
    out = np.empty((len(x), hid, x.shape[1]), inp.dtype)
    for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
        a, u = inp.take(x[t], 1), rec @ h
        zr = a[: 2 * hid]
        zr += u[: 2 * hid]
        zr *= 1 / GATE
        zr += 0.5
        np.clip(zr, 0, 1, out=zr)
        z, r, un = zr[:hid], zr[hid:], u[2 * hid :]
        new = r * un
        new += a[2 * hid :]
        np.tanh(new, out=new)
        if trace is not None:
            trace.append((t, h, z, r, un, new))
        h = h - new
        h *= z
        h += new
        if t >= least:
            h *= t < n
        out[t] = h
    return out


def backward(p: dict, side: str, x: np.ndarray, n: np.ndarray, trace: list, g_out: np.ndarray, grads: dict) -> None:
    """Backpropagation through time of one layer."""
    rec, g = p[side + "rec"], np.zeros_like(g_out[0])
    g_in = np.zeros((len(x), rec.shape[0], x.shape[1]), g.dtype)
    for t, h, z, r, un, new in reversed(trace):
        g = (g + g_out[t]) * (t < n)
        g_new = g * (1 - z) * (1 - new * new)
        g_z = g * (h - new) * ((z > 0) & (z < 1)) / GATE
        g_r = g_new * un * ((r > 0) & (r < 1)) / GATE
        g_in[t] = np.concatenate([g_z, g_r, g_new])
        g_u = np.concatenate([g_z, g_r, g_new * r])
        grads[side + "rec"] += g_u @ h.T
        g = g * z + rec.T @ g_u
    for c in range(rec.shape[0]):
        grads[side + "in"][c] += np.bincount(x.ravel(), g_in[:, c].ravel(), 256)


def softmax(z: np.ndarray) -> np.ndarray:
    """Over the languages, the second of three dimensions."""
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def label(p: dict, x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Language probabilities of every position (time, language, window)."""
    z = p["fout"] @ states(p, "f", x, n)
    z += p["bout"] @ states(p, "b", x, n)
    z += p["bias"][:, None]
    return softmax(z)


@dataclass
class Model:
    langs: list
    params: dict

    def sums(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each document's sums of its letter positions' probabilities, and their number."""
        k, docs = len(self.langs), len(off) - 1
        total = np.zeros((docs, k))
        s, n, first, end, doc = windows(off, CORE, CONTEXT)
        order = np.argsort(n, kind="stable")
        for i in range(0, len(order), TOGETHER):
            at = order[i : i + TOGETHER]
            x = grid(data, s[at], n[at])
            t = np.arange(len(x))[:, None]
            probs = label(self.params, x, n[at])
            probs *= ((t >= first[at]) & (t < end[at]) & (x != 32))[:, None]
            part = probs.sum(0)
            for c in range(k):
                total[:, c] += np.bincount(doc[at], part[c], docs)
        letters = np.r_[0, np.cumsum(data != 32)]
        return total, letters[off[1:]] - letters[off[:-1]]


def gradients(p: dict, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean log loss over all positions of the windows, each labelled with its window's language, and its derivatives."""
    tf, tb = [], []
    f, b = states(p, "f", x, n, tf), states(p, "b", x, n, tb)
    g = softmax(p["fout"] @ f + p["bout"] @ b + p["bias"][:, None])
    weight = (np.arange(len(x))[:, None] < n) / g.dtype.type(n.sum())
    own = np.arange(x.shape[1])
    loss = -float((np.log(g[:, y, own]) * weight).sum())
    g[:, y, own] -= 1
    g *= weight[:, None]
    grads = {w: np.zeros_like(v) for w, v in p.items()}
    grads["fout"], grads["bout"], grads["bias"] = (g @ f.transpose(0, 2, 1)).sum(0), (g @ b.transpose(0, 2, 1)).sum(0), g.sum((0, 2))
    backward(p, "f", x, n, tf, p["fout"].T @ g, grads)
    backward(p, "b", x, n, tb, p["bout"].T @ g, grads)
    return loss, grads


def started(k: int, hidden: int, rng: np.random.Generator, kind: type = np.float32) -> dict:
    p = {f"{d}{w}": rng.normal(0, 1 / np.sqrt(hidden), shape).astype(kind) for d in "fb" for w, shape in (("in", (3 * hidden, 256)), ("rec", (3 * hidden, hidden)), ("out", (k, hidden)))}
    p["bias"] = np.zeros(k, kind)
    return p


def train(texts: pa.Array, langs: list, hidden: int = HIDDEN, batch: int = 256, steps: int = 400, rate: float = 0.01, per_lang: int = WINDOWS_PER_LANG, seed: int = 3) -> Model:
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    data, off = spelled(texts)
    s, n, _, _, doc = windows(off, WINDOW, 0)
    y_doc = np.array([names.index(x) for x in langs], np.int64)
    chosen = [np.flatnonzero(y_doc[doc] == k) for k in range(len(names))]
    chosen = np.concatenate([np.zeros(0, np.int64), *(rng.permutation(c)[:per_lang] for c in chosen)])
    s, n, y = s[chosen], n[chosen], y_doc[doc[chosen]]
    if not len(s):
        return Model([], {})
    p = started(len(names), hidden, rng)
    m1, m2 = {w: np.zeros_like(v) for w, v in p.items()}, {w: np.zeros_like(v) for w, v in p.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(s), batch)
        _, grads = gradients(p, grid(data, s[at], n[at]), n[at], y[at])
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        for w in p:
            m1[w] += 0.1 * (grads[w] - m1[w])
            m2[w] += 0.01 * (grads[w] ** 2 - m2[w])
            p[w] -= (now * (m1[w] / (1 - 0.9**step)) / (np.sqrt(m2[w] / (1 - 0.99**step)) + 1e-6)).astype(p[w].dtype)
    return Model(names, p)


def fit(documents: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from text and non-null lang of documents that are not held out (about ``per_lang`` of each language; ``labelled_texts`` bounds their bytes)."""
    known = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.struct("lang", "text")["lang"]).alias("known"))
    rows = labelled_texts(documents.filter(F.col("text").isNotNull()).select("doc_id", "text"), sample(known, "doc_id", ["known"], per_lang), ["known"])
    return train(rows["text"].combine_chunks(), rows["known"].to_pylist())


def predictor(model: Model):
    def f(texts: pa.Array) -> list:
        if not model.langs:
            return [pa.array(["und"] * len(texts)), np.zeros(len(texts))]
        total, count = model.sums(*spelled(texts))
        p = total / np.maximum(count, 1)[:, None]
        letters = np.asarray(pc.match_substring_regex(texts, r"\pL"), bool) & (count > 0)
        langs = np.where(letters, np.array(model.langs, object)[p.argmax(1)], "und")
        return [pa.array(langs.tolist(), pa.string()), np.where(letters, np.clip(p.max(1), 0, 1), 0.0)]

    return f


def predict(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row, from its whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return map_text(df, lambda: predictor(shared.value), keep, "lang_pred string, score double", text_col)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs), ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
