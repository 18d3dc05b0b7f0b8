"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q and at least max(12, 2 q) words that no
neighbour extends. At each dyadic scale the periods from L to 2 L - 1 are looked for: the
texts' words are cut into aligned blocks, short enough that every such run holds a whole block
whose copy one period further is inside the run too. The sum of squared differences of a block
and each place of the windows after it is a convolution, taken exactly by a number-theoretic
transform of residues modulo a prime; where it is zero the block occurs again (or, rarely,
the residues cancel, which the extension then sees). The distance of block and occurrence is
extended to both sides to the whole stretch.

Blocks that hold a word whose next occurrence is too far away can't occur again and are left
out. Occurrences inside a run that is already known, at a multiple of its period, lead back to
that run and are dropped; scales go upwards, so a run is always known before its multiples.
A document with very many different distances is extended by ranks of its substrings of
dyadic lengths, in place of a comparison for each distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm.common import buffers, map_text, table

LEAST = 12
P, ROOT = 998244353, 3  # 119 * 2^23 + 1, and a generator
LARGEST = 1 << 20  # words of the largest block
CELLS = 1 << 20  # numbers that are transformed together
PROBE = 16  # words by which each occurrence is extended at once, before distances are
DISTANCES = 48  # of one document at one scale: more of them are extended by ranks
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def reduced(x: np.ndarray) -> np.ndarray:
    return x - x // P * P


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    k = 1
    while k < n:
        out[k : 2 * k] = reduced(out[: min(k, n - k)] * pow(base, k, P))
        k *= 2
    return out


class Transform:
    """The number-theoretic transform of rows of ``n`` numbers (a power of two)."""

    def __init__(self, n: int):
        self.n = n
        w = pow(ROOT, (P - 1) // n, P)
        self.w = [powers(pow(w, n // (2 * h), P), h) for h in [1 << k for k in range(n.bit_length() - 1)]]
        self.v = [powers(pow(pow(w, n // (2 * h), P), P - 2, P), h) for h in [1 << k for k in range(n.bit_length() - 1)]]
        self.scale = pow(n, P - 2, P)

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Rows in natural order to rows in bit-reversed order."""
        x = x.copy()
        for w in reversed(self.w):
            h = len(w)
            y = x.reshape(-1, self.n // (2 * h), 2, h)
            a, b = y[:, :, 0], y[:, :, 1]
            d = reduced((a - b + P) * w)
            s = a + b
            s -= (s >= P) * P
            y[:, :, 0], y[:, :, 1] = s, d
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        """Rows in bit-reversed order back to natural order."""
        x = x.copy()
        for v in self.v:
            h = len(v)
            y = x.reshape(-1, self.n // (2 * h), 2, h)
            a, b = y[:, :, 0].copy(), reduced(y[:, :, 1] * v)
            s = a + b
            s -= (s >= P) * P
            d = a - b
            d += (d < 0) * P
            y[:, :, 0], y[:, :, 1] = s, d
        return reduced(x * self.scale)


def scales(longest: int) -> list[tuple[int, int]]:
    """(least period L, block length b) of each scale; a run of max(12, 2 p) words at period p < 2 L holds an aligned block with its copy."""
    out, low = [], 1
    while 2 * low <= longest:
        out.append((low, {1: 4, 2: 4, 4: 2, 8: 4}.get(low, min(low // 2, LARGEST))))
        low *= 2
    return out


def occurrences(x: np.ndarray, near: np.ndarray, low: int, b: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(starts of blocks, distances from low to 2 low - 1 at which the block occurs again) over residues ``x``; near: distance to each word's next occurrence."""
    n = len(x)
    m = n // b
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blocks = np.flatnonzero(near[: m * b].reshape(m, b).max(axis=1) < 2 * low)
    blocks = blocks[blocks * b + b + low <= n]
    if not len(blocks):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t = Transform(2 * b)
    padded = np.zeros((n // b + 4 + 2 * low // b) * b, np.int64)
    padded[:n] = x
    pieces = padded.reshape(-1, b)
    energy = np.r_[0, np.cumsum(reduced(padded * padded))]
    starts, distances = [], []
    step = max(1, cells // (2 * b))
    for k in range(0, len(blocks), step):
        j = blocks[k : k + step]
        own = np.zeros((len(j), 2 * b), np.int64)
        own[:, 0] = pieces[j, 0]
        own[:, b + 1 :] = pieces[j, :0:-1]  # reversed, so that the product is a correlation
        head = t.forward(own)
        square = energy[j * b + b] - energy[j * b]
        for part in range(low // b, (2 * low - 1) // b + 1):
            first = np.minimum(j + part, len(pieces) - 2)
            window = t.forward(np.concatenate([pieces[first], pieces[first + 1]], axis=1))
            cross = t.inverse(reduced(head * window))[:, :b]
            at = (j * b)[:, None] + part * b + np.arange(b)[None, :]
            inside = at + b <= n
            at = np.minimum(at, n - b)
            difference = square[:, None] + energy[at + b] - energy[at] - 2 * cross
            d = part * b + np.arange(b)
            hit = (difference % P == 0) & inside & ((d >= low) & (d < 2 * low))[None, :]
            r, c = np.nonzero(hit)
            starts.append(j[r] * b)
            distances.append(d[c])
    return np.concatenate(starts), np.concatenate(distances)


def dyadic_ranks(x: np.ndarray) -> list[np.ndarray]:
    """For each k the number of the substring of 2^k words at each place; equal substrings have equal numbers."""
    out, k = [x], 1
    while 2 * k <= len(x):
        before = out[-1]
        _, now = np.unique(before[: len(before) - k] * (int(before.max()) + 1) + before[k:], return_inverse=True)
        out.append(now)
        k *= 2
    return out


def common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from i and from j (> i) on, or before them, are equal."""
    i, j = i.copy(), j.copy()
    begun, n = j.copy(), len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        s = 1 << k
        if back:
            ok = i >= s
            same = ok & (ranks[k][np.maximum(i - s, 0)] == ranks[k][np.where(ok, j - s, 0)])
            i, j = i - s * same, j - s * same
        else:
            ok = j + s <= n
            same = ok & (ranks[k][np.minimum(i, n - s)] == ranks[k][np.minimum(j, n - s)])
            i, j = i + s * same, j + s * same
    return np.abs(j - begun)


def stretches(x: np.ndarray, t: np.ndarray, d: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, end, period) of the maximal stretches of one document around its occurrences."""
    found = set()
    if len(np.unique(d)) <= DISTANCES:
        for p in np.unique(d).tolist():
            same = np.r_[False, x[:-p] == x[p:], False]
            edges = np.flatnonzero(same[1:] != same[:-1])
            s, e = edges[::2], edges[1::2]
            own = np.unique(np.searchsorted(s, t[d == p], "right") - 1)
            found |= {(int(s[k]), int(e[k]) + p, p) for k in own if k >= 0 and e[k] + p - s[k] >= max(LEAST, 2 * p)}
        return found
    ranks = dyadic_ranks(np.unique(x, return_inverse=True)[1])
    s, e = t - common(ranks, t, t + d, back=True), t + d + common(ranks, t, t + d)
    ok = e - s >= np.maximum(LEAST, 2 * d)
    return set(zip(s[ok].tolist(), e[ok].tolist(), d[ok].tolist(), strict=True))


def probed(x: np.ndarray, doc: np.ndarray, t: np.ndarray, d: np.ndarray, b: int) -> np.ndarray:
    """Which occurrences may be in a run: those that still go on after ``PROBE`` words, or are long enough as they end."""
    n, length = len(x), np.full(len(t), b)
    real = doc[t] == doc[t + d + b - 1]
    for k in range(b):
        real &= x[t + k] == x[t + d + k]
    open_ = np.zeros(len(t), bool)
    for way in (1, -1):
        on = real.copy()
        for k in range(PROBE):
            i = t + b + k if way > 0 else t - 1 - k
            j = np.clip(i + d, 0, n - 1)
            on &= (i >= 0) & (i + d < n)
            i = np.clip(i, 0, n - 1)
            on &= (doc[i] == doc[j]) & (x[i] == x[j])
            length = length + on
        open_ |= on
    return real & (open_ | (length + d >= np.maximum(LEAST, 2 * d)))


def runs(ids: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document that has one, by start, then period. ids: the documents' word numbers one after another; offsets: where each begins."""
    sizes = np.diff(offsets)
    n = len(ids)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if n < LEAST:
        return {}
    order = np.argsort(doc * (int(ids.max()) + 1) + ids, kind="stable")
    near = np.full(n, np.iinfo(np.int64).max)
    again = (doc[order[1:]] == doc[order[:-1]]) & (ids[order[1:]] == ids[order[:-1]])
    near[order[:-1][again]] = (order[1:] - order[:-1])[again]
    residue = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(35)).astype(np.int64) % P
    known: dict[int, set[tuple[int, int, int]]] = {}
    for low, b in scales(int(sizes.max())):
        t, d = occurrences(residue, near, low, b)
        keep = probed(ids, doc, t, d, b)
        t, d = t[keep], d[keep]
        own = doc[t]
        cuts = np.r_[np.flatnonzero(np.diff(own, prepend=-1)), len(own)]  # blocks, and so documents, are ascending
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            k = int(own[i])
            at, p = t[i:j] - offsets[k], d[i:j]
            fresh = np.ones(len(at), bool)
            for s, e, q in known.get(k, ()):
                fresh &= (at < s) | (at + p + b > e) | (p % q != 0)
            if fresh.any():
                known.setdefault(k, set()).update(stretches(ids[offsets[k] : offsets[k + 1]], at[fresh], p[fresh]))
    return {k: sorted((s, e - s, q) for s, e, q in v) for k, v in known.items() if v}


FIELDS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def described(words: list[bytes], found: list[tuple[int, int, int]]) -> list:
    """The values of ``FIELDS`` of one document."""
    keep = np.ones(len(words), bool)
    for s, length, q in found:
        keep[s + q : s + length] = False
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = words if not found else [words[k] for k in np.flatnonzero(keep).tolist()]
    row = [len(found), *(best or (None, None, None)), best[1] * 1000 // best[2] if best else None]
    return [*row, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()]


def text_runs(texts: pa.Array) -> list[list]:
    """The columns of ``FIELDS`` for texts."""
    data, off = buffers(texts)
    raw = data.tobytes()
    lists = [raw[i:j].split() for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]  # at ASCII white space: 9 to 13 and 32
    coded = pa.array([w for words in lists for w in words], pa.large_binary()).dictionary_encode()
    offsets = np.r_[0, np.cumsum([len(w) for w in lists])].astype(np.int64)
    found = runs(np.asarray(coded.indices).astype(np.int64), offsets)
    rows = [described(words, found.get(k, [])) for k, words in enumerate(lists)]
    return [list(c) for c in zip(*rows, strict=True)]


def periodic_runs(df: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep``, the number of runs, the longest one, and digests of all runs and of the text without repetitions.

    Words are what ASCII white space leaves. Of equally long runs the first counts, then that
    of the smaller period. Null and empty texts have no run: null start, length, period and
    exponent_milli, and the digests of the empty text. Repeated rows repeat.
    """
    return map_text(df, lambda: text_runs, keep, FIELDS, text_col)


def with_planted_runs(df: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose crc32(doc_id as text) h is a multiple of 10 repeat themselves: with g = h div 10, n words and a = g mod n, the 1 + (n - a) div (3 + g mod 8) words from a on go round. A null doc_id has h = 0."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def gone_round(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")).otherwise("")

    again = F.get(F.transform(F.array(words), gone_round), F.lit(0))
    return df.select("doc_id", F.when(h % 10 == 0, again).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), ["doc_id"])
