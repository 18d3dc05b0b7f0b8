"""Benchmark decontamination: the q-gram lemma as a filter, banded alignment as the proof.

Texts and benchmark items are lower-cased and every run of white space becomes one space.
An item of m bytes is found where a part of the text lies within k edits of the whole
item, k being ``share`` of m, rounded down. Such a part shares at least m + 1 - q (k + 1) of
its q-grams with the item, and the diagonals (place in the text less place in the item) of
those q-grams lie at most k apart. So the shared q-grams of each document are counted in
diagonal bands that overlap by half, and bands that reach the bound are kept as regions.
Regions pass the same lemma again with grams of ``FINE`` bytes, which tells items with a
common stem apart, and are verified by an alignment of the item with a part of the region,
confined to the band.

q is 16, or 8 for short items for which 16 would leave no shared gram. Items with k = 0 (under 20 bytes) are grams by themselves; they match
exactly, and only at word borders.

A benchmark of up to ``BLOCK`` bytes of text goes to the workers as one index, and documents
are never shuffled. Counting takes bounded memory: hits are dealt by documents and items.

A larger benchmark is never held whole anywhere. k edits leave one of k + 1 disjoint grams of
an item as it is, so each item is known by k + 1 of its grams, its seeds. A bitmap of all
seeds (at most 2^``SEED_BITS`` bits) goes to the workers; places of a document that it lets
through are joined with the seeds by hash, which gives (document, item, band). The text around
each such band is cut out and joined with its item, where the bands about it are counted and
verified as above. The corpus is read twice at any size of the benchmark, once for the rows
with such places and once for the others. Items of equal text are one item until the end. A
seed that many items share meets all of them at each of its places.

Defined results: null and empty texts have no hit, nor have null and blank items; equal
items all hit; repeated rows repeat; an empty benchmark or table gives no hits. Places are
bytes of the normalised text. Extra columns are left out unless kept; kept ones may have
any name but those of the four result columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import grams
from snapquarry.llm.common import buffers, map_text, materialise, packed, table

SHARE, BLOCK = 0.05, 2 << 20
LONG_Q, SHORT_Q, FINE = 16, 8, 4
MOST = 4 << 20  # gram pairs counted at once
FILTER_BITS, SEED_BITS, MOST_PROBES = 22, 28, 8
BEFORE, AFTER = 4, 2  # the bands whose alignments may take in a seed's place
CHUNK = 1000  # bands of a document that are cut together
VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
MULTIPLIER = 0x9E3779B97F4A7C15
RESULT = ["item_ids", "starts", "ends", "edits"]
BORDER = ~(grams.LETTER | (np.arange(256) == 95))


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the lower-cased texts, each run of white space one space."""
    data, off = buffers(pc.utf8_lower(texts))
    space = grams.SPACE[data]
    data = np.where(space, np.uint8(32), data)
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[off[:-1][off[:-1] < len(data)]] = True
    return data[keep], np.r_[0, np.cumsum(keep)][off]


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes at each place."""
    n = len(data) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    v = VALUES[data]
    h, have = np.zeros(n, np.uint64), 0
    power, width, part = MULTIPLIER, 1, v
    while True:  # q as a sum of powers of two; part holds the hash of ``width`` bytes
        if q & width:
            h = h * np.uint64(power) + part[have : have + n]
            have += width
        if have == q:
            return h ^ h >> np.uint64(29)
        part = part[:-width] * np.uint64(power) + part[width:]
        power = power * power & (1 << 64) - 1
        width *= 2


def budget_of(m: int, share: float) -> int:
    return int(m * share + 1e-9)


def gram_of(m: int, k: int) -> int:
    """q for an item of m bytes and k edits: the longest of the three kinds whose bound is at least one gram."""
    if not k:
        return m
    return next(q for q in (LONG_Q, SHORT_Q, *range(SHORT_Q, 0, -1)) if m + 1 - q * (k + 1) >= 1)


@dataclass
class Grams:
    """The index of the items with one q."""

    q: int
    patterns: list  # (item id, bytes)
    hashes: np.ndarray  # sorted distinct q-gram hashes
    first: np.ndarray  # postings of hash i: first[i]:first[i + 1], by pattern
    pattern: np.ndarray
    place: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    seen: np.ndarray  # filter over the top bits
    fine: list  # values and counts of each pattern's short grams

    @classmethod
    def of(cls, q: int, patterns: list, share: float) -> Grams:
        m = np.array([len(b) for _, b in patterns], np.int64)
        budget = np.array([budget_of(len(b), share) for _, b in patterns], np.int64)
        hs = [gram_hashes(np.frombuffer(b, np.uint8), q) for _, b in patterns]
        h, pattern = np.concatenate(hs), np.repeat(np.arange(len(patterns)), [len(x) for x in hs])
        place = np.concatenate([np.arange(len(x)) for x in hs])
        order = np.argsort(h, kind="stable")
        hashes, n = np.unique(h, return_counts=True)
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return cls(q, patterns, hashes, np.r_[0, np.cumsum(n)], pattern[order], place[order], budget, m + 1 - q * (budget + 1), seen, [fine_grams(b) for _, b in patterns])

    def hits(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item id, start, end, edits) of every verified region."""
        h = gram_hashes(data, self.q)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        ok = self.hashes[i] == h[at]
        at, i = at[ok], i[ok]
        doc = np.searchsorted(off, at, "right") - 1
        ok = at + self.q <= off[doc + 1]
        at, i, doc = at[ok], i[ok], doc[ok]
        for d, p, lo, hi in self.regions(at - off[doc], i, doc, 0, len(self.patterns)):
            lo, hi = int(off[d]) + max(0, lo), min(int(off[d + 1]), int(off[d]) + hi)
            item, pattern = self.patterns[p]
            found = self.proved(p, pattern, data, lo, hi, int(off[d]), int(off[d + 1]))
            if found:
                yield d, item, found[0] - int(off[d]), found[1] - int(off[d]), found[2]

    def hits_about(self, region: np.ndarray, base: int, length: int, band: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of the only pattern in the bands about ``band``. The region begins at ``base`` of a text of ``length``; places are the text's."""
        h = gram_hashes(region, self.q)
        if not len(h):
            return
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[i] == h)
        k = int(self.budget[0])
        for _, p, lo, hi in self.regions(at + base, i[at], np.zeros(len(at), np.int64), 0, 1):
            b = (lo + k) // (k + 1)
            if band - (BEFORE if k else 0) <= b <= band + (AFTER if k else 0):
                found = self.proved(p, self.patterns[p][1], region, max(0, lo) - base, min(length, hi) - base, -base, length - base)
                if found:
                    yield base + found[0], base + found[1], found[2]

    def proved(self, p: int, pattern: bytes, data: np.ndarray, lo: int, hi: int, first: int, last: int) -> tuple[int, int, int] | None:
        region, budget = data[lo:hi].tobytes(), int(self.budget[p])
        if not budget:
            s, e = lo, lo + len(pattern)
            bordered = (s == first or BORDER[data[s - 1]] or BORDER[pattern[0]]) and (e == last or BORDER[data[e]] or BORDER[pattern[-1]])
            return (s, e, 0) if bordered and region.startswith(pattern) else None
        if pattern not in region and shared_grams(self.fine[p], fine_grams(region)) < len(pattern) + 1 - FINE * (budget + 1):
            return None
        found = align(pattern, region, budget)
        return (lo + found[0], lo + found[1], found[2]) if found else None

    def regions(self, at: np.ndarray, i: np.ndarray, doc: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int, int]]:
        """(document, pattern, start, end) of the bands of the patterns low..high that reach their bound."""
        if low == 0 and high == len(self.patterns):
            begin, end = self.first[i], self.first[i + 1]
        else:
            key = np.repeat(np.arange(len(self.hashes)), np.diff(self.first)) * len(self.patterns) + self.pattern
            begin, end = np.searchsorted(key, i * len(self.patterns) + low), np.searchsorted(key, i * len(self.patterns) + high)
        n = end - begin
        if n.sum() > MOST:
            cut = np.flatnonzero(doc[1:] != doc[:-1]) + 1
            if len(cut):
                cut = int(cut[len(cut) // 2])
                for part in (slice(0, cut), slice(cut, len(at))):
                    yield from self.regions(at[part], i[part], doc[part], low, high)
                return
            if high - low > 1:
                for part in ((low, (low + high) // 2), ((low + high) // 2, high)):
                    yield from self.regions(at, i, doc, *part)
                return
        some = n > 0
        at, begin, n, doc = at[some], begin[some], n[some], doc[some]
        parts = [np.zeros((4, 0), np.int64)]
        cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(n) // MOST)) + 1, len(n)]
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            c = n[x:y]
            post = np.repeat(begin[x:y] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            pattern, diagonal = self.pattern[post], np.repeat(at[x:y], c) - self.place[post]
            band = diagonal // (self.budget[pattern] + 1)
            d = np.repeat(doc[x:y], c)
            parts.append(summed(np.stack([np.r_[d, d], np.r_[pattern, pattern], np.r_[band, band - 1], np.ones(2 * len(d), np.int64)])))
        key = summed(np.concatenate(parts, 1)) if len(parts) > 2 else parts[-1]
        for d, p, b in key[:3, key[3] >= self.bound[key[1]]].T.tolist():
            k = int(self.budget[p])
            if k:
                yield d, p, b * (k + 1) - k, (b + 2) * (k + 1) + len(self.patterns[p][1]) + k
            else:
                yield d, p, b, b + len(self.patterns[p][1])


def summed(rows: np.ndarray) -> np.ndarray:
    """Distinct columns of the first three rows, with the sums of the last."""
    rows = rows[:, np.lexsort(rows[2::-1])]
    if not rows.shape[1]:
        return rows
    start = np.flatnonzero(np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(0)])
    return np.concatenate([rows[:3, start], np.add.reduceat(rows[3:], start, axis=1)])


def fine_grams(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b, np.uint8).astype(np.uint32)
    n = max(0, len(data) - FINE + 1)
    code = np.zeros(n, np.uint32)
    for k in range(FINE):
        code = code << np.uint32(8) | data[k : k + n]
    return np.unique(code, return_counts=True)


def shared_grams(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return int(np.minimum(a[1][x], b[1][y]).sum())


@dataclass
class Index:
    parts: list

    @classmethod
    def of(cls, items: Sequence[tuple[int, bytes]], share: float = SHARE) -> Index:
        kinds: dict[int, list] = {}
        for i, b in items:
            if b:
                kinds.setdefault(gram_of(len(b), budget_of(len(b), share)), []).append((i, b))
        return cls([Grams.of(q, patterns, share) for q, patterns in sorted(kinds.items())])

    def hits(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item id, start, end, edits) of every item found; of overlapping places of an item the first with the fewest edits."""
        out: list[tuple] = []
        for hit in sorted({h for part in self.parts for h in part.hits(data, off)}, key=lambda h: (h[0], h[1] is None, h[1] or 0, *h[2:])):
            if out and out[-1][:2] == hit[:2] and hit[2] < out[-1][3]:
                out[-1] = min(out[-1], hit, key=lambda h: h[4])
            else:
                out.append(hit)
        return out


def seeds_of(pattern: bytes, share: float) -> tuple[int, np.ndarray, np.ndarray]:
    """(edit budget, places, hashes) of disjoint grams of an item, one more than its edit budget; hashes differ by q."""
    k = budget_of(len(pattern), share)
    q = gram_of(len(pattern), k)
    place = np.arange(k + 1) * (len(pattern) // (k + 1))
    return k, place, seed_hashes(np.frombuffer(pattern, np.uint8), q)[place]


def seed_hashes(data: np.ndarray, q: int) -> np.ndarray:
    h = (gram_hashes(data, q) + np.uint64(q)) * np.uint64(MULTIPLIER)
    return h ^ h >> np.uint64(32)


def probe(h: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th place of each hash in the bitmap of 2^bits."""
    return (h * np.uint64(int(VALUES[k]) | 1) >> np.uint64(64 - bits)).astype(np.int64)


def align(pattern: bytes, region: bytes, budget: int) -> tuple[int, int, int] | None:
    """Start, end and edits of the best alignment of the pattern with a part of the region, or None beyond the budget.

    One row of the edit table for each byte of the pattern. A row is as wide as the
    diagonals that the region leaves (its length less the pattern's, and the budget on
    either side), whatever the pattern's length.
    """
    at = region.find(pattern)
    if at >= 0:
        return at, at + len(pattern), 0
    if not budget or not region:
        return None
    text, m = np.frombuffer(region, np.uint8), len(pattern)
    n = len(text)
    width = max(0, n - m) + 2 * budget + 1  # row i holds the places i - budget .. of the text
    far = m + n
    padded = np.concatenate([np.full(budget + 1, 256, np.int16), text.astype(np.int16), np.full(width + m, 256, np.int16)])
    step = np.arange(width)
    place = step - budget
    cost = np.where((place >= 0) & (place <= n), 0, far)
    begin = place.copy()
    for i, c in enumerate(pattern, 1):
        # The same slot is the diagonal's neighbour, the next slot is the one above.
        same = cost + (padded[i : i + width] != c)
        above = np.r_[cost[1:] + 1, far]
        new, start = np.minimum(same, above), np.where(same <= above, begin, np.r_[begin[1:], 0])
        new[(place + i < 0) | (place + i > n)] = far
        # Insertions: the least of all slots to the left plus their distance.
        left = np.minimum.accumulate((new - step) * (width + 1) + step)
        source = left % (width + 1)
        cost, begin = np.minimum(new[source] + step - source, far), start[source]
        cost[(place + i < 0) | (place + i > n)] = far
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return (int(begin[end]), end - budget + m, int(cost[end])) if cost[end] <= budget else None


def fetched(items: DataFrame) -> list[tuple[int, bytes]]:
    """The items of a small benchmark, normalised, ascending; one of each id and text."""
    rows = items.toArrow()
    if not rows.num_rows:
        return []
    ids = rows["id"].to_pylist()
    return sorted(set(zip(ids, stripped(rows["text"].combine_chunks()), strict=True)), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def stripped(texts: pa.Array) -> list[bytes]:
    data, off = normalised(texts)
    return [data[a:b].tobytes().strip() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def searched(df: DataFrame, items: DataFrame, keep: Sequence[str], share: float) -> DataFrame:
    """``keep`` and the four arrays of hits against a small benchmark."""
    shared = df.sparkSession.sparkContext.broadcast(Index.of(fetched(items), share))

    def make():
        index = shared.value

        def f(texts: pa.Array) -> list:
            data, off = normalised(texts)
            cols: list = [[[] for _ in range(len(texts))] for _ in range(4)]
            for d, *hit in index.hits(data, off):
                for c, v in zip(cols, hit, strict=True):
                    c[d].append(v)
            return cols

        return f

    return map_text(df, make, keep, ", ".join(f"{c} array<bigint>" for c in RESULT))


def seed_rows(share: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each seed of each pattern."""
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            patterns = part.column("pattern").to_pylist()
            got = [seeds_of(x, share) for x in patterns]
            n = [len(place) for _, place, _ in got]
            place, h = (np.concatenate([g[c] for g in got]) for c in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [part.column("pid").take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(h.view(np.int64)), pa.array(place), pa.array(np.repeat([len(x) for x in patterns], n)), pa.array(np.repeat([g[0] for g in got], n)), pa.array(np.repeat([gram_of(len(x), g[0]) for x, g in zip(patterns, got, strict=True)], n))],
                names=["pid", "hash", "place", "size", "budget", "q"],
            )


def words_of(probes: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the bitmap that each batch of hashes sets, and the bits of each."""
    for b in batches:
        h = np.asarray(b.column(0)).view(np.uint64)
        at = np.unique(np.concatenate([probe(h, k, bits) for k in range(probes)]))
        word, first = np.unique(at >> 6, return_index=True)
        if len(word):
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first).view(np.int64))], names=["word", "bits"])


def seed_bitmap(seeds: DataFrame) -> tuple[np.ndarray, int, int]:
    """(words, number of probes, bits) of a bitmap of all seeds: about 26 bits for each, at most 2^``SEED_BITS`` together, which bounds what comes to the driver."""
    n = seeds.count()
    bits = min(SEED_BITS, max(10, (26 * n).bit_length()))
    probes = max(1, min(MOST_PROBES, round(0.69 * (1 << bits) / max(1, n))))
    out = np.zeros(1 << bits - 6, np.uint64)
    rows = seeds.select("hash").mapInArrow(partial(words_of, probes, bits), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[np.asarray(rows["word"])] = np.asarray(rows["bits"]).view(np.uint64)
    return out, probes, bits


def probed(df: DataFrame, seeds: DataFrame) -> DataFrame:
    """``row``, ``text`` and the hashes and places of the grams that the bitmap lets through."""
    kinds = sorted({r.q for r in seeds.select("q").distinct().collect()})  # at most ``LONG_Q`` and one more for each short length
    words, probes, bits = seed_bitmap(seeds)
    shared = df.sparkSession.sparkContext.broadcast(words)

    def make():
        bitmap = shared.value

        def f(texts: pa.Array) -> list:
            data, off = normalised(texts)
            doc, hashes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for q in kinds:
                h = seed_hashes(data, q)
                at = np.arange(len(h))
                for k in range(probes):
                    p = probe(h[at], k, bits)
                    at = at[(bitmap[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)]
                d = np.searchsorted(off, at, "right") - 1
                ok = at + q <= off[d + 1]
                at, d = at[ok], d[ok]
                doc.append(d)
                hashes.append(h[at])
                places.append(at - off[d])
            d = np.concatenate(doc)
            order = np.argsort(d, kind="stable")
            ends = np.searchsorted(d[order], np.arange(len(texts) + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x)[order].view(np.int64))) for x in (hashes, places)]

        return f

    return map_text(df, make, ["row", "text"], "hashes array<bigint>, places array<bigint>")


def reach(band: int, size: int, budget: int) -> tuple[int, int]:
    """Start and end of the text that the bands looked at around ``band`` may take, and a byte on either side."""
    if not budget:
        return band - 1, band + size + 1
    return (band - BEFORE) * (budget + 1) - budget - 1, (band + AFTER + 2) * (budget + 1) + size + budget + 1


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the text around each wanted band."""
    names = ["number", "pid", "band", "base", "length", "region"]
    for b in batches:
        for k in range(b.num_rows):
            data, off = normalised(b.column("text").slice(k, 1))
            n, number, wanted = int(off[1]), b.column("number")[k].as_py(), b.column("wanted")[k].as_py()
            for i in range(0, len(wanted), 100):
                rows = []
                for w in wanted[i : i + 100]:
                    lo, hi = reach(w["band"], w["size"], w["budget"])
                    lo, hi = max(0, lo), min(n, hi)
                    rows.append((number, w["pid"], w["band"], lo, n, data[lo:hi].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)], names=names)


def verified(share: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits in each region, by the bands about the one that a seed gave."""
    pid, grams_ = None, None
    for b in batches:
        rows = []
        for r in b.to_pylist():
            if r["pid"] != pid:
                pid, m = r["pid"], len(r["pattern"])
                grams_ = Grams.of(gram_of(m, budget_of(m, share)), [(0, r["pattern"])], share)
            rows += [(r["number"], pid, *hit) for hit in grams_.hits_about(np.frombuffer(r["region"], np.uint8), r["base"], r["length"], r["band"])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 1 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True) if rows else [()] * 5)], names=["number", "pid", "start", "end", "edits"])


def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of an item's overlapping places in a document the first with the fewest edits."""
    for b in batches:
        out = [[(h["start"], h["end"], h["edits"]) for h in sorted(hits, key=lambda h: (h["start"], h["end"], h["edits"]))] for hits in b.column("hits").to_pylist()]
        kept: list[list] = []
        for hits in out:
            own: list[tuple] = []
            for hit in hits:
                if own and hit[0] < own[-1][1]:
                    own[-1] = min(own[-1], hit, key=lambda h: h[2])
                else:
                    own.append(hit)
            kept.append(own)
        cols = [pa.array([[h[c] for h in own] for own in kept], pa.list_(pa.int64())) for c in range(3)]
        yield pa.RecordBatch.from_arrays([b.column("number"), b.column("id"), *cols], names=["number", "id", *RESULT[1:]])


def joined(some: DataFrame, patterns: DataFrame, texts: DataFrame, seeds: DataFrame, share: float) -> DataFrame:
    """``number`` and the four arrays of hits of the rows that have any, against a benchmark of any size."""
    places = some.select("number", F.explode(F.arrays_zip("hashes", "places")).alias("p")).select("number", F.col("p.hashes").alias("hash"), F.col("p.places").alias("at"))
    band = F.floor((F.col("at") - F.col("place")) / (F.col("budget") + 1)).cast("bigint")
    bands = materialise(places.join(seeds, "hash").select("number", "pid", "size", "budget", band.alias("band")).distinct())
    some_bands = bands.join(bands.groupBy("number").agg(F.count("*").alias("n")), "number")
    chunk = F.pmod(F.xxhash64("pid", "band"), F.ceil(F.col("n") / CHUNK))
    wanted = some_bands.groupBy("number", chunk.alias("chunk")).agg(F.collect_list(F.struct("pid", "size", "budget", "band")).alias("wanted")).drop("chunk")
    regions = some.select("number", "text").join(wanted, "number").select("number", "text", "wanted").mapInArrow(cut_out, "number bigint, pid string, band bigint, base bigint, length bigint, region binary")
    hits = regions.join(texts, "pid").mapInArrow(partial(verified, share), "number bigint, pid string, start bigint, end bigint, edits bigint").distinct()
    own = hits.join(patterns.select("pid", "id"), "pid").groupBy("number", "id").agg(F.collect_list(F.struct("start", "end", "edits")).alias("hits"))
    own = own.mapInArrow(told_apart, "number bigint, id bigint, starts array<bigint>, ends array<bigint>, edits array<bigint>")
    one = own.select("number", "id", F.explode(F.arrays_zip(*RESULT[1:])).alias("h")).select("number", F.struct(F.col("id").isNull().alias("none"), "id", "h.*").alias("h"))
    sorted_ = one.groupBy("number").agg(F.array_sort(F.collect_list("h")).alias("h"))
    return sorted_.select("number", F.col("h.id").alias("item_ids"), *[F.col(f"h.{c}").alias(c) for c in RESULT[1:]])


def contaminated(df: DataFrame, benchmark: DataFrame, keep: Sequence[str], text_col: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE, most: int = BLOCK) -> DataFrame:
    """``keep`` and arrays item_ids, starts, ends, edits of every row's hits, empty for a clean row."""
    rows = packed(df, text_col, keep)
    items = benchmark.filter(F.col(item_text).isNotNull()).select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    none = [F.array().cast("array<bigint>").alias(c) for c in RESULT]
    if not total:
        return rows.select("row.*", *none)
    if total <= most:
        return searched(rows, items, ["row"], share).select("row.*", *RESULT)
    patterns = map_text(items, lambda: lambda texts: [stripped(texts)], ["id"], "pattern binary").filter(F.octet_length("pattern") > 0)
    patterns = materialise(patterns.select("id", "pattern", F.sha2("pattern", 256).alias("pid")))
    texts = materialise(patterns.select("pid", "pattern").dropDuplicates(["pid"]))
    seeds = materialise(texts.mapInArrow(partial(seed_rows, share), "pid string, hash bigint, place bigint, size bigint, budget bigint, q bigint"))
    told = probed(rows, seeds)
    found = F.size("hashes") > 0
    some = materialise(told.filter(found).select("row", "text", "hashes", "places", F.monotonically_increasing_id().alias("number")))
    hits = joined(some, patterns, texts, seeds, share)
    dirty = some.join(hits, "number", "left").select("row.*", *[F.coalesce(c, n).alias(c) for c, n in zip(RESULT, none, strict=True)])
    return told.filter(~found).select("row.*", *none).unionByName(dirty)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item found in a document."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = F.explode(F.arrays_zip("item_ids", "starts", "ends", "edits"))
    return found.filter(F.size("item_ids") > 0).select("doc_id", hit.alias("h")).select("doc_id", F.col("h.item_ids").alias("item_id"), F.col("h.starts").alias("start"), F.col("h.ends").alias("end"), F.col("h.edits").alias("edits"))
