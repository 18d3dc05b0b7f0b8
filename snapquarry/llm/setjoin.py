"""Exact similarity join of shingle sets: prefix filter, parity bitmaps, exact overlap.

A text's set holds its distinct word shingles as 64-bit hashes; equal sets are one node.
Two sets with a Jaccard similarity of at least t share at least ceil(t |x|) members, so in
any one order of all shingles they share one of the first |x| - ceil(t |x|) + 1 of each.
Every node is looked up under these; nodes that meet are candidates, and no pair is
missed, at any number of nodes.

The order is free, so frequent shingles come last: their counts are taken from a sample
of bounded size. What the sample misses costs time, never a pair.

Candidates pass two bounds that hold for every pair at t: the sizes', and that of parity
bitmaps (bit h mod 256 flips with every member h), whose distance is at most the number of
members that only one set has. Pairs that pass meet once more by longer bitmaps, of four
bits a member or more; what is left is verified by the whole texts.

Where two nodes meet at the first member that they share, all that they share stands from
there on in both; so the places of the member in their orders bound what they can share, and
with it which sizes and places can be a pair at all. Nodes that share a frequent shingle
but have no partner of a fitting size and place, such as pages of one template with words of
their own, are never compared.

Where more than ``SMALL`` nodes meet, they are paired with a few of them first, which lie
in the middle of all; when the links so verified are joined to components, all remaining pairs of different components
are candidates too. So a group of thousands of near copies isn't compared pair by pair,
and still no link between components is lost.

A text is hashed once for its signature, which holds the members of the prefix only, and
once for each pair that is verified; whole sets are neither stored nor shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapquarry.llm.common import map_text, materialise, small_batches

SEED, WORDS64 = 42, 4
SMALL, HUBS, CENTRE = 16, 4, 4096  # bitmaps whose majority is taken; only which nodes are hubs depends on them
SAMPLE, SEEN, LETTERS = 4_000_000, 3, 6  # shingles counted for the order, how often a frequent one is met in them at least, bytes a word
FRONT = 256  # rows of a run that are compared together, unless more are of one size and place
BLOCK = 1 << 20  # comparisons made, and shingles ordered, at once
MARKS = 1 << 25  # bits of the bitmap that tells which nodes have candidates
EPS = 1e-9
BITMAP = [f"b{c}" for c in range(WORDS64)]


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every word shingle in order; of the whole sequence for fewer words; none without words."""
    w = text.encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    joined, size = b" ".join(w), np.array([len(x) for x in w], np.int64)
    end = np.cumsum(size + 1) - 1
    start = end - size
    k, digest = min(words, len(w)), xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(start[: len(w) - k + 1].tolist(), end[k - 1 :].tolist(), strict=True)], np.uint64)


def hash_bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def majority(hashes: np.ndarray) -> int:
    """SimHash: a bit is 1 if over half of the hashes have it."""
    counts = np.zeros(64, np.int64)
    for j in range(0, len(hashes), 1 << 15):
        counts += hash_bits(hashes[j : j + (1 << 15)]).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def frequent(df: DataFrame, text_col: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that a sample of the texts (chosen by hash, about ``SAMPLE`` shingles) holds ``SEEN`` times or more, and their counts there."""
    texts = df.select(F.coalesce(text_col, F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE * LETTERS / max(1, total)))))

    def f(parts: pa.Array) -> list:
        found = [np.unique(shingle_hashes(t.as_py(), words)) for t in parts]
        flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        return [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)), pa.array(flat))]

    got = map_text(some, lambda: f, [], "members array<bigint>").select(F.explode("members").alias("v")).groupBy("v").count().filter(F.col("count") >= SEEN).toArrow()
    v, n = np.asarray(got["v"], np.int64), np.asarray(got["count"], np.int64)
    order = np.argsort(v)
    return v[order], n[order]


def prefix(size: np.ndarray, similarity: float) -> np.ndarray:
    return size - np.ceil(similarity * size - EPS).astype(np.int64) + 1


def signatures(df: DataFrame, keep: Sequence[str], text_col: str, words: int, similarity: float) -> DataFrame:
    """``keep``, the node (hash of the whole set), the set's size, its SimHash ``fp``, parity bitmap and the members of its prefix."""
    shared = df.sparkSession.sparkContext.broadcast(frequent(df, text_col, words))

    def first(members: np.ndarray) -> np.ndarray:
        """The set's prefix in the order by count, then value."""
        often, count = shared.value
        v, n = members.view(np.int64), np.zeros(len(members), np.int64)
        if len(often):
            at = np.minimum(np.searchsorted(often, v), len(often) - 1)
            n = np.where(often[at] == v, count[at], 0)
        return v[np.lexsort((v, n))[: int(prefix(np.array(len(v)), similarity))]] if len(v) else v

    def f(texts: pa.Array) -> list:
        found = [np.unique(shingle_hashes(t.as_py(), words)) for t in texts]
        node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in found], np.uint64).view(np.int64)
        size = np.array([len(s) for s in found], np.int64)
        odd = np.zeros((len(found), 64 * WORDS64), np.uint8)
        for i, s in enumerate(found):
            odd[i] = np.bincount((s % np.uint64(64 * WORDS64)).astype(np.int64), minlength=64 * WORDS64) & 1
        bits = np.packbits(odd, axis=1, bitorder="little").view(np.int64)
        keys, marks = [first(s) for s in found], [parity(s, 1 << max(8, int(4 * len(s) - 1).bit_length())) for s in found]
        flat = np.concatenate([np.zeros(0, np.int64), *keys])
        listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)), pa.array(flat))
        fp = np.array([majority(s) for s in found], np.uint64).view(np.int64)
        return [pa.array(node), pa.array(size), pa.array(fp), *[pa.array(np.ascontiguousarray(bits[:, c])) for c in range(WORDS64)], pa.array(marks, pa.binary()), listed]

    return map_text(df, lambda: f, keep, "node bigint, size bigint, fp bigint, " + ", ".join(f"{c} bigint" for c in BITMAP) + ", parity binary, keys array<bigint>", text_col)


def parity(members: np.ndarray, width: int) -> bytes:
    """Bitmap in which every member flips one bit, its value mod ``width``. Its two halves' exclusive or is that of half the width."""
    return np.packbits(np.bincount((members % np.uint64(width)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def plausible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sizes and long bitmaps allow the similarity. nodes: node, size, parity."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, (x, y, m, n) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True)):
                if min(m, n) >= similarity * max(m, n) - EPS:
                    u, v = (np.frombuffer(p, np.uint64) for p in sorted((x, y), key=len))
                    while len(v) > len(u):
                        v = v[: len(v) // 2] ^ v[len(v) // 2 :]
                    ok[i] = np.bitwise_count(u ^ v).sum(dtype=np.int64) <= (1 - similarity) / (1 + similarity) * (m + n) + EPS
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "pa", "pb", "na", "nb").mapInArrow(f, "a bigint, b bigint")


def keyed(rows: DataFrame) -> DataFrame:
    """(v, node, size, bitmap, place): the shingles under which each node is looked up, and their places in its order. A task gives each node once."""
    names = ["v", "node", "size", *BITMAP, "place"]

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            new = []
            for i, x in enumerate(b.column(0).to_pylist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
            b = b.take(pa.array(new, pa.int64()))
            end = np.cumsum(np.asarray(pc.list_value_length(b.column(2 + WORDS64)), np.int64))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + BLOCK, "right")))
                part = b.slice(i, j - i)
                i = j
                keys = part.column(2 + WORDS64)
                row = pc.list_parent_indices(keys)
                n = np.asarray(pc.list_value_length(keys), np.int64)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([keys.flatten(), *[part.column(c).take(row) for c in range(2 + WORDS64)], pa.array(place)], names=names)

    return rows.select("node", "size", *BITMAP, "keys").mapInArrow(f, ", ".join(f"{c} bigint" for c in names))


def near(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows (size, bitmap) may reach the similarity: never false for a pair that does."""
    apart = np.bitwise_count(a[..., 1:].view(np.uint64) ^ b[..., 1:].view(np.uint64)).sum(-1, dtype=np.int64)
    x, y = a[..., 0], b[..., 0]
    return (np.minimum(x, y) >= similarity * np.maximum(x, y) - EPS) & (apart <= (1 - similarity) / (1 + similarity) * (x + y) + EPS)


def may_share(m: np.ndarray, i: np.ndarray, n: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of m and n members whose first shared member stands at places i and j may reach the similarity."""
    return np.minimum(m - i, n - j) >= similarity / (1 + similarity) * (m + n) - EPS


def met(rows: np.ndarray, start: np.ndarray, stop: np.ndarray, similarity: float, _: np.ndarray | None = None) -> list[np.ndarray]:
    """(v, a, b, -1) of the runs start:stop of rows (v, node, size, bitmap, place): all candidates of small runs; for a larger one those with a few of its nodes, and (v, node, node, place) for each of its nodes."""
    out, n = [np.zeros((0, 4), np.int64)], stop - start
    small = n <= SMALL
    last = np.repeat(np.where(small, stop, start), n)  # nothing follows in a large run
    at = np.arange(len(rows))

    def pairs(x: np.ndarray, y: np.ndarray) -> None:
        ok = near(x[:, 2:-1], y[:, 2:-1], similarity) & may_share(x[:, 2], x[:, -1], y[:, 2], y[:, -1], similarity) & (x[:, 1] != y[:, 1])
        out.append(np.stack([x[ok, 0], x[ok, 1], y[ok, 1], np.full(int(ok.sum()), -1)], 1))

    for d in range(1, SMALL):
        i = at[at + d < last]
        if not len(i):
            break
        pairs(rows[i], rows[i + d])
    for s, e in zip(start[~small].tolist(), stop[~small].tolist(), strict=True):
        run = rows[s:e]
        out.append(run[:, [0, 1, 1, -1]])
        for k in hubs(run):
            pairs(np.broadcast_to(run[k], run.shape), run)
    return out


def hubs(run: np.ndarray) -> list[int]:
    """Places of up to ``HUBS`` rows that lie in the middle of a large run: nearest to the majority of all bitmaps, then to that of the half that lies farthest from the hubs so far. Variants of one text thus meet at the text."""
    bitmaps = np.ascontiguousarray(run[:, 3 : 3 + WORDS64]).view(np.uint64)
    apart, out, some = np.full(len(run), 64 * WORDS64, np.int64), [], np.arange(len(run))
    while len(out) < HUBS and len(some):
        bits = np.unpackbits(bitmaps[some[:CENTRE]].view(np.uint8), axis=1)
        middle = np.packbits(bits.sum(0, dtype=np.int64) * 2 > len(bits)).view(np.uint64)
        hub = int(some[np.bitwise_count(bitmaps[some] ^ middle).sum(1, dtype=np.int64).argmin()])
        out.append(hub)
        apart = np.minimum(apart, np.bitwise_count(bitmaps ^ bitmaps[hub]).sum(1, dtype=np.int64))
        some = np.flatnonzero(apart > np.median(apart))
    return out


def folded(marks: np.ndarray) -> dict[int, np.ndarray]:
    """By each width of bitmap there is: all bitmaps of it or more as rows of words, longer ones folded to it."""
    width = np.array([len(m) for m in marks])
    out = {}
    for w in np.unique(width).tolist():
        out[w] = np.zeros((len(marks), w // 8), np.uint64)
        for longer in np.unique(width[width >= w]).tolist():
            at = np.flatnonzero(width == longer)
            part = np.frombuffer(b"".join(marks[at]), np.uint64).reshape(len(at), -1)
            while part.shape[1] * 8 > w:
                part = part[:, : part.shape[1] // 2] ^ part[:, part.shape[1] // 2 :]
            out[w][at] = part
    return out


def alike(run: np.ndarray, marks: np.ndarray, tables: dict[int, np.ndarray], x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs of places x, y of a run may reach the similarity by their long bitmaps."""
    width = np.array([len(m) for m in marks])
    low, ok = np.minimum(width[x], width[y]), np.zeros(len(x), bool)
    most = (1 - similarity) / (1 + similarity) * (run[x, 2] + run[y, 2]) + EPS
    for w, table in tables.items():
        at = np.flatnonzero(low == w)
        for i in range(0, len(at), max(1, BLOCK // w)):
            some = at[i : i + max(1, BLOCK // w)]
            ok[some] = np.bitwise_count(table[x[some]] ^ table[y[some]]).sum(1, dtype=np.int64) <= most[some]
    return ok


def fronts(kinds: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of sorted kinds: ``most`` rows or fewer, and a kind of many rows by itself."""
    cuts, out, begun = [*np.flatnonzero(np.diff(kinds, prepend=-1)).tolist(), len(kinds)], [], 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - begun > FRONT and a > begun:
            out.append((begun, a))
            begun = a
        while b - begun > most:
            out.append((begun, begun + most))
            begun += most
    return [*out, (begun, len(kinds))] if begun < len(kinds) else out


def apart(rows: np.ndarray, start: np.ndarray, stop: np.ndarray, similarity: float, marks: np.ndarray) -> list[np.ndarray]:
    """(v, a, b, -1) of all candidates whose labels differ, in runs of rows (v, node, size, bitmap, label, place) with long bitmaps ``marks``. Rows are only compared with those of fitting sizes and places."""
    out = [np.zeros((0, 4), np.int64)]
    for s, e in zip(start.tolist(), stop.tolist(), strict=True):
        run, long = rows[s:e], marks[s:e]
        labels, n = np.unique(run[:, -2], return_counts=True)
        if len(labels) < 2:
            continue
        kinds, kind = np.unique(run[:, [2, -1]], axis=0, return_inverse=True)
        kind = kind.ravel()
        # Two nodes of the largest component need no comparison: the others are compared with all.
        other = run[:, -2] != labels[n.argmax()]
        order = np.r_[np.flatnonzero(other)[np.argsort(kind[other], kind="stable")], np.flatnonzero(~other)]
        run, long, kind, front_n = run[order], long[order], kind[order], int(other.sum())
        tables = None
        for i, j in fronts(kind[:front_n], max(1, BLOCK // len(run))):
            own = np.unique(kind[i:j])
            fits = np.zeros(len(kinds), bool)
            for k in own:
                fits |= may_share(*kinds[k], kinds[:, 0], kinds[:, 1], similarity) & (np.minimum(kinds[k, 0], kinds[:, 0]) >= similarity * np.maximum(kinds[k, 0], kinds[:, 0]) - EPS)
            cols = np.flatnonzero(fits[kind])
            cols = cols[cols > i]
            if not len(cols):
                continue
            front, back = run[i:j], run[cols]
            x, y = np.nonzero((front[:, None, -2] != back[None, :, -2]) & near(front[:, None, 2:-2], back[None, :, 2:-2], similarity) & may_share(front[:, None, 2], front[:, None, -1], back[None, :, 2], back[None, :, -1], similarity))
            x, y = x + i, cols[y]
            x, y = x[y > x], y[y > x]
            if not len(x):
                continue
            tables = folded(long) if tables is None else tables
            both = alike(run, long, tables, x, y, similarity)
            out.append(np.stack([run[x[both], 0], run[x[both], 1], run[y[both], 1], np.full(int(both.sum()), -1)], 1))
    return out


def walked(rows: DataFrame, f: Callable, similarity: float) -> DataFrame:
    """(v, a, b, place) by ``f`` of the runs of each v. Rows are dealt and sorted by v; a run that goes over the end of a batch is held. A column ``parity`` goes to ``f`` by itself."""
    cols = [c for c in rows.columns if c != "parity"]
    wide = ["parity"] if "parity" in rows.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list) -> pa.RecordBatch:
            now, marks = np.concatenate([x for x, _ in parts]), np.concatenate([m for _, m in parts])
            once = np.r_[True, (now[1:, :2] != now[:-1, :2]).any(1)]  # a node may come from several tasks
            now, marks = now[once], marks[once] if wide else marks
            start = np.r_[0, np.flatnonzero(now[1:, 0] != now[:-1, 0]) + 1]
            got = np.concatenate(f(now, start, np.r_[start[1:], len(now)], similarity, marks))
            pair = got[:, 1] != got[:, 2]
            pairs = np.sort(got[pair, 1:3], axis=1)
            pairs = np.unique(pairs, axis=0)
            got = np.concatenate([got[~pair], np.c_[np.zeros(len(pairs), np.int64), pairs, np.full(len(pairs), -1)]])
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, c])) for c in range(4)], names=["v", "a", "b", "place"])

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([np.asarray(x, np.int64) for x in batch.columns[: len(cols)]], 1)
            marks = np.array([*batch.column(len(cols)).to_pylist(), None], object)[:-1] if wide else np.zeros(0, object)
            if held and held[-1][0][-1, 0] != now[0, 0]:
                yield told(held)
                held = []
            other = np.flatnonzero(now[:, 0] != now[-1, 0])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield told([*held, (now[:cut], marks[:cut])])
                held = []
            held.append((now[cut:], marks[cut:]))
        if held:
            yield told(held)

    return rows.select(*cols, *wide).repartition("v").sortWithinPartitions("v", "node").mapInArrow(run, "v bigint, a bigint, b bigint, place bigint")


def marked_texts(needed: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """(h, text) of the texts whose hash ``needed`` (h) holds, and of a few more, once each. Only they are shuffled: a bitmap of bounded size goes to the tasks."""
    bits = needed.select(F.pmod("h", F.lit(MARKS)).alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(p % 64)))").alias("m")).toArrow()
    marks = np.zeros(MARKS // 64, np.uint64)
    marks[np.asarray(bits["w"], np.int64)] = np.asarray(bits["m"], np.int64).view(np.uint64)
    shared = df.sparkSession.sparkContext.broadcast(marks)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            h = np.asarray(b.column(0), np.int64)
            p = h.view(np.uint64) % np.uint64(MARKS)
            at = []
            for i in np.flatnonzero(shared.value[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).tolist():
                if h[i] not in seen:
                    seen.add(h[i])
                    at.append(i)
            yield b.take(pa.array(at, pa.int64()))

    texts = df.select(text_hash(F.col(text_col)).alias("h"), F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.mapInArrow(f, "h bigint, text string").dropDuplicates(["h"])


def least_shared(size: str, other: str, similarity: float) -> Column:
    """How many members sets of two sizes share at least at the similarity."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (F.col(size) + F.col(other)) - EPS)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def verified(pairs: DataFrame, reps: DataFrame, df: DataFrame, text_col: str, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets reach the similarity. reps: (node, h) of a text of each node."""
    rep = lambda c: reps.select(F.col("node").alias(c), F.col("h").alias(f"h{c}"))
    small_batches(df.sparkSession)
    named = materialise(pairs.join(rep("a"), "a").join(rep("b"), "b"))
    texts = marked_texts(named.select(F.explode(F.array("ha", "hb")).alias("h")), df, text_col)
    side = lambda c: texts.select(F.col("h").alias(f"h{c}"), F.col("text").alias(f"t{c}"))

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, np.zeros(0, np.uint64)
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, h in enumerate(b.column(4).to_pylist()):
                if h != last:
                    last, known = h, np.unique(shingle_hashes(b.column(3)[i].as_py(), words))
                own = np.unique(shingle_hashes(b.column(2)[i].as_py(), words))
                both = len(np.intersect1d(own, known, assume_unique=True))
                ok[i] = both >= similarity * (len(own) + len(known) - both) - EPS
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], names=["a", "b"])

    return named.join(side("a"), "ha").join(side("b"), "hb").select("a", "b", "ta", "tb", "hb").mapInArrow(f, "a bigint, b bigint")
