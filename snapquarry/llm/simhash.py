"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits by majority over the XXH64 hashes of all word shingles. Equal
fingerprints are one node. To find all pairs of nodes at ``RADIUS`` bits or fewer:

1. Correlated bits are grouped: from the co-occurrence counts of all 64 bits over all
   nodes, bits are dealt greedily so that strongly dependent ones meet in one group.
   A group of dependent bits has few distinct values and is a poor key, so the other
   groups become better ones.
2. Thresholds: for m groups, any pair within r bits agrees within t_i bits in some group
   i as long as the t_i (each -1 or more) add up to r - m + 1. Dynamic programming picks the t_i
   with the least estimated number of candidates, from the counts of each group's values
   over all nodes; the number of groups is chosen the same way.
3. Probe: every node gives its own value of each group with t_i >= 0 and all values at t_i
   bits or fewer. Nodes that meet at a value are compared by all 64 bits.

Values that more than ``RUN`` rows share are split: two fingerprints that share a value
and are ``RADIUS`` apart also agree in one of ``RADIUS`` + 1 parts of the other bits, and
that part joins the key. The comparison of one key's nodes takes the nodes in blocks and
gives a spanning forest of their links, never all pairs, so a group of thousands of near
copies gives thousands of rows. No link is lost: components of the forests are those of
all links.

Defined results: null and empty texts and texts without words have fingerprint zero and
link like any other; texts with fewer than three words hash their whole word sequence;
repeated rows share a component; an empty table gives an empty result. Extra columns are
left out unless kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import setjoin
from snapquarry.llm.common import map_text, materialise, packed, table, with_value
from snapquarry.llm.components import components

BITS, RADIUS = 64, 3
BLOCK = 4 << 20  # comparisons made at once
RUN = 4096  # rows of a key that are compared in one task; longer runs are split


def fingerprints(words: int):
    """Arrow function: text -> 64 bits of fingerprint, as a signed integer."""

    def f(texts: pa.Array) -> list:
        return [np.array([setjoin.majority(setjoin.shingle_hashes(t.as_py(), words)) for t in texts], np.uint64).view(np.int64)]

    return f


def with_fingerprint(df: DataFrame, keep: Sequence[str], text_col: str = "text", words: int = 3) -> DataFrame:
    """``keep`` and the fingerprint ``fp``."""
    return map_text(df, lambda: fingerprints(words), keep, "fp bigint", text_col)


def bit_counts(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """64 x 64 numbers of nodes that have both bits, and the number of nodes. A task sends 65 rows."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            bits = setjoin.hash_bits(np.asarray(b.column(0), np.int64).view(np.uint64)).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(BITS + 1), pa.int32()), pa.array([*total.tolist(), [n]], pa.list_(pa.int64()))], names=["i", "c"])

    rows = nodes.select("fp").mapInArrow(f, "i int, c array<bigint>").select("i", F.posexplode("c").alias("j", "c")).groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    out, n = np.zeros((BITS, BITS), np.int64), 0
    for r in rows:
        if r["i"] == BITS:
            n = r["c"]
        else:
            out[r["i"], r["j"]] = r["c"]
    return out, n


def grouped(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of 64/m bits: each starts with a free bit and takes, one by one, the free bit most dependent on its own."""
    p = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    dep = np.abs(both / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    free, out = set(range(BITS)), []
    for k in range(m):
        size = len(free) // (m - k)
        group = [max(free, key=lambda b: (dep[b, sorted(free)].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (dep[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        out.append(sorted(group))
    return out


def value(fp: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def masks(size: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(size), k)], np.uint64)


def keyed(nodes: DataFrame, groups: list[list[int]], thresholds: Sequence[int]) -> DataFrame:
    """(g, v, fp): the values under which each node is looked up; own values and, for thresholds over 0, near ones."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0), np.int64).view(np.uint64)
            for g, (bits, t) in enumerate(zip(groups, thresholds, strict=True)):
                if t < 0:
                    continue
                near, own = masks(len(bits), t), value(fp, bits)
                step = max(1, 200_000 // len(near))
                for i in range(0, len(fp), step):
                    v = (own[i : i + step, None] ^ near).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), g, np.int32)), pa.array(v.view(np.int64)), pa.array(np.repeat(fp[i : i + step], len(near)).view(np.int64))], names=["g", "v", "fp"])

    return nodes.select("fp").mapInArrow(f, "g int, v bigint, fp bigint")


def allocate(cost: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one for each group, that add up to ``total`` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for have, (x, ts) in best.items():
            for t, y in c.items():
                if have + t not in new or x + y < new[have + t][0]:
                    new[have + t] = (x + y, [*ts, t])
        best = new
    return best[total]


def plan(nodes: DataFrame, radius: int = RADIUS) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and thresholds with the fewest estimated candidates and probes."""
    both, n = bit_counts(nodes)
    if n < 2:
        return [list(range(BITS))], [radius]
    options = {m: grouped(both, n, m) for m in range(2, radius + 2)}
    every = [(m, bits) for m, gs in options.items() for bits in gs]
    hits = keyed(nodes, [bits for _, bits in every], [0] * len(every)).groupBy("g", "v").count().groupBy("g").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1)).alias("pairs")).collect()
    pairs = {r["g"]: r["pairs"] for r in hits}
    best: tuple[float, list[list[int]], list[int]] | None = None
    for m, groups in options.items():
        cost = []
        for bits in groups:
            same = pairs.get(every.index((m, bits)), 0.0)
            chance = same + float(n) * n / 2.0 ** len(bits)
            # Candidates and rows to shuffle; a probe row costs about as much as ten comparisons.
            cost.append({-1: 0.0} | {t: chance * len(masks(len(bits), t)) + 10.0 * n * (len(masks(len(bits), t)) + (t > 0)) for t in range(min(2, radius) + 1)})
        got, ts = allocate(cost, radius - m + 1)
        if best is None or got < best[0]:
            best = (got, groups, ts)
    return best[1], best[2]


def forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that span the components of the links among sorted, distinct fingerprints.

    Search from each unvisited node, in blocks of bounded size: what lies within ``radius``
    of the front joins it and leaves the rest, so that each node costs one pass over those
    not yet reached. All that a search reaches hangs on its first, least node, so that runs
    with common nodes tend to give the same rows.
    """
    a, b, rest = [fp[:0]], [fp[:0]], fp
    while len(rest) > 1:
        seed = front = rest[:1]
        rest = rest[1:]
        while len(front) and len(rest):
            got = np.zeros(len(rest), bool)
            block = max(1, BLOCK // len(rest))
            for i in range(0, len(front), block):
                free = np.flatnonzero(~got)
                got[free] = (np.bitwise_count(front[i : i + block, None] ^ rest[free]) <= radius).any(0)
            a.append(np.repeat(seed, got.sum()))
            b.append(rest[got])
            front, rest = rest[got], rest[~got]
    return np.concatenate(a), np.concatenate(b)


def linked(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key: pairs for small runs all together, a forest for each larger run."""
    start = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1]
    n = np.diff(np.r_[start, len(key)])
    a, b = [fp[:0]], [fp[:0]]
    run, last = np.repeat(n, n), np.repeat(start + n, n)
    for d in range(1, 4):
        at = np.flatnonzero((run <= 4) & (np.arange(len(key)) + d < last))
        near = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        a.append(fp[near])
        b.append(fp[near + d])
    for s, m in zip(start[n > 4].tolist(), n[n > 4].tolist(), strict=True):
        x, y = forest(np.unique(fp[s : s + m]), radius)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def compared(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) among rows (g, v, fp) that share (g, v).

    Rows are dealt by key and sorted, and a task walks through its runs; a run that goes
    over the end of a batch is held, so what is in memory is a batch and one run.
    """

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list) -> pa.RecordBatch:
            a, b = linked(np.concatenate([k for k, _ in parts]), np.concatenate([x for _, x in parts]), radius)
            both = np.stack([a, b], 1).view(np.int64)
            both = np.unique(both[a != b], axis=0)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, c])) for c in range(2)], names=["a", "b"])

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(k), np.int64) for k in range(2)], 1)
            fp = np.asarray(batch.column(2), np.int64).view(np.uint64)
            if held and (held[-1][0][-1] != key[0]).any():
                yield told(held)
                held = []
            other = np.flatnonzero((key != key[-1]).any(1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield told([*held, (key[:cut], fp[:cut])])
                held = []
            held.append((key[cut:], fp[cut:]))
        if held:
            yield told(held)

    return rows.repartition("g", "v").sortWithinPartitions("g", "v").mapInArrow(f, "a bigint, b bigint")


def refined(rows: DataFrame, used: dict[int, list[int]], radius: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """Rows (g, v, fp) under longer keys, and the bits behind each new g.

    Two fingerprints that share a key and lie within ``radius`` also agree in one of
    ``radius`` + 1 parts of the bits that the key doesn't show; the part's value joins the key.
    """
    plan_, new = {}, {}
    for g, bits in sorted(used.items()):
        rest = [b for b in range(BITS) if b not in bits]
        parts = [rest[k :: radius + 1] for k in range(radius + 1)]
        plan_[g] = [(len(new) + k, part) for k, part in enumerate(parts)]
        new |= {len(new) + k: sorted([*bits, *part]) for k, part in enumerate(parts)}

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, v, fp = np.asarray(b.column(0), np.int64), np.asarray(b.column(1), np.int64).view(np.uint64), np.asarray(b.column(2), np.int64)
            for code in np.unique(g).tolist():
                at = g == code
                for child, part in plan_[code]:
                    longer = v[at] << np.uint64(len(part)) | value(fp[at].view(np.uint64), part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(at.sum()), child, np.int32)), pa.array(longer.view(np.int64)), pa.array(fp[at])], names=["g", "v", "fp"])

    return rows.mapInArrow(f, "g int, v bigint, fp bigint"), new


def links(nodes: DataFrame, radius: int = RADIUS, longest: int = RUN) -> DataFrame:
    """(a, b): links between nodes (``fp``, distinct) that hold each component together. Keys of over ``longest`` rows are split by further bits, as often as bits are left."""
    groups, thresholds = plan(nodes, radius)
    rows, used, out = keyed(nodes, groups, thresholds), dict(enumerate(groups)), []
    while min(BITS - len(b) for b in used.values()) > radius:
        large = materialise(rows.groupBy("g", "v").count().filter(F.col("count") > longest).select("g", "v"))
        if not large.limit(1).count():
            break
        out.append(compared(rows.join(large, ["g", "v"], "left_anti"), radius))
        rows, used = refined(rows.join(large, ["g", "v"], "left_semi").select("g", "v", "fp"), used, radius)
    return reduce(DataFrame.union, [*out, compared(rows, radius)]).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component_id): the smallest id of each row's component; a null id counts only where there is no other."""
    marked = materialise(with_fingerprint(df, [id_col], text_col, words))
    nodes = materialise(marked.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("copies")))
    found = materialise(classes(nodes.drop("copies"), links(nodes, radius), "fp").join(nodes.select("fp", "copies"), "fp"))
    return with_value(marked, found, "fp", "copies").select(id_col, "fp", "component_id")


def classes(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, component_id): the least ``least`` of all nodes reachable over ``edges`` (a, b)."""
    named = materialise(nodes.join(components(edges).withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key)))
    least = materialise(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    return with_value(named.drop("least"), least, "root", "n").drop("root")


def similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id): components of all links between texts whose sets of shingles have a Jaccard similarity of ``similarity`` or more.

    SimHash links (fingerprints of the sets within ``RADIUS`` bits) come first and are
    verified by the whole sets; they join most near copies. At a similarity well below 1
    fingerprints lie too far apart for any search of bits that grows less than with the
    square of the nodes, so the exact join of the sets (``setjoin``) looks for what links
    the components found so far. No pair is missed at any size, and none below the
    similarity is a link.
    """
    marked, found = _classes(df, id_col, text_col, words, similarity)
    return with_value(marked, found, "node", "copies").select(id_col, F.col("component_id.id").alias("component_id"))


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of df without near copies: of each class of ``similar`` the row with the smallest id stays (a null id only if there is no other, ties by text hash)."""
    marked, found = _classes(df, id_col, text_col, words, similarity)
    stay = found.select("component_id.id", "component_id.h").distinct()
    row = F.col("row")
    out = packed(df, text_col).join(stay, row[id_col].eqNullSafe(F.col("id")) & (setjoin.text_hash(F.col("text")) == F.col("h")), "left_semi")
    if marked.groupBy(id_col, "h").count().filter("count > 1").limit(1).count():
        out = out.select("row", row[id_col].alias("id"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["id", "text"])
    return out.select("row.*")


def _classes(df: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(id, h, node) of every row, and (node, component_id, copies)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), setjoin.text_hash(F.col(text_col)).alias("h"))
    signed = materialise(setjoin.signatures(rows, ["id", "h"], "text", words, similarity))
    least = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "h")).alias("least")
    nodes = materialise(signed.groupBy("node").agg(least, F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("size", "fp", "parity", *setjoin.BITMAP)]))
    reps = nodes.select("node", F.col("least.h").alias("h"))

    def real(pairs: DataFrame) -> DataFrame:
        return setjoin.verified(setjoin.plausible(pairs, nodes, similarity), reps, rows, "text", words, similarity)

    hubs = materialise(nodes.groupBy("fp").agg(F.min("node").alias("hub")))
    hub = lambda c, name: hubs.select(F.col("fp").alias(c), F.col("hub").alias(name))
    same = nodes.join(hubs, "fp").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    near = links(hubs.select("fp")).toDF("x", "y").join(hub("x", "b"), "x").join(hub("y", "a"), "y").select("a", "b")
    edges = real(same.union(near))

    met = materialise(setjoin.walked(setjoin.keyed(signed), setjoin.met, similarity))
    labels = labelled(nodes, edges)
    pairs = across(met.filter("a <> b").select("a", "b").distinct(), labels)
    edges = materialise(edges_of(labels).union(real(pairs)))
    labels = labelled(nodes, edges)
    # Where many nodes meet, what is left are pairs of different components.
    # A node whose place is too far back even for a partner of the least size that fits and is there stays out.
    large = met.filter("a = b").select("v", F.col("a").alias("node"), "place").join(labels, "node").join(nodes.select("node", "size"), "node")
    mixed = large.groupBy("v").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("shortest")).filter("low <> high").select("v", "shortest")
    partner = F.greatest("shortest", F.ceil(F.lit(similarity) * F.col("size") - setjoin.EPS))
    open_ = large.join(mixed, "v").withColumn("partner", partner).filter(F.col("size") - F.col("place") >= setjoin.least_shared("size", "partner", similarity))
    own = nodes.select("node", *setjoin.BITMAP, "parity")
    left = setjoin.walked(open_.join(own, "node").select("v", "node", "size", *setjoin.BITMAP, "label", "place", "parity"), setjoin.apart, similarity)
    edges = edges_of(labels).union(real(left.select("a", "b").distinct()))
    found = classes(nodes.select("node", "least"), edges, "node")
    return signed.select(F.col("id").alias(id_col), "h", "node"), found.join(nodes.select("node", "copies"), "node")


def labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component."""
    roots = components(edges).withColumnRenamed("root", "label")
    return materialise(nodes.select("node").join(roots, "node", "left").withColumn("label", F.coalesce("label", "node")))


def edges_of(labels: DataFrame) -> DataFrame:
    """(a, b): each node and its label."""
    return labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose labels differ."""
    for c in "ab":
        pairs = pairs.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c)
    return pairs.filter("la <> lb").select("a", "b")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
