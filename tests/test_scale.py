"""Jobs that split one large group over tasks, with blocks and bounds made small."""

import hashlib
import random
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from snapquarry.operators import discover as D
from snapquarry.operators import edges as E
from snapquarry.operators import ranks as R


def test_ranked(spark):
    """Places of groups of any size, null groups too, whatever the partitions."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), k, rng.random()) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, x double").repartition(7)
    got = R.ranked(df, ["g"], ["x"]).collect()
    want = {}
    for g in {r[0] for r in rows}:
        for place, (x, k) in enumerate(sorted((x, k) for h, k, x in rows if h == g)):
            want[k] = (g, x, place)
    assert {r.k: (r.g, r.x, r.place) for r in got} == want
    assert R.ranked(df.limit(0), ["g"], ["x"]).count() == 0


def test_batches_of_one_key(spark):
    df = spark.range(2005).select(F.lit("k").alias("g"), (F.col("id") * 7 % 2005).alias("v"))
    got = {r.batch: (r.ids, r.n) for r in D.fixed_batches(df, ["g"], "v", 10).collect()}
    assert len(got) == 201 and got["000000"][0] == "0,1,2,3,4,5,6,7,8,9" and got["000200"] == ("2000,2001,2002,2003,2004", 5)


def greedy(counts, edges_bound, targets_bound, url_bound, first):
    out, now, size, length = [], [], 0, first
    for target, n in sorted(counts.items()):
        own = len(quote_plus(target, safe="~"))
        if n > edges_bound or first + own > url_bound:
            continue
        if now and (size + n > edges_bound or len(now) == targets_bound or length + 3 + own > url_bound):
            out.append((now, size))
            now, size, length = [], 0, first
        length += own + 3 * bool(now)
        now, size = [*now, target], size + n
    return [*out, (now, size)] if now else out


@pytest.mark.parametrize("block,fan,bounds", [(8, 2, (9, 8, 200)), (8, 3, (500, 8, 110)), (16, 64, (20, 5, 6144)), (1024, 64, (500, 100, 6144))])
def test_batches_equal_the_plain_walk(spark, monkeypatch, block, fan, bounds):
    """Greedy batches over many blocks and levels; one organism holds nearly all targets, some have one, and one ends in a short block."""
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(R, "FAN", fan)
    rng = random.Random(block + fan)
    counts = {o: {f"T{k:04d}" + "é:"[: rng.randint(0, 2)] * rng.randint(0, 4): rng.randint(1, 6) for k in range(n)} for o, n in (("9606", 300), ("1", 1), ("22", 17), ("7", 8), ("3", 9))}
    rows = [(o, str(i), t) for o, c in counts.items() for t, n in c.items() for i in range(n)] + [("9606", str(i), "over") for i in range(bounds[0] + 1)] + [("22", "0", None)]
    got = E.plan_edge_batches(spark.createDataFrame(rows, "organism string, source string, target string"), edges_bound=bounds[0], targets_bound=bounds[1], url_bound=bounds[2]).collect()
    for o, c in counts.items():
        first = len(f"https://example.org/interactions?organisms={o}&targets=")
        mine = sorted((r.batch, list(r.targets), r.expected_edges) for r in got if r.organism == o and not r.error)
        assert mine == [(k, x, n) for k, (x, n) in enumerate(greedy(c, *bounds, first))], o
    assert {(r.organism, r.error) for r in got if r.error} == {("9606", "target over a bound"), ("22", "empty target")}
    assert all(len(r.url) <= bounds[2] for r in got if not r.error)


def test_digest_over_many_batches(spark):
    """A group's keys go through the digest batch by batch; groups may share a batch, and a null group is one."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(2)
        rows = [(rng.choice(["a", "b", "c", None]), str(rng.randint(0, 50)), rng.choice(["x", None])) for _ in range(400)]
        df = spark.createDataFrame(rows, "organism string, source string, target string")
        got = {r.organism: (r.digest, r.edges) for r in E.inventory_digest(df, ["source", "target"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for g in ("a", "b", "c", None):
        keys = sorted("\t".join(x for x in r[1:] if x is not None) for r in rows if r[0] == g)
        assert got[g] == (hashlib.sha256("\n".join(keys).encode()).hexdigest(), len(keys))
    assert E.inventory_digest(df.limit(0), ["source"]).count() == 0
    number = E.inventory_digest(spark.range(5).select((F.col("id") % 2).alias("organism"), F.col("id").cast("string").alias("source")), ["source"])
    assert {r.organism: r.edges for r in number.collect()} == {0: 3, 1: 2}
