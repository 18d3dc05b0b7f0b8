"""Runs against a plain search of all periods, the transform against plain convolution, the query against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from snapquarry.llm import periodic as R


def plain_runs(x):
    """Every maximal stretch with smallest period q and at least max(12, 2 q) words, by looking at all periods."""
    found, n = [], len(x)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if x[i] != x[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and x[j] == x[j + p]:
                j += 1
            if j + p - i >= max(12, 2 * p) and not any(s <= i and j + p <= s + m and p % q == 0 and q < p for s, m, q in found):
                found.append((i, j + p - i, p))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def of(x):
    return R.runs(np.asarray(x, np.int64), np.array([0, len(x)])).get(0, [])


def odd_sequences():
    rng = random.Random(5)
    yield [0] * 300
    yield [0] * 40 + [1] + [0] * 40 + [1] + [0] * 40 + [2]
    yield ([0] * 70 + [1]) * 5
    yield [0, 1] * 6
    yield [0, 1] * 5 + [0]
    yield list(range(6)) * 2
    yield list(range(7)) * 2 + [0]
    yield [*range(100), *range(100), *range(50)]
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    yield b  # a Fibonacci word: as many runs as can be
    for _ in range(60):
        n, v = rng.randint(1, 160), rng.randint(1, 4)
        x = [rng.randrange(v) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            s, p = rng.randrange(n), rng.randint(1, 30)
            for i in range(s + p, min(n, s + p + rng.randint(5, 90))):
                x[i] = x[i - p]
        yield x


@pytest.mark.parametrize("k", range(4))
def test_runs_equal_the_plain_search(k):
    for x in list(odd_sequences())[k::4]:
        assert of(x) == plain_runs(x), x


def test_documents_do_not_touch():
    """Sequences one after another give what each gives alone, at any number of distances."""
    many = list(odd_sequences())
    offsets = np.r_[0, np.cumsum([len(x) for x in many])]
    got = R.runs(np.concatenate([np.asarray(x, np.int64) for x in many]), offsets)
    assert {k: v for k, v in got.items()} == {k: plain_runs(x) for k, x in enumerate(many) if plain_runs(x)}


def test_many_distances_by_ranks(monkeypatch):
    monkeypatch.setattr(R, "DISTANCES", 0)
    for x in list(odd_sequences())[::3]:
        assert of(x) == plain_runs(x), x


def test_small_blocks_find_large_periods(monkeypatch):
    """Blocks shorter than half the period (texts beyond the largest block) and few cells at a time."""
    monkeypatch.setattr(R, "LARGEST", 4)
    for x in list(odd_sequences())[::3]:
        assert of(x) == plain_runs(x), x


@pytest.mark.parametrize("n", [2, 8, 64, 1024])
def test_transform(n):
    rng = np.random.default_rng(n)
    t = R.Transform(n)
    x, y = rng.integers(0, R.P, (3, n)), rng.integers(0, R.P, (3, n))
    assert (t.inverse(t.forward(x)) == x).all()
    got = t.inverse(R.reduced(t.forward(x) * t.forward(y)))
    for a, b, c in zip(x[:, : min(n, 64)].tolist(), y.tolist(), got.tolist(), strict=True):
        a = a + [0] * (n - len(a)) if n > 64 else a
        want = [sum(a[i] * b[(k - i) % n] for i in range(n)) % R.P for k in range(min(n, 16))]
        if n <= 64:
            assert c[: len(want)] == want


def test_long_text_in_linear_time():
    x = np.r_[np.zeros(100_000, np.int64), 1, np.zeros(100_000, np.int64), 1, np.zeros(50_000, np.int64)]
    assert of(x) == [(0, 100_000, 1), (0, 250_002, 100_001), (100_001, 100_000, 1), (200_002, 50_000, 1)]


def plain_row(doc_id, text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best[1] * 1000 // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_plain_python(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 9000").collect()]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs) > 5
    got = R.periodic_runs(R.with_planted_runs(spark.createDataFrame(docs, "doc_id bigint, text string")), ["doc_id"])
    assert {tuple(r) for r in got.collect()} == {plain_row(*d) for d in docs}
    assert sum(r.n_runs > 0 for r in got.collect()) > 5


def test_odd_rows(spark):
    rows = [(None, "a b " * 9), (30, None), (31, ""), (32, " \t\n\x0b\x0c\r "), (33, "x y " * 12), (33, "x y " * 12), (34, "é\x1cé é\x1cé " * 8)]
    rows += [(k, "w " * 20) for k in range(40, 80)]  # some of them h % 10 = 0
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id bigint, text string, n_runs string")
    got = R.periodic_runs(R.with_planted_runs(df), ["doc_id"]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_row(d, t)) for d, t in rows)
    assert R.periodic_runs(R.with_planted_runs(df.limit(0)), ["doc_id"]).count() == 0


def test_empty_batch():
    assert R.text_runs(pa.array(["", ""])) and R.runs(np.zeros(0, np.int64), np.array([0])) == {}
