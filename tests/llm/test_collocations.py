"""Collocations against plain Python and against the query's SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from snapquarry.llm import collocations as K


def plain(rows, least, share, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = {}
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, p), a in cands.items():
        if any(len(q) > len(p) and x == lang and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= share * a for (x, q), b in cands.items()):
            continue
        s, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((s, a, " ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    rows = set()
    for lang, x in out.items():
        x.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        rows |= {(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(x[:top])}
    return rows


ROWS = [("New York is big. new york, new  york\tis old; the city of New York is big", "en"), (None, "en"), ("", None), ("a b a b a b\x0ba b! a\x1cb", None), ("é É é É. É é", "fr"), ("a b a b a b a b", "en"), (" . , ", "x")] * 6 + [("long " * 4000, "en")]


@pytest.mark.parametrize("partitions", [1, 3, 20])
def test_equals_plain_python(spark, monkeypatch, partitions):
    """At any number of partitions, thus of shards; extra columns with names of the result don't matter."""
    monkeypatch.setattr(K, "CHUNK", 200)
    df = spark.createDataFrame([(t, x, 1) for t, x in ROWS], "text string, lang string, a int").repartition(partitions)
    for least, share, top in ((10, 50, 2000), (3, 101, 5)):
        assert {tuple(r) for r in K.collocations(df, least, share, top).collect()} == plain(ROWS, least, share, top)


def test_empty_table(spark):
    assert K.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = K.op11_collocations(spark, sf_dir)
    assert {tuple(r) for r in got.collect()} == set(c.execute(f"SELECT {', '.join(got.columns)} FROM ({K.ORACLE})").fetchall())


def test_many_words_in_a_chunk():
    """Over 2^21 different words in one chunk: phrases of three words are numbered in two steps."""
    words = [f"{k:x}" for k in range(1 << 21)]
    total, names, grams = K.chunk_grams(pa.array([" ".join(words) + " 0 1 2 0 1 2"], pa.string()))
    columns, n = grams[2]
    k = int(np.flatnonzero(n == 3)[0]) if (n == 3).any() else int(np.argmax(n))
    assert total == len(words) + 6 and len(n) == total - 2 - 2 and [names[int(c[k])].as_py() for c in columns] == ["0", "1", "2"] and n[k] == 3


def test_support_of_a_shard():
    """A hash is marked if one shard has it often enough, not if all shards have it together."""
    entry = lambda *h: np.array(h, np.uint64).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    rows = [(0, 0, entry(1 << 37, 5 << 37), bytes([1, 2])), (0, 1, entry(1 << 37), bytes([1])), (0, 2, entry(7 << 37), bytes([1])), (0, 2, entry(7 << 37), bytes([1]))]
    group = pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([r[1] for r in rows], pa.int32()), "entries": pa.array([r[2] for r in rows], pa.binary()), "counts": pa.array([r[3] for r in rows], pa.binary())})
    assert K.frequent_somewhere(2, 3, group)["part"].to_pylist() == [bytes([1 << 5 | 1 << 7])]
