"""Decontamination against brute force: items from 3 bytes to thousands, edits around the budget, common stems, several blocks."""

import random
import time

import pytest
from pyspark.sql import functions as F

from snapquarry.llm import decontaminate as D


def least_edits(p, t):
    """Edits of the best part of t."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def changed(rng, b, edits):
    b = bytearray(b)
    for _ in range(edits):
        k = rng.randrange(len(b))
        kind = rng.randrange(3)
        if kind == 0:
            b[k] = 35
        elif kind == 1:
            del b[k]
        else:
            b.insert(k, 36)
    return bytes(b)


def found(items, texts, share=D.SHARE):
    index, out = D.Index.of(items, share), set()
    for k, t in enumerate(texts):
        data, off = D.normalised(D.pa.array([t.decode()]))
        out |= {(k, h[1]) for h in index.hits(data, off)}
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)).encode()


def test_every_length_against_brute_force():
    rng = random.Random(1)
    items = [(k, prose(rng, 400)[:m]) for k, m in enumerate([20, 21, 25, 39, 40, 41, 59, 60, 63, 79, 80, 81, 99, 100, 140, 300])]
    items = [(k, b.replace(b" ", b"x", 0).strip().ljust(20, b"z")) for k, b in items]
    texts = []
    for _, b in items:
        for edits in range(D.budget_of(len(b), D.SHARE) + 3):
            texts.append(prose(rng, 8) + b" " + changed(rng, b, edits) + b" " + prose(rng, 8))
    want = {(k, i) for k, t in enumerate(texts) for i, b in items if least_edits(b, t) <= D.budget_of(len(b), D.SHARE)}
    assert found(items, texts) == want and len(want) > len(items)


def test_short_items_stand_at_word_borders():
    items = [(1, b"yes"), (2, b"alpha"), (3, b"what is it?"), (4, b"nineteen bytes here")]
    texts = [b"eyes yesterday", b"say yes.", b"alphabet alpha_1", b"an alpha!", b"so what is it? it", b"somewhat is it?", b"nineteen bytes here", b"nineteen bytes herein", b"yes"]
    assert found(items, texts) == {(1, 1), (3, 2), (4, 3), (6, 4), (8, 1)}


def test_long_items_count_as_wholes():
    rng = random.Random(2)
    item = prose(rng, 1000)
    k = D.budget_of(len(item), D.SHARE)
    texts = [prose(rng, 50) + b" " + t + b" " + prose(rng, 50) for t in (item, changed(rng, item, k * 9 // 10), item[:600], item[: len(item) * 8 // 10], changed(rng, item, 3 * k))]
    assert len(item) > 5000 and found([(7, item)], texts) == {(0, 7), (1, 7)}


def test_common_stems():
    """500 items with one stem, in a text that repeats the stem: no item is found but the one that is there, in bounded time."""
    rng = random.Random(3)
    stem = b"choose the one correct answer to this question: "
    items = [(k, stem + prose(rng, 12)) for k in range(500)]
    text = b" ".join([stem + prose(rng, 3) for _ in range(20)] + [items[77][1]])
    began = time.process_time()
    assert found(items, [text]) == {(0, 77)}
    assert time.process_time() - began < 10


def test_counting_in_parts(monkeypatch):
    rng = random.Random(4)
    items = [(k, prose(rng, 20)) for k in range(12)] + [(50, b"ab" * 60)]
    texts = [b" ".join(changed(rng, b, 2) for _, b in rng.sample(items, 3)) for _ in range(6)] + [b"ab" * 300]
    want = found(items, texts)
    monkeypatch.setattr(D, "MOST", 50)
    assert found(items, texts) == want and (6, 50) in want


@pytest.mark.parametrize("most", [1 << 20, 400])
def test_rows_and_blocks(spark, most):
    """One or several blocks: the same hits; odd rows, and kept columns of any name."""
    rng = random.Random(5)
    items = [(k, prose(rng, 15).decode()) for k in range(9)] + [(20, "yes"), (21, None), (22, "  "), (3, "again " + prose(rng, 15).decode())]
    texts = [(k, f"Before {items[k % 9][1].upper()}\n\n after" if k % 2 else "nothing here", "x", k) for k in range(12)] + [(90, None, "x", 1), (91, "", "y", 1), (92, "yes", None, 1), (92, "yes", None, 1)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, row string, number int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.contaminated(df, bench, ["doc_id", "row", "number"], most=most)
    assert got.columns == ["doc_id", "row", "number", "item_ids", "starts", "ends", "edits"]
    rows = sorted((r.doc_id, tuple(r.item_ids)) for r in got.collect())
    assert rows == sorted([(k, (k % 9,) if k % 2 else ()) for k in range(12)] + [(90, ()), (91, ()), (92, (20,)), (92, (20,))])
    assert D.contaminated(df, bench.filter(F.lit(False)), ["doc_id"]).filter(F.size("item_ids") > 0).count() == 0
    assert D.contaminated(df.limit(0), bench, ["doc_id"], most=most).count() == 0


def test_large_benchmark_gives_the_same_hits(spark):
    """The join of seeds against the index: same items, places and edits, around the budget, at the ends of texts, with repeated items and ids."""
    rng = random.Random(8)
    items = [(k, prose(rng, rng.choice([3, 4, 6, 10, 20, 60, 200])).decode()) for k in range(60)]
    items += [(60, "yes"), (61, "what is it?"), (62, "ab" * 80), (None, items[5][1]), (63, items[6][1].upper()), (7, items[8][1]), (9, items[9][1]), (64, "  ")]
    texts = []
    for k in range(120):
        parts = [prose(rng, rng.randint(0, 9))]
        for i, b in rng.sample(items, 3):
            parts.append(changed(rng, b.encode(), rng.randint(0, D.budget_of(len(b), D.SHARE) + 1)) if len(b) > 2 else b"")
            parts.append(rng.choice([b"", b" ", b" " + prose(rng, 3) + b"\n\n "]))
        texts.append((k, b"".join(parts).decode()))
    texts += [(120, "ab" * 400), (121, items[11][1] * 5), (122, None), (123, ""), (124, "yes")]
    df, bench = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want, got = ([tuple(r) for r in D.contaminated(df, bench, ["doc_id"], most=most).orderBy("doc_id").collect()] for most in (1 << 20, 100))
    assert got == want and sum(len(r[1]) for r in want) > 160


def test_every_seed_set_survives_the_budget():
    rng = random.Random(9)
    for m in (20, 21, 39, 40, 59, 60, 150, 300):
        b = prose(rng, 200)[:m]
        k, place, h = D.seeds_of(b, D.SHARE)
        q = D.gram_of(m, k)
        assert len(place) == k + 1 and (not k or (place[1:] - place[:-1] >= q).all()) and place[-1] + q <= m and len(h) == k + 1
