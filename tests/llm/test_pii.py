"""Personal data: base spans against the plain patterns, the field against enumeration, the query against both."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from snapquarry.llm import pii as I

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_spans(text):
    tests = [lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")), lambda s: 16 <= len(re.sub("[ -]", "", s)) <= 19 and plain_luhn(re.sub("[ -]", "", s)), lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15]
    return [(k, m.start(), m.end()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text) if tests[k](m.group())]


@pytest.mark.parametrize("seed", range(4))
def test_base_equals_plain_patterns(seed):
    rng = random.Random(seed)
    parts = ["a", "@", ".", "-", "b.c", "+", " ", "1", "22", "256", "255", "0", "(", ")", "4539578763621486", "%", "_", "é", "x@y.z", "+1 555", "\n", "٣", "00"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert I.base_spans(text) == plain_spans(text), text


def test_long_texts_in_linear_time():
    for text in ("a" * 400_000, "a@" * 200_000, "1." * 200_000, "1 " * 200_000, "+1(" * 150_000, "a.b@c-" * 70_000, "0" * 400_000, "0" * 9000 + ".1.1.1", "+1" + " " * 400_000, "@1 " * 100_000 + "a@b.cc 1.2.3.4"):
        began = time.time()
        I.text_spans(trained(), I.pa.array([text]))
        assert time.time() - began < 20, text[:10]


CARD, OTHER = "4539578763621486", "4556737586899855"
LEARNED = [f"x{k} call +1 (555) 555-{1000 + k} or me{k}@mail.example.com ab 12 from 10.0.{k}.7 card {CARD} in {2000 + k} pages" for k in range(60)] + [f"the {CARD} again {CARD} no {k} 4539578763621487" for k in range(20)]


def trained():
    if not hasattr(trained, "model"):
        found = [I.base_spans(t) for t in LEARNED]
        trained.model = I.fit(I.fields(LEARNED, np.arange(len(LEARNED)), found))
    return trained.model


def added(text):
    base, more = I.text_spans(trained(), I.pa.array([text]))
    return [(I.KINDS[k], text[a:b]) for k, a, b in more[0]]


def test_twins_are_found():
    """What the patterns lose because it stands beside other digits is found where the document has it elsewhere."""
    assert plain_luhn(CARD) and plain_luhn(OTHER)
    assert ("card", CARD) in added(f"pay {CARD} now. Later {OTHER} {CARD} came with other words")
    assert added(f"pay {CARD} now and nothing else, 12 pages of 2024") == []
    assert added(f"no base span here: {OTHER} {CARD}") == []


def test_added_spans_do_not_meet_base_spans():
    text = " ".join(LEARNED) + f" {OTHER} {CARD} and 555-1003"
    base, more = I.text_spans(trained(), I.pa.array([text]))
    assert more[0] and not any(a < y and x < b for _, a, b in more[0] for _, x, y in base[0])


def test_messages_equal_enumeration_on_trees():
    rng = np.random.default_rng(3)
    unary, a, b = rng.normal(size=(6, 3)), np.array([0, 1, 1, 3, 3]), np.array([1, 2, 3, 4, 5])
    psi = rng.normal(size=(5, 3, 3))
    total = np.zeros((6, 3))
    for y in itertools.product(range(3), repeat=6):
        w = np.exp(sum(unary[i, y[i]] for i in range(6)) + sum(psi[e, y[i], y[j]] for e, (i, j) in enumerate(zip(a, b, strict=True))))
        for i in range(6):
            total[i, y[i]] += w
    assert np.allclose(I.probabilities(unary, a, b, psi, 60), total / total.sum(axis=1, keepdims=True), atol=1e-6)
    assert np.allclose(I.probabilities(unary, a[:0], b[:0], psi[:0]), np.exp(unary) / np.exp(unary).sum(axis=1, keepdims=True))


def test_twins_agree_on_loops():
    """Two words of a group, one of them observed: the other follows; with no twin potential it doesn't."""
    text = f"1 {CARD} x {CARD}"
    f = I.fields([text], np.array([0]), [[]])
    f.label[1] = 3
    model = I.Model(np.zeros((I.SHAPES + I.CONTEXT, 5)), np.zeros((5, 5)), 3 * np.eye(5))
    p = I.posterior(f, model)
    assert p[2].argmax() == 3 and p[2, 3] > 0.7 and np.allclose(p[0], 0.2)
    model.twin[:] = 0
    assert np.allclose(I.posterior(f, model)[2], 0.2)


def test_words_that_resemble():
    same = lambda a, b: I.resembles(a) == I.resembles(b)
    assert same("555-7713", "0175557713") and same("Me@X.org,", "<me[at]x[dot]org>") and not same("555-7713", "555-7714")
    assert I.resembles("1234") is None and I.resembles("(at)") is not None


def test_query_equals_plain_patterns(spark, sf_dir):
    rows = I.op13_personal_data(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        told = [f"{I.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(",")) | {""} if base else r.spans == ""


def test_odd_rows(spark):
    """Nulls, empty and repeated rows, clashing names, and a table without anything to learn from."""
    df = spark.createDataFrame([(1, None, 5), (None, "a@b.cc", 6), (2, "", 7), (2, "", 7)], "doc_id bigint, text string, spans bigint")
    got = I.scan(df, I.learned(df), ["doc_id"])
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_email, r.spans, r.base_sha256 == empty) for r in got.collect()) == [(0, 1, "email:0:6", False), (1, 0, "", True), (2, 0, "", True), (2, 0, "", True)]
    assert I.scan(df.limit(0), I.learned(df.limit(0)), ["doc_id"]).count() == 0
