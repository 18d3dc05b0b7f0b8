"""The learned operators: derivatives against differences, parts against brute force, and what training must and must not see."""

import random
import unicodedata

import numpy as np
import pyarrow as pa

from snapquarry.llm import langid, quality, queries, toxicity
from snapquarry.llm.common import table


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_recurrent_gradients():
    rng = np.random.default_rng(1)
    p = langid.started(3, 4, rng, np.float64)
    n = np.array([7, 1, 5, 7])
    x = np.where(np.arange(7)[:, None] < n, rng.integers(97, 101, (7, 4)), 0).astype(np.intp)
    y = np.array([0, 2, 1, 1])
    _, grads = langid.gradients(p, x, n, y)
    checked = 0
    for name, g in grads.items():
        for at in [tuple(a) for a in np.argwhere(np.abs(g) > 1e-4)][::5]:
            old, eps = p[name][at], 1e-6
            p[name][at] = old + eps
            up, _ = langid.gradients(p, x, n, y)
            p[name][at] = old - eps
            down, _ = langid.gradients(p, x, n, y)
            p[name][at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-5, (name, at)
            checked += 1
    assert checked > 40 and set(grads) == set(p)


def test_every_position_is_labelled():
    """Sums over windows equal those of a plain reading of each window, position by position; a text within one window doesn't depend on the cut."""
    rng = random.Random(2)
    p = langid.started(3, 4, np.random.default_rng(3))
    model = langid.Model(["a", "b", "c"], p)
    texts = [words(rng, "abcé", 20), "", "x", "12 34!", words(rng, "abcdef", 150)]
    data, off = langid.spelled(pa.array(texts))
    total, count = model.sums(data, off)

    def plain(part):
        def layer(side, order):
            h, out = np.zeros(4), {}
            for t in order:
                a, u = p[side + "in"][:, part[t]].astype(float), p[side + "rec"].astype(float) @ h
                z, r = np.clip((a[:4] + u[:4]) / langid.GATE + 0.5, 0, 1), np.clip((a[4:8] + u[4:8]) / langid.GATE + 0.5, 0, 1)
                new = np.tanh(a[8:] + r * u[8:])
                h = z * h + (1 - z) * new
                out[t] = h
            return out

        f, b = layer("f", range(len(part))), layer("b", range(len(part) - 1, -1, -1))
        z = np.array([p["fout"] @ f[t] + p["bout"] @ b[t] + p["bias"] for t in range(len(part))])
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for k in range(len(texts)):
        own, want = data[off[k] : off[k + 1]], np.zeros(3)
        for first in range(0, len(own), langid.CORE):
            end = min(first + langid.CORE, len(own))
            lo, hi = max(0, first - langid.CONTEXT), min(end + langid.CONTEXT, len(own))
            probs = plain(own[lo:hi])[first - lo : end - lo]
            want += probs[own[first:end] != 32].sum(0)
        assert np.allclose(total[k], want, atol=1e-3) and count[k] == (own != 32).sum()


def test_language_needs_more_than_one_word():
    """Two languages of the same words in different order: only a network that reads across words can tell them."""
    rng = random.Random(4)
    text = lambda lang: " ".join(("ka lo" if lang == "x" else "lo ka") + " mi" for _ in range(rng.randint(10, 30)))
    langs = [rng.choice("xy") for _ in range(200)]
    model = langid.train(pa.array([text(k) for k in langs]), langs, steps=150)
    test = [rng.choice("xy") for _ in range(60)]
    got = langid.predictor(model)(pa.array([text(k) for k in test]))[0].to_pylist()
    assert np.mean([a == b for a, b in zip(got, test, strict=True)]) > 0.9


def test_subword_gradients():
    rng = np.random.default_rng(5)
    vectors, share = rng.normal(size=(6, 3)), rng.dirichlet(np.ones(6))
    top, bias = rng.normal(size=(3, 2)), rng.normal(size=2)
    loss, g_h, g_top, g_bias = quality.gradients(vectors, share, top, bias, 1)
    for array, grad in ((top, g_top), (bias, g_bias), (vectors, np.outer(share, g_h))):
        for at in np.ndindex(array.shape):
            array[at] += 1e-6
            up = quality.gradients(vectors, share, top, bias, 1)[0]
            array[at] -= 1e-6
            assert abs((up - loss) / 1e-6 - grad[at]) < 1e-4


def test_subwords_are_characters_within_words():
    texts = ["né à", "", "中文 字", "ab", "a\n\nbc"]
    data, off = quality.buffers(pa.array(texts))
    codes, places = quality.characters(data, off)
    assert [int(b - a) for a, b in zip(places[:-1], places[1:], strict=True)] == [len(t) for t in texts]
    for n in (3, 4):
        _, doc = quality.subwords(codes, places, n, 17)
        blank = lambda c: unicodedata.category(c) == "Zs" or c in "\n"
        want = [k for k, t in enumerate(texts) for i in range(len(t) - n + 1) if not any(blank(c) for c in t[i + 1 : i + n - 1])]
        assert doc.tolist() == want


def test_quality_training_learns():
    rng = random.Random(6)
    y = np.array([k % 2 for k in range(300)])
    texts = [words(rng, "abcde" if k else "abcdz", 30) for k in y]
    model = quality.train(pa.array(texts[:200]), y[:200], epochs=4)
    assert ((model.probabilities(pa.array(texts[200:]))[:, 1] >= 0.5) == y[200:]).mean() > 0.95


def test_earlier_categories_come_from_other_folds():
    """A row's own label never reaches its out-of-fold prediction, and a chain whose first category can't be predicted from the text doesn't lean on it."""
    rng = np.random.default_rng(7)
    x, y, fold = rng.normal(size=(60, 8)).astype(np.float32), (rng.random(60) < 0.5).astype(np.float32), np.arange(60) % 5
    before = toxicity.out_of_fold(x, y, fold)
    changed = np.where(fold == 2, 1 - y, y)
    assert np.allclose(toxicity.out_of_fold(x, changed, fold)[fold == 2], before[fold == 2])
    words_ = [f"w{k}" for k in range(300)]
    texts = pa.array([" ".join(rng.choice(words_, 12)) for _ in range(200)])
    noise = (rng.random(200) < 0.5).astype(np.int64)
    chain = toxicity.train(texts, np.stack([noise, noise], 1), ["first", "second"])
    doc, f = toxicity.presences(texts, chain.index, chain.features)
    fitted = np.zeros((200, chain.features), np.float32)
    fitted[doc, f] = 1
    inside = toxicity.logit(toxicity.sigmoid(fitted @ chain.weights[0][:-1] + chain.weights[0][-1]))
    leaning = toxicity.logistic(np.c_[fitted, inside].astype(np.float32), noise.astype(np.float32))[-2]
    assert leaning > 1 and chain.weights[1][chain.features] < 0.3


def test_held_out_toxicity(spark):
    """Recall and precision on rows never learned from; always saying clean would catch none."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = [(r.predicted, labels[r.doc_id]) for r in queries.op1_toxicity(spark, sf).filter("held_out").collect() if r.doc_id in labels]
    caught, toxic, said = sum(a and b for a, b in rows), sum(b for _, b in rows), sum(a for a, _ in rows)
    assert toxic > 100 and caught / toxic > 0.8 and caught / said > 0.93
