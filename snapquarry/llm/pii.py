"""Personal data: patterns, and a skip-chain conditional random field for what they miss.

Base spans are those of the four patterns. The words of a document that hold a digit, an @ or
a written-out "at" mark are the field's variables; each is an email, ip, card or phone, or
nothing. Words side by side share a chain potential, and words of one document that repeat or
resemble each other (the same digits at the end, the same address) share a hidden label and so
agree however far apart they are. Words inside base spans are observed; loopy message passing
gives the others' probabilities, in every document with such words. What it is sure of in a
document without a base span, which has nothing to agree with, is told apart. The weights are learned from the base spans of a bounded sample by
pseudo-likelihood, with the words' own features left out of every second example, so that
neighbours and twins count.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm.common import buffers, labelled_texts, map_text, table
from snapquarry.llm.grams import SPACE, words

#: The kinds in order, and their patterns. Digits, dots and the parts before them are taken whole, which no match depends on.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
EMAIL = re.compile(rf"[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
FIRST_EMAIL = re.compile(rf"(?<![{LOCAL}]){EMAIL.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NEAR_DIGITS = 7  # digits at the end by which numbers resemble each other
SAMPLE = 4000  # documents that the weights are learned from
SURE = 0.9  # least probability of an added span
ROUNDS = 30
CONTEXT = 64
AT = re.compile(r"[\[(]\s*at\s*[\])]", re.I)
DOT = re.compile(r"[\[(]\s*dot\s*[\])]", re.I)
CORE = re.compile(r"[A-Za-z0-9+].*[A-Za-z0-9]|[A-Za-z0-9]", re.S)
NODE = np.zeros(256, bool)
NODE[list(b"0123456789@[(")] = True
BOUNDS = (1, 2, 3, 4, 5, 7, 8, 10, 12, 16, 20)  # of the number of digits
SHAPES = len(BOUNDS) + 1 + 9


def luhn(digits: str) -> bool:
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(twice[int(c)] if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, one after another. Apart from just behind a match, one can only begin where a run of its first characters begins, so each run is read once."""
    out, at = [], 0
    if "@" not in text:
        return out
    while m := (out and EMAIL.match(text, at)) or FIRST_EMAIL.search(text, at):
        out.append(m.span())
        at = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start. Matches that fail their test go."""
    out = [(0, *s) for s in emails(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = re.sub("[\x20-]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def resembles(word: str) -> str | None:
    """What words that resemble each other have in common, or None."""
    if "@" in word or AT.search(word):
        return DOT.sub(".", AT.sub("@", word)).strip("<>()[]{}.,;:!?\"'").lower()
    digits = re.sub("[^0-9]", "", word)
    return digits[-NEAR_DIGITS:] if len(digits) >= 5 else None


def features(word: str, before: str) -> list[int]:
    """Numbers of the features that a word and the one before it have."""
    digits = re.sub("[^0-9]", "", word)
    parts = word.strip("().,;:").split(".")
    marks = [
        any(c.isalpha() for c in word), "-" in word, "(" in word or ")" in word, "@" in word or bool(AT.search(word)), word.startswith("+"),
        len(parts) == 4 and all(p.isdigit() and int(p[-4:]) <= 255 for p in parts), 16 <= len(digits) <= 19 and luhn(digits), "=" in word or "/" in word or "_" in word, "." in word,
    ]
    context = xxhash.xxh32_intdigest(before.strip(".,;:()").lower()) % CONTEXT if before else None
    size = bisect_right(BOUNDS, len(digits))
    return [size, *(len(BOUNDS) + 1 + k for k, x in enumerate(marks) if x), *([SHAPES + context] if context is not None else [])]


@dataclass
class Field:
    """The variables of some documents: places of their words, features, neighbours and groups."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    x: np.ndarray  # features, 0 or 1
    label: np.ndarray  # 1 + kind inside a base span, else 0
    chain: np.ndarray  # k if words k and k + 1 stand side by side
    group: np.ndarray  # number of the word's group, or -1
    cores: list[str]


def fields(texts: list[str], docs: np.ndarray, found: list[list[tuple[int, int, int]]]) -> Field:
    """The variables of texts, given their base spans."""
    data, off = buffers(pa.array(texts, pa.large_string()))
    s, e, d = words(data, off, ~SPACE)
    if not len(s):
        z = np.zeros(0, np.int64)
        return Field(z, z, z, np.zeros((0, SHAPES + CONTEXT)), z, z, z, [])
    point = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    worth = np.flatnonzero(np.logical_or.reduceat(NODE[data], s))
    raw = data.tobytes()
    doc, start, end, label, rows, keys, place, cores = [], [], [], [], [], [], [], []
    spans = [[([a for j, a, _ in f if j == kind], [b for j, _, b in f if j == kind]) for kind in range(len(KINDS))] for f in found]
    known: dict[str, tuple | None] = {}  # what is the same wherever a word stands
    seen: dict[tuple[str, str], list[int]] = {}
    for k in worth.tolist():
        word, t = raw[s[k] : e[k]].decode(), int(d[k])
        if word not in known:
            core = CORE.search(word) if any(c in "0123456789@" for c in word) or AT.search(word) else None
            known[word] = core and (core.start(), core.end(), core.group(), resembles(word))
        if known[word] is None:
            continue
        first, last, own, key = known[word]
        begin = int(point[s[k]] - point[off[t]])
        a, b = begin + first, begin + last
        kind = next((kind for kind, (x, y) in enumerate(spans[t]) if (at := bisect_left(x, b)) and y[at - 1] > a), None)
        before = raw[s[k - 1] : e[k - 1]].decode() if k and d[k - 1] == t else ""
        if (word, before) not in seen:
            seen[word, before] = features(word, before)
        doc.append(docs[t])
        start.append(a)
        end.append(b)
        label.append(0 if kind is None else 1 + kind)
        rows.append(seen[word, before])
        keys.append((t, key))
        place.append(k)
        cores.append(own)
    x = np.zeros((len(rows), SHAPES + CONTEXT))
    x[np.repeat(np.arange(len(rows)), np.array([len(r) for r in rows], np.int64)), np.array([c for r in rows for c in r], np.int64)] = 1
    place, own = np.array(place, np.int64), np.array([t for t, _ in keys], np.int64)
    beside = np.flatnonzero((np.diff(place) == 1) & (np.diff(own) == 0)) if len(place) > 1 else np.zeros(0, np.int64)
    number: dict = {}
    group = np.array([-1 if key is None else number.setdefault((t, key), len(number)) for t, key in keys], np.int64)
    size = np.bincount(group[group >= 0], minlength=1)
    group = np.where((group >= 0) & (size[np.maximum(group, 0)] > 1), group, -1)
    return Field(np.array(doc), np.array(start, np.int64), np.array(end, np.int64), x, np.array(label, np.int64), beside, group, cores)


@dataclass
class Model:
    own: np.ndarray  # feature x label
    chain: np.ndarray  # label x next label
    twin: np.ndarray  # label x shared label, symmetric


STATES = len(KINDS) + 1


def fit(f: Field, steps: int = 300, rate: float = 0.1, penalty: float = 1e-3) -> Model:
    """Weights of greatest pseudo-likelihood; every second word has no features of its own. Zero weights without a base span."""
    n, model = len(f.label), Model(np.zeros((SHAPES + CONTEXT, STATES)), np.zeros((STATES, STATES)), np.zeros((STATES, STATES)))
    if not (f.label > 0).any():
        return model
    y = np.eye(STATES)[f.label]
    left, right, twins = np.zeros((n, STATES)), np.zeros((n, STATES)), np.zeros((n, STATES))
    left[f.chain + 1], right[f.chain] = y[f.chain], y[f.chain + 1]
    g = np.flatnonzero(f.group >= 0)
    if len(g):
        total = np.zeros((f.group.max() + 1, STATES))
        np.add.at(total, f.group[g], y[g])
        twins[g] = total[f.group[g]] - y[g]
        twins[g] /= twins[g].sum(axis=1, keepdims=True)
    x = f.x * (np.arange(n) % 2 == 0)[:, None]
    weight = 1 / np.maximum(1, np.bincount(f.label, minlength=STATES))[f.label]
    weight = (0.5 / n + 0.5 * weight / weight.sum())[:, None]  # half of the weight by label, so that rare kinds count
    params = [model.own, model.chain, model.twin]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, steps + 1):
        z = x @ model.own + left @ model.chain + right @ model.chain.T + twins @ model.twin
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        r = (p / p.sum(axis=1, keepdims=True) - y) * weight
        twin = twins.T @ r
        for p, m, v, grad in zip(params, first, second, [x.T @ r, left.T @ r + r.T @ right, (twin + twin.T) / 2], strict=True):
            grad = grad + penalty * p
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return model


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def probabilities(unary: np.ndarray, a: np.ndarray, b: np.ndarray, potential: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Each variable's probabilities by loopy message passing along edges a - b with log potentials (edges x states of a x states of b). Half of each old message is kept, so that loops settle."""
    n, states = unary.shape
    source, target = np.r_[a, b], np.r_[b, a]
    psi = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(a)) + len(a), np.arange(len(a))]
    message = np.zeros((len(source), states))
    belief = unary.copy()
    odds = np.exp(psi)
    order = np.argsort(target, kind="stable")
    first = np.flatnonzero(np.diff(target[order], prepend=-1))
    for _ in range(rounds if len(a) else 0):
        cavity = belief[source] - message[back]
        new = np.log(np.einsum("es,est->et", np.exp(cavity - cavity.max(axis=1, keepdims=True)), odds))
        before, message = message, (message + new - log_sum(new, 1)[:, None]) / 2
        belief = unary.copy()
        belief[target[order[first]]] += np.add.reduceat(message[order], first)
        if np.abs(message - before).max() < 1e-5:
            break
    return np.exp(belief - log_sum(belief, 1)[:, None])


def posterior(f: Field, model: Model) -> np.ndarray:
    """Each word's probabilities of nothing and the kinds; words in base spans are observed."""
    n = len(f.label)
    unary = f.x @ model.own
    seen = f.label > 0
    unary[seen] = -50.0
    unary[np.flatnonzero(seen), f.label[seen]] = 0.0
    member = np.flatnonzero(f.group >= 0)
    hubs, hub = np.unique(f.group[member], return_inverse=True)
    unary = np.concatenate([unary, np.zeros((len(hubs), STATES))])
    a, b = np.r_[f.chain, member], np.r_[f.chain + 1, n + hub]
    potential = np.concatenate([np.broadcast_to(model.chain, (len(f.chain), STATES, STATES)), np.broadcast_to(model.twin, (len(member), STATES, STATES))])
    return probabilities(unary, a, b, potential)[:n]


def added_spans(f: Field, p: np.ndarray, sure: float = SURE) -> list[tuple[int, int, int, int]]:
    """(document, kind, start, end) of the words outside base spans that are surely of a kind. Parts of a number side by side are one span, up to a kind's number of digits."""
    kind = p.argmax(axis=1)
    ok = (f.label == 0) & (kind > 0) & (p.max(axis=1) >= sure)
    most = {3: 19, 4: 15}
    out: list[list[int]] = []
    beside, digits, last = set(f.chain.tolist()), 0, -2
    for k in np.flatnonzero(ok).tolist():
        own = sum(c.isdigit() for c in f.cores[k])
        if last == k - 1 and k - 1 in beside and out[-1][1] == kind[k] - 1 and digits + own <= most.get(int(kind[k]), 0):
            out[-1][3], digits = int(f.end[k]), digits + own
        else:
            out.append([f.doc[k], int(kind[k]) - 1, int(f.start[k]), int(f.end[k])])
            digits = own
        last = k
    return [tuple(r) for r in out]


FIELDS = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, alone string"


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


Spans = list[list[tuple[int, int, int]]]


def field_spans(model: Model, texts: pa.Array) -> tuple[Spans, Spans, Spans]:
    """(base spans, spans that the field adds beside base spans, spans that it is sure of in texts without one) of each text."""
    base: Spans = [[] for _ in range(len(texts))]
    more: Spans = [[] for _ in range(len(texts))]
    alone: Spans = [[] for _ in range(len(texts))]
    some = np.flatnonzero(np.asarray(pc.match_substring_regex(texts, r"[0-9@\[(]"))).tolist()
    for k in some:
        base[k] = base_spans(texts[k].as_py())
    for out, mine in ((more, [k for k in some if base[k]]), (alone, [k for k in some if not base[k]])):
        if mine and model.own.any():
            f = fields([texts[k].as_py() for k in mine], np.array(mine), [base[k] for k in mine])
            if len(f.label):
                for k, kind, a, b in added_spans(f, posterior(f, model)):
                    out[k].append((kind, a, b))
    return base, more, alone


def text_spans(model: Model, texts: pa.Array) -> tuple[Spans, Spans]:
    """(base spans, added spans) of each text."""
    return field_spans(model, texts)[:2]


def learned(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the base spans of at most about ``sample`` documents that a hash of their ids picks, and of the bounded size of a training sample."""
    some = documents.filter(F.col("text").rlike("@|[+][0-9]|[0-9][.][0-9]|[0-9]{7}")).select("doc_id")
    share = F.lit(int((1 << 30) * min(1.0, sample / max(1, some.count()))))
    chosen = some.filter(F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30)) < share).distinct()
    texts = labelled_texts(documents, chosen, [])["text"].to_pylist()
    found = [base_spans(t) for t in texts]
    keep = [k for k, x in enumerate(found) if x]
    return fit(fields([texts[k] for k in keep], np.array(keep), [found[k] for k in keep]))


def scan(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, the number of base spans by kind, their digest, and all spans (kind:start:end in code points, end exclusive).

    Null and empty texts have none; repeated rows repeat. Added spans never meet base spans.
    ``alone`` has what the field is sure of in texts without a base span, where nothing vouches for it; ``spans`` doesn't.
    """

    def f(texts: pa.Array) -> list:
        base, more, alone = field_spans(model, texts)
        counts = [[sum(s[0] == k for s in spans) for spans in base] for k in range(len(KINDS))]
        return [*counts, [hashlib.sha256(told(b).encode()).hexdigest() for b in base], [told(b + m) for b, m in zip(base, more, strict=True)], [told(x) for x in alone]]

    return map_text(df, lambda: f, keep, FIELDS, text_col)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, learned(docs), ["doc_id"])
