"""HTML extraction by minimum-cut labelling.

A page is read into blocks of text (what stands between block-level tags). A linear
classifier gives each block the log-odds of being content from the tags, classes, ids and
roles around it, its length, its links and its punctuation. These costs are the capacities
of a block's links to the two terminals; neighbouring blocks, and blocks next to each other
under one parent, are joined by smoothness edges, heavier the nearer they are in the
document tree. The maximum flow, by blocking flows over shortest paths, gives the minimum
cut, which separates content from boilerplate.

The classifier is logistic and is fitted on the given pages: blocks inside elements that
HTML itself calls content (article, main) or not (nav, footer, aside, ..) are its labels,
each also shown without those marks, so that text features are learned too. A normal prior
around ``PRIOR`` decides what the pages say nothing about. No feature overrides the others:
a class word is one of them, and evidence counts from the element nearest to a block. A weak
class word gives way to the page as a whole: where nothing is marked as content, the element
that holds most of the text outside boilerplate is content, whatever its name.

Text: character references decoded, white space inside a block one space, blocks trimmed
and joined in page order by two line feeds.

Reading takes time in proportion to the page's length, whatever its markup. Elements nested
over ``DEPTH`` deep are read as siblings, as browsers do.

Defined results: null and empty pages give the empty text; so do pages without content
blocks; broken markup is read as browsers do (unclosed and stray tags are tolerated; a tag
that the page's end cuts off is left out; an attribute whose quote never closes ends at the
next white space or ``>``); repeated rows repeat; an empty table gives an empty result.
Extra columns are left out unless kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm.common import map_text, table

TAG = re.compile(r"/?[A-Za-z][^\s/>]*+")
ATTRIBUTE = re.compile(r"[\s/]*+(?:(?P<end>>)|(?P<name>[^\s/>][^\s/>=]*+)(?P<eq>\s*+=\s*+)?)")
UNQUOTED = re.compile(r"[^\s>]*+")
COMMENT_END = re.compile(r"--!?>")
CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NOTICE = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)|.*\ball rights reserved\b|.*\b(?:we use|uses|use of|using) cookies\b|(?=.*\bcookies\b).*\b(?:consent|cookie policy|privacy policy)\b", re.I)
DEPTH = 512
PAGES, BLOCKS_A_PAGE = 400, 32  # bounds of the training sample: pages, and labelled blocks of each
EVIDENCE = 200.0  # the whole sample weighs as much as so many rows against the prior

# How HTML's elements are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
UNREAD = frozenset("head template svg math object canvas video audio".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button label".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
PARAGRAPH_STOPS = frozenset("button table td th article section div aside nav form".split())
LINK_STOPS = frozenset("button table td th".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# What elements and the words of classes, ids and roles say.
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form header menu dialog button select search fieldset".split())
CONTENT_WORDS = frozenset("article content post entry story main text articlebody".split())
STRONG_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr popup modal overlay comment comments disqus reply replies sidebar menu nav navbar navigation footer masthead topbar breadcrumb breadcrumbs newsletter subscribe share sharing pagination pager toolbar complementary contentinfo skip".split())
WEAK_WORDS = frozenset("promotion notice notices alert discussion header social related recommended recommendations subscription signup login search widget copyright legal disclaimer form hidden respond trending popular".split())
PLAIN_WORDS = frozenset("site page global top bottom left right area list section box block wrapper wrap container inner outer bar primary secondary desktop mobile fixed blog item items link links button buttons icon icons group row col column panel slot unit zone reader user the".split()) | CONTENT_WORDS
STATE_WORDS = frozenset("has with no without not is category tag format type status".split())

FEATURES = ["bias", "content_tag", "content_word", "boilerplate_tag", "strong_word", "weak_word", "unseen", "inner_header", "words", "linked", "sentence", "heading", "linked_inside", "notice"]
PRIOR = np.array([-1.2, 4.0, 2.0, -9.0, -8.0, -2.5, -9.0, -3.5, 2.4, -4.0, 0.6, 0.4, 3.0, -4.0])
FROM_MARKS = [*range(1, 8), 12]  # the features that marks give
MOST_WORDS, NEAR, SIBLING = 40, 0.8, 0.5


@dataclass
class Tree:
    """Elements in page order, parents first; 0 is the page itself."""

    tag: list = field(default_factory=lambda: [""])
    parent: list = field(default_factory=lambda: [0])
    depth: list = field(default_factory=lambda: [0])
    link: list = field(default_factory=lambda: [False])
    unread: list = field(default_factory=lambda: [False])
    hints: list = field(default_factory=lambda: [None])


@dataclass
class Block:
    text: str
    node: int
    linked: int


def tokens(page: str) -> Iterator[tuple[str, str, dict | None, int]]:
    """(tag or "" for text, the text, attributes, end) in order; end tags begin with "/". Every character is passed a bounded number of times."""
    at, n, last = 0, len(page), {c: page.rfind(c) for c in ">\"'"}
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield "", page[at:], None, n
            return
        if i > at:
            yield "", page[at:i], None, i
        m = TAG.match(page, i + 1)
        if not m:
            if page.startswith("<!--", i):
                if page.startswith((">", "->"), i + 4):
                    at = page.index(">", i) + 1
                else:
                    end = COMMENT_END.search(page, i + 4)
                    at = end.end() if end else n
            elif page[i + 1 : i + 2] in ("!", "?", "/"):
                at = page.find(">", i) + 1 or n
            else:
                yield "", "<", None, i + 1
                at = i + 1
            continue
        attributes: dict = {}
        at = m.end()
        while True:
            a = ATTRIBUTE.match(page, at) if at <= last[">"] else None
            if not a:
                return  # the page ends inside a tag
            at = a.end()
            if a["end"]:
                break
            value = ""
            if a["eq"]:
                quote = page[at : at + 1]
                if quote in ('"', "'") and at < last[quote]:
                    end = page.index(quote, at + 1)
                    value, at = page[at + 1 : end], end + 1
                else:
                    v = UNQUOTED.match(page, at)
                    value, at = v[0], v.end()
            attributes.setdefault(a["name"].lower(), value)
        yield m[0].lower(), "", attributes, at
        if m[0].lower() in RAW:
            end = re.compile(f"</{m[0]}(?=[\\s/>])", re.I).search(page, at)
            at = (page.find(">", end.end()) + 1 or n) if end else n


def class_words(value: str) -> tuple[int, int, int]:
    """(strong, weak, content): whether a class, id or role says so. A name with foreign words beside a boilerplate word says so weakly; one about a state or a category says nothing."""
    strong = weak = content = 0
    for name in value.split():
        words = [w.lower() for w in CLASS_WORD.findall(name)]
        if not words or words[0] in STATE_WORDS:
            continue
        if any(w in STRONG_WORDS for w in words):
            if all(w in STRONG_WORDS or w in WEAK_WORDS or w in PLAIN_WORDS for w in words):
                strong = 1
            else:
                weak = 1
        elif any(w in WEAK_WORDS for w in words):
            weak = 1
        elif any(w in CONTENT_WORDS for w in words):
            content = 1
    return strong, weak, content


def hints(tag: str, attributes: dict) -> tuple | None:
    """(content tag, content word, boilerplate tag, strong, weak, unseen, main) of an element, or None."""
    if not attributes and tag not in CONTENT_TAGS and tag not in BOILERPLATE_TAGS:
        return None
    main = tag == "main"
    strong = weak = content = unseen = 0
    if attributes and tag not in ("body", "html"):
        for name in ("class", "id", "role"):
            if value := attributes.get(name):
                s, w, c = class_words(value)
                strong, weak, content = strong | s, weak | w, content | c
        unseen = int("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(attributes.get("style", ""))))
        main = main or attributes.get("role", "").lower() == "main" or attributes.get("itemprop", "").lower() == "articlebody"
    out = (int(tag in CONTENT_TAGS or main), content, int(tag in BOILERPLATE_TAGS), strong, weak, unseen, int(main))
    return out if any(out) else None


def parse(page: str) -> tuple[Tree, list[Block]]:
    tree, stack, blocks = Tree(), [0], []
    open_: Counter[str] = Counter()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                at = stack[-1]
                while at and tree.tag[at] not in BLOCK:
                    at = tree.parent[at]
                blocks.append(Block(whole, at, linked))
            text.clear()
        linked = 0

    def pop() -> str:
        tag = tree.tag[stack.pop()]
        open_[tag] -= 1
        return tag

    def close(names: Sequence[str], stops: frozenset[str] | set[str]) -> None:
        """End the innermost of ``names``, and what is in it, unless one of ``stops`` comes before."""
        if any(open_[x] for x in names):
            for k in range(len(stack) - 1, 0, -1):
                t = tree.tag[stack[k]]
                if t in names:
                    while len(stack) > k:
                        pop()
                    return
                if t in stops:
                    return

    for tag, piece, attributes, _ in tokens(page):
        if not tag:
            if not tree.unread[stack[-1]]:
                if "&" in piece:
                    piece = entities.unescape(piece)
                text.append(piece)
                if tree.link[stack[-1]]:
                    linked += len(piece.strip())
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag in BLOCK:
                flush()
            if open_[tag]:
                close((tag,), frozenset() if tag in BLOCK or tag in UNREAD else BLOCK)
            continue
        if tag in RAW:
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if open_["head"]:
                close(("head",), frozenset())
            close(("p",), PARAGRAPH_STOPS)
            if tag in CLOSES:
                close(*CLOSES[tag])
        elif tag == "a":
            close(("a",), LINK_STOPS)
        if len(stack) > DEPTH:
            pop()
        up = stack[-1]
        tree.tag.append(tag)
        tree.parent.append(up)
        tree.depth.append(tree.depth[up] + 1)
        tree.link.append(tree.link[up] or tag == "a")
        tree.unread.append(tree.unread[up] or tag in UNREAD)
        tree.hints.append(hints(tag, attributes))
        stack.append(len(tree.tag) - 1)
        open_[tag] += 1
    flush()
    return tree, blocks


def surroundings(tree: Tree, blocks: list[Block]) -> list[tuple]:
    """The seven element features of each element's inside.

    Evidence nearer to a block outweighs what stands above it: a boilerplate element inside
    content ends the content's evidence, and content marks inside boilerplate count for
    nothing. A form or a named element that holds the page's main part isn't boilerplate:
    one with a main element, or with a top heading and over half (a form: a fifth) of the
    plain text. A weak name says nothing, and counts as a content word, where its element
    holds over half of the plain text outside boilerplate elements and strong names, and no
    text stands in content marks outside all other names; where such text stands, a weak
    name outside it counts twice.
    """
    n = len(tree.tag)
    plain, free, main, title = [0] * n, [0] * n, [False] * n, [False] * n
    named, shut, inside = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        h, p = tree.hints[i] or (0,) * 7, tree.parent[i]
        shut[i] = shut[p] or bool(h[2] or h[3] or h[5])
        named[i] = named[p] or shut[i] or bool(h[4])
        inside[i] = inside[p] or bool(h[0] or h[1])
    unmarked = True
    for b in blocks:
        letters = max(0, len(b.text) - b.linked)
        plain[b.node] += letters
        free[b.node] += 0 if shut[b.node] else letters
        unmarked = unmarked and not (letters and inside[b.node] and not named[b.node])
    for i in range(n - 1, 0, -1):
        h, p = tree.hints[i], tree.parent[i]
        main[i] = main[i] or bool(h and h[6])
        title[i] = title[i] or tree.tag[i] == "h1"
        plain[p] += plain[i]
        free[p] += free[i]
        main[p], title[p] = main[p] or main[i], title[p] or title[i]
    out: list[tuple] = [(0, 0, 0, 0, 0, 0, 0)]
    for i in range(1, n):
        up, h = out[tree.parent[i]], tree.hints[i]
        if not h:
            out.append(up)
            continue
        tag, word, bad, strong, weak, unseen, _ = h
        form = tree.tag[i] == "form"
        if (bad or strong or weak) and (main[i] or (title[i] and plain[i] > plain[0] / (5 if form else 2))):
            strong = weak = 0
            bad = 0 if form else bad
        elif weak and not (bad or strong) and unmarked and free[i] > free[0] / 2:
            word, weak = 1, 0
        elif weak and not (unmarked or tag or word or up[0] or up[1]):
            weak = 2
        inner = int(tree.tag[i] == "header" and up[0] and not up[2])
        bad -= inner
        ct, cw, cb, cs, ck, cu, ci = up
        if bad or strong:
            ct = cw = 0
        elif not (cb or cs):
            ct, cw = max(ct, tag), max(cw, word)
        out.append((ct, cw, min(2, cb + bad), min(2, cs + strong), min(2, ck + weak), max(cu, unseen), max(ci, inner)))
    return out


def vectors(tree: Tree, blocks: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block."""
    around = surroundings(tree, blocks)
    rows = []
    for b in blocks:
        marks, words, linked = around[b.node], b.text.count(" ") + 1, min(1.0, b.linked / len(b.text))
        notice = not (marks[0] or marks[1]) and words <= MOST_WORDS and bool(NOTICE.match(b.text))
        rows.append((1, *marks, min(MOST_WORDS, words) / MOST_WORDS, linked, b.text[-1] in ".!?:;\"')»”…", tree.tag[b.node] in HEADINGS, linked * marks[0], notice))
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


def tree_distance(a: int, b: int, tree: Tree) -> int:
    d = 0
    while a != b:
        if tree.depth[a] >= tree.depth[b]:
            a = tree.parent[a]
        else:
            b = tree.parent[b]
        d += 1
    return d


def minimum_cut(excess: Sequence[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes that keep no path to the sink. excess: capacity from the source, or if negative to the sink.

    Each round measures all nodes' distances to the nearest node with capacity left to the
    sink, then sends what it can along shortest paths only; rounds end when no node with
    capacity from the source has a path. A round passes every edge once.
    """
    n, eps = len(excess), 1e-9
    to: list[int] = []
    room: list[float] = []
    ends: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        ends[a].append(len(to))
        to.append(b)
        room.append(w)
        ends[b].append(len(to))
        to.append(a)
        room.append(w)
    left = list(excess)
    while True:
        level = [-1] * n
        queue = [t for t in range(n) if left[t] < -eps]
        for t in queue:
            level[t] = 0
        met = False
        for v in queue:
            for e in ends[v]:
                u = to[e]
                if level[u] < 0 and room[e ^ 1] > eps:
                    level[u] = level[v] + 1
                    met = met or left[u] > eps
                    queue.append(u)
        if not met:
            return [x < 0 for x in level]
        tried = [0] * n
        for s in range(n):
            while left[s] > eps and level[s] >= 0:
                path, v = [], s
                while left[v] >= -eps:
                    while tried[v] < len(ends[v]):
                        e = ends[v][tried[v]]
                        if room[e] > eps and level[to[e]] == level[v] - 1 and level[to[e]] >= 0:
                            break
                        tried[v] += 1
                    else:
                        level[v] = -1
                        if not path:
                            break
                        v = to[path.pop() ^ 1]
                        tried[v] += 1
                        continue
                    path.append(e)
                    v = to[e]
                if level[s] < 0:
                    break
                flow = min(left[s], -left[v], *[room[e] for e in path])
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                left[s] -= flow
                left[v] += flow


def main_text(page: str, weights: np.ndarray = PRIOR) -> str:
    tree, blocks = parse(page)
    if not blocks:
        return ""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR / (1 + tree_distance(blocks[i - 1].node, b.node, tree) / 2)))
        parent = tree.parent[b.node]
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    scores = (vectors(tree, blocks) @ weights).tolist()
    kept = minimum_cut(scores, edges)
    return "\n\n".join(b.text for b, s, k in zip(blocks, scores, kept, strict=True) if k and s != 0.0)


def marked(page: str, most: int = BLOCKS_A_PAGE) -> np.ndarray:
    """Up to ``most`` blocks' features and, last, label, evenly from each side: inside content elements only (1), or inside boilerplate elements (0)."""
    tree, blocks = parse(page)
    x = vectors(tree, blocks)
    y = np.where((x[:, 1] > 0) & (x[:, 3:8] == 0).all(1), 1, np.where(x[:, 3] > 0, 0, -1))
    sides = [np.flatnonzero(y == k) for k in (0, 1)]
    chosen = np.concatenate([s[np.linspace(0, len(s) - 1, min(len(s), most // 2)).astype(np.int64)] if len(s) else s for s in sides])
    return np.c_[x, y][chosen]


def train(rows: np.ndarray) -> np.ndarray:
    """Weights of the most likely logistic model under the prior, by Newton steps. rows: features and label."""
    if not len(rows) or len(np.unique(rows[:, -1])) < 2:
        return PRIOR
    x, y = rows[:, :-1], rows[:, -1]
    bare = x.copy()
    bare[:, FROM_MARKS] = 0
    x, y = np.concatenate([x, bare]), np.r_[y, y]
    weight = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y <= 0).sum()) * EVIDENCE / 2
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (weight * (p - y)) + (w - PRIOR)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(df: DataFrame, id_col: str = "page_id", html_col: str = "html", pages: int = PAGES) -> np.ndarray:
    """Weights learned from about ``pages`` pages, chosen by a hash of the id; blocks are read in tasks, and at most ``BLOCKS_A_PAGE`` rows a page come back."""
    share = pages / max(1, df.count())
    some = df.filter(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, share))))

    def f(texts: pa.Array) -> list:
        return [pa.array([marked(p).tobytes() for p in texts.to_pylist()], pa.binary())]

    got = map_text(some, lambda: f, [id_col], "rows binary", html_col).dropDuplicates([id_col]).toArrow()
    rows = sorted(r for r in got["rows"].to_pylist() if r)
    return train(np.frombuffer(b"".join(rows)).reshape(-1, len(FEATURES) + 1))


def extract(df: DataFrame, keep: Sequence[str], html_col: str = "html", weights: np.ndarray = PRIOR) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` of every row's whole page."""

    def f(pages: pa.Array) -> list:
        texts = [main_text(p, weights) for p in pages.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return map_text(df, lambda: f, keep, "text string, n_chars bigint", html_col)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, ["page_id", "url"], weights=fit(pages))
