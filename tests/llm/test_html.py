"""HTML extraction: pages of the table against their articles, hand-made pages, broken and very long ones."""

import html as entities
import random
import re
import time

import numpy as np
import pytest

from snapquarry.llm import html
from snapquarry.llm.common import table

BODY = "<p>First paragraph of the article, with several words in it.</p><p>Second paragraph, again with quite a few words.</p><p>Short.</p>"
WANT = "First paragraph of the article, with several words in it.\n\nSecond paragraph, again with quite a few words.\n\nShort."
HEAD = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
TAIL = """<aside class="sidebar"><h3>Related</h3><p>Some related text that is long enough to be a paragraph.</p></aside>
<section class="comments"><h2>Comments</h2><article class=comment><p>I disagree, and here is a long reader comment with many words in it.</p></article></section>
<div class="cookie-notice"><p>We use cookies to improve your experience on this site. Please accept them.</p></div>
<form><label>Mail</label><input><button>Subscribe</button></form><footer><p>Copyright 2020 the site. All rights reserved.</p></footer>"""


def article(page):
    """The article of a page of the table: all text inside the only article element, a block for each h1 and p."""
    inside = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(entities.unescape(re.sub("<[^>]+>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inside))
    return "\n\n".join(b for b in blocks if b)


def test_all_pages_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = html.op2_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("form", ['<div id="content" class="has-sidebar">%s</div>', '<main class="main with-sidebar">%s</main>', '<article class="post social-policy">%s</article>', '<article class="post format-standard category-legal">%s</article>', '<div class="content">%s</div>', '<form id="f"><div id="main"><h1></h1>%s</div></form>'])
def test_names_beside_the_article(form):
    assert html.main_text(f"<html><head><title>x</title></head><body>{HEAD}{form % BODY}{TAIL}</body></html>") == WANT


def test_boilerplate_inside_the_article():
    advert = '<div class="ad">Buy these wonderful things now, they are cheap and good and you will like them a lot, so click here and order a box of them today.</div>'
    assert html.main_text(f"{HEAD}<article class=post>{BODY}{advert}<p>Last.</p></article>{TAIL}") == WANT + "\n\nLast."


def test_classifier_is_learned(spark):
    """Marked blocks move the weights from the prior; without labels it stays; both sides are told apart."""
    pages = [r.html for r in table(spark, "/root/testdata/sf0.001", "pages").collect()]
    rows = np.concatenate([html.marked(p) for p in pages])
    w = html.train(rows)
    assert set(rows[:, -1]) == {0.0, 1.0} and np.abs(w - html.PRIOR).max() > 0.05
    assert (((rows[:, :-1] @ w) > 0) == (rows[:, -1] > 0)).mean() > 0.99
    assert (html.train(rows[:0]) == html.PRIOR).all() and (html.train(rows[rows[:, -1] > 0]) == html.PRIOR).all()


def test_broken_pages():
    assert html.main_text("<article><p>A first one.<p>A second one with <b>bold <i>text</b>.<div>A third.</article>") == "A first one.\n\nA second one with bold text.\n\nA third."
    assert html.main_text("<article><p>Kept as it is.</p><p class='x>Still here.</p></article>").startswith("Kept as it is.")
    assert html.main_text("<article><p>One is < two &amp; so on.</p></article><a") == "One is < two & so on."
    assert html.main_text("<article><p>One.</p><svg><text>no</text></svg><script>if (a</script><!-- x --><p>Two.</p>") == "One.\n\nTwo."
    for p in ("", "<", "<!--", "</", "<a b", "<a b='", "<nav>x</nav>", "&", "<!>", "<svg>"):
        assert html.main_text(p) in ("", "<", "&")


@pytest.mark.parametrize("page", ["<a" * 300_000, "<a " * 200_000, '<a b="' * 100_000, "<a b='\">" * 100_000, "<div>" * 100_000, "<b>" * 50_000 + "<li>x" * 50_000, "<!--" * 200_000, "<script" * 100_000, "<" * 500_000, "<nav><ul>" + "<li><a href=/x>item</a></li>" * 50_000 + f"</ul></nav><article>{BODY}</article>"], ids=range(10))
def test_long_pages_take_linear_time(page):
    """A page of so many parts may take a few times what a tenth of it takes ten times over; quadratic reading would take far longer than the bound."""
    began = time.process_time()
    text = html.main_text(page)
    assert time.process_time() - began < 10
    assert "item" not in text


def test_cut_against_all_labellings():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randint(2, 8)
        excess = [rng.choice([-6, -2, -1, 1, 3, 6]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.5, 1, 2, 4])) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side, excess=excess, edges=edges):
            return sum(abs(e) for e, s in zip(excess, side, strict=True) if (e > 0) != s) + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert abs(cost(html.minimum_cut([float(e) for e in excess], edges)) - best) < 1e-6


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, f"<article>{BODY}</article>", 5), (3, f"<article>{BODY}</article>", 5), (None, "<p>x", 5)], "page_id bigint, html string, n_chars int")
    rows = html.extract(df, ["page_id"], weights=html.fit(df)).collect()
    assert sorted(r.n_chars for r in rows if r.page_id) == [0, 0, len(WANT), len(WANT)]
    assert html.extract(df.limit(0), ["page_id"], weights=html.fit(df.limit(0))).count() == 0


def test_articles_under_any_name(spark):
    """Weak names, and 200 names of list words and foreign words, around an article that nothing else marks."""
    w = html.fit(table(spark, "/root/testdata/sf0.01", "pages"))
    rng = random.Random(11)
    listed = sorted(html.STRONG_WORDS | html.WEAK_WORDS | html.PLAIN_WORDS)
    names = ["discussion-article", "page related-article", "promo-history", "legal"]
    for _ in range(200):
        words = rng.sample(listed, rng.randint(1, 2)) + ["".join(rng.choice("bdfgklmnoprtuvz") for _ in range(rng.randint(4, 8)))]
        rng.shuffle(words)
        names.append(rng.choice("-_").join(words))
    for name in names:
        for page in (f"<div class='{name}'>{BODY}</div>", f"<section id='{name}'><h1>Title</h1>{BODY}</section>"):
            got = html.main_text(f"<html><body>{HEAD}{page}{TAIL}</body></html>", w)
            assert got == ("Title\n\n" if "<h1>" in page else "") + WANT, (name, got)


def test_weak_names_beside_an_article(spark):
    w = html.fit(table(spark, "/root/testdata/sf0.01", "pages"))
    related = "<div class='related-zubin'><p>" + "Another story that many readers liked, in a few words. " * 20 + "</p></div>"
    for page in (f"<article>{BODY}</article>{related}", f"<div class=content>{BODY}</div>{related}"):
        assert html.main_text(HEAD + page + TAIL, w) == WANT


def test_links_inside_an_article_and_notices_outside(spark):
    w = html.fit(table(spark, "/root/testdata/sf0.01", "pages"))
    links = "".join(f"<li><a href=/{x}>{x} and more</a></li>" for x in ("Alpha", "Beta", "Gamma"))
    want = "Reading list\n\nAlpha and more\n\nBeta and more\n\nGamma and more"
    assert html.main_text(f"{HEAD}<article><h1>Reading list</h1><ul>{links}</ul></article>{TAIL}", w) == want
    for notice in ("We use cookies to improve your experience on this site. Please accept them.", "© 2024 Example Ltd.", "Copyright 2020 the site. All rights reserved.", "By using this website you agree to our use of cookies."):
        assert html.main_text(f"{HEAD}<article>{BODY}</article><div>{notice}</div>", w) == WANT
        assert html.main_text(f"<p>{notice}</p>{HEAD}<article>{BODY}</article>", w) == WANT
    kitchen = "Our cookies are made of oats, and you may agree that they are the best."
    assert html.main_text(f"{HEAD}<div><p>{kitchen}</p></div>", w) == kitchen
