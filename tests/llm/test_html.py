from itertools import product

import numpy as np
import pytest

from ledgerloom.llm import html_crf
from ledgerloom.llm.html_blocks import Block, blocks
from ledgerloom.llm.html_pages import MAIN, OTHER, labelled_pages


@pytest.fixture(scope="module")
def field():
    return html_crf.train()


def test_blocks():
    html = "<!doctype html><title>t</title><script>var a='</p><p>no';</script><ul><li>one<li><a href=x>t&amp;wo</a> 3</ul><p>a <b>b</b>c<br>d<p id='X-yz'>e<!-- <p>f</p> -->\n g<div hidden>h</div> < 5 <style>q"
    got = [(b.text, b.linked, [t for t, _ in b.path]) for b in blocks(html)]
    assert got == [("one", 0, ["ul", "li"]), ("t&wo 3", 4, ["ul", "li"]), ("a bc d", 0, ["p"]), ("e g", 0, ["p"]), ("h", 0, ["div"]), ("< 5", 0, [])]
    assert blocks(html)[3].path == (("p", ("x", "yz")),) and blocks(html)[4].path == (("div", ("hidden",)),)
    assert blocks(None) == blocks("") == blocks(" <p> </p>") == []


def test_decoding_is_the_best_of_all(field):
    rng = np.random.default_rng(3)
    pages = [blocks(h.replace(MAIN, "").replace(OTHER, "")) for h in labelled_pages(60, 5)]
    for page in [p[:8] for p in pages if p]:
        score, kinds = field.scores(page) + rng.normal(0, 2, (len(page), 2)), html_crf.ties(page)
        worth = lambda y: field.first[y[0]] + sum(s[k] for s, k in zip(score, y)) + sum(field.pair[t][a][b] for t, a, b in zip(kinds, y, y[1:]))  # noqa: B023, E731
        own = html_crf.Field({})
        own.pair, own.first, own.scores = field.pair, field.first, lambda _, s=score: s
        assert worth(own.decode(page)) == pytest.approx(max(worth(y) for y in product((0, 1), repeat=len(page))))


def test_unseen_pages(field):
    wrong = n = 0
    for html in labelled_pages(150, 4242):
        page = blocks(html)
        truth = [int(MAIN in b.text) for b in page]
        for b in page:
            b.text = b.text.replace(MAIN, "").replace(OTHER, "") or "x"
        wrong, n = wrong + sum(a != b for a, b in zip(truth, field.decode(page))), n + len(page)
    assert wrong / n < 0.01


PAGE = """<html><body><header class="site-header"><div class="logo">My Site</div><nav><a href="/">Home</a> <a href="/x">News</a></nav></header>
<div class="cookie-notice"><p>We use cookies to make this site better. Please accept them all.</p><button>Accept</button></div>
{open}<h1>A  title &mdash; here</h1><p>First paragraph of the story, which goes on for a while &amp; more.</p>
<div class="ad">Buy this now, it is the best thing you can buy today.</div><p>Short.</p><p>Second <b>para</b>graph with a <a href="/l">link</a> in it, and more words after that.</p>{close}
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">Another story</a></li></ul></aside>
<section id="comments"><h2>2 comments</h2><div class="comment"><p>I really liked this article, thank you very much for it.</p></div></section>
<form action="/s"><label>Your address</label><input><button>Sign up</button></form><footer>&copy; 2024 My Site. All rights reserved.</footer></body></html>"""
STORY = "A title — here First paragraph of the story, which goes on for a while & more. Short. Second paragraph with a link in it, and more words after that."


@pytest.mark.parametrize("around", [("<article>", "</article>"), ('<div class="post-content">', "</div>"), ("<main>", "</main>"), ('<div id="content">', "</div>")])
def test_hand_made_page(field, around):
    assert html_crf.main_text(field, PAGE.format(open=around[0], close=around[1])) == STORY


def test_table(spark, field):
    long = "<article><h1>T</h1>" + "<p>" + "Many words are here, one after the other. " * 20_000 + "</p></article>"
    rows = [(1, "u", PAGE.format(open="<article>", close="</article>"), "x"), (2, None, None, None), (None, "u", "", "x"), (3, "u", long, "x"), (1, "u", "<nav><ul><li><a href=x>Home</a></ul></nav>", "x")]
    got = html_crf.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), field=field).collect()
    assert [len(r["text"]) == r["n_chars"] for r in got] == [True] * 5
    assert sorted(r["n_chars"] for r in got) == [0, 0, 0, len(STORY), 42 * 20_000 + 1]
    assert html_crf.extracted(spark.createDataFrame([], "page_id long, url string, html string"), field=field).count() == 0


def test_forward_backward_counts(field):
    """A trained field prefers the labels it was trained on to any single change."""
    page = [Block("Home", 4, (("nav", ()), ("a", ()))), Block("A long paragraph of main text, with stops. And more of it.", 0, (("article", ()), ("p", ())))]
    assert field.decode(page) == [0, 1]
