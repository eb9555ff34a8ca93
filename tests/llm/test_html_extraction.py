from __future__ import annotations

import html as escapes
import itertools
import re
import time
from collections import Counter

import numpy as np
import pytest

from stratiform.llm.html_extraction import Extractor, Pages, _kind, main_texts
from stratiform.llm.labelled_pages import labelled_pages

from .layouts import LAYOUTS


@pytest.fixture(scope="module")
def extractor():
    return Extractor(labelled_pages())


def brute_marginals(parent, own, moves):
    """Marginals by summing over all assignments."""
    n = len(parent)
    total = np.zeros((n, 2))
    for states in itertools.product((0, 1), repeat=n):
        weight = 1.0
        for k in range(n):
            weight *= np.exp(own[k] * states[k])
            if parent[k] >= 0:
                weight *= moves[k, states[parent[k]], states[k]]
        for k in range(n):
            total[k, states[k]] += weight
    return total[:, 1] / total.sum(axis=1)


def test_messages_give_exact_marginals(extractor):
    pages = Pages()
    pages.read(0, "<div class='ad'>short<p>some longer text, here</p><ul><li>x</li></ul></div><article><p>a b c.</p></article>")
    own = [0.0 if key is None else extractor._of_element(key) for key in pages.key]
    for leaf, (features, share) in pages.block_features().items():
        own[leaf] = share * sum(extractor.log_odds.get(f, 0.0) for f in features)
    moves = np.array([extractor.moves[_kind(key)] for key in pages.key])
    assert len(own) <= 16
    np.testing.assert_allclose(extractor.marginals(pages), brute_marginals(pages.parent, own, moves), rtol=1e-6)


def test_held_out_labelled_pages(extractor):
    pages = Pages()
    for k, page in enumerate(labelled_pages(200, seed=1234)):
        pages.read(k, page)
    state = []
    for parent, label in zip(pages.parent, pages.label, strict=True):
        state.append({"yes": 1, "no": 0}.get(label, state[parent] if parent >= 0 else 0))
    leaf = np.array([key is None for key in pages.key])
    right = (extractor.marginals(pages) >= 0.5) == np.array(state)
    assert right[leaf].mean() > 0.9


def test_page_with_everything_around(extractor):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
    <body><header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
    <div id="cookie-notice"><p>We use cookies to make this page better for you and everybody else.</p></div>
    <article><h1>A  title &amp;
    more</h1><p><b>First&nbsp;line<br>goes on.<p>Of.<p>Third &lt;one&gt; &#233;t&eacute;.
    <div class="ad">Buy now</div><form><input><button>Send</button>Your mail</form>
    <ul><li>one<li>two</ul></article>
    <aside class="sidebar"><p>Other things that you may read on this page.</p></aside>
    <section id="comments"><h3>Comments</h3><div class="comment"><p>I liked it, and so did many others who read it.</p></div></section>
    <footer>&copy; somebody</footer></body></html>"""
    assert extractor.extract([page]) == ["A title & more\nFirst line goes on.\nOf.\nThird <one> été.\none\ntwo"]


def test_awkward_pages(spark, extractor):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (4, "u", "<p>a</p>" * 3000), (4, "u", "<p>a</p>" * 3000),
            (None, "u", "<script>never ends"), (5, "u", "</p></div><b>"), (6, "u", "<div>" * 5000 + "deep"), (7, "u", '<a title="x>y <p>z')]
    pages = spark.createDataFrame([(*r, "extra", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = main_texts(pages).collect()
    assert len(found) == len(rows)
    assert all(x["n_chars"] == len(x["text"]) for x in found)
    by_id = {x["page_id"]: x["text"] for x in found}
    assert by_id[1] == by_id[2] == by_id[None] == by_id[5] == ""
    assert main_texts(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """On the synthetic pages the article is what stands in the article element."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {x["page_id"]: x["text"] for x in main_texts(pages).collect()}
    for x in pages.collect():
        inside = re.search(r"<article>(.*)</article>", x["html"], re.S)[1]
        blocks = [" ".join(escapes.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert found[x["page_id"]] == "\n".join(b for b in blocks if b)


def nodes(html):
    pages = Pages()
    pages.read(0, html)
    return [key for key in pages.key if key and key[0]], [x[2] for x in pages.texts if not x[2].isspace()]


@pytest.mark.parametrize(("html", "keys", "texts"), [
    ('<div class="ad" data-x="<p>hi</p>">Buy</div>', [("div", "ad")], ["Buy"]),
    ("<div class='ad' data-x='<p class=\"main\">hi</p>'>Buy</div>", [("div", "ad")], ["Buy"]),
    ('<p>one<img alt="a < b">two</p>', [("p", "")], ["one", "two"]),
    ('<a title = "a <b> c"/>x', [("a", "")], ["x"]),
    ('<a title="x>y <p>z', [("a", ""), ("p", "")], ["y ", "z"]),
    ('<a title="x>y</a> <p class="b">z</p>', [("a", ""), ("p", "b")], ["y", "z"]),
])
def test_tags_with_angle_brackets_in_values(html, keys, texts):
    assert nodes(html) == (keys, texts)


@pytest.mark.parametrize("start", ["<p>", "", "<main><p>", "<svg></svg><p>"])
def test_head_without_end(extractor, start):
    line = "This is some longer text, and it goes on for a while here."
    head = "<head><meta charset=utf-8><title>T</title><style>p{}</style><link href=x>"
    assert nodes(head + start + line)[1] == [line]
    for page in (head + start + line, "<!DOCTYPE html><html>" + head + "\n<script>var t;</script> " + start + line):
        assert extractor.extract([page]) == extractor.extract([page.replace("<link href=x>", "<link href=x></head>")])
    assert extractor.extract([head + f"<article><p>{line}</p></article>"]) == [line]


def overlap(got: str, lines: list[str]) -> tuple[float, float]:
    """Share of the article's words that are found, and share of the found words that are the article's."""
    found, wanted = Counter(got.split()), Counter(" ".join(lines).split())
    both = (found & wanted).total()
    return both / wanted.total(), both / max(1, found.total())


def test_layouts_written_by_hand(extractor):
    assert len(LAYOUTS) >= 30
    got = extractor.extract([html for html, _ in LAYOUTS.values()])
    rates = {name: overlap(text, lines) for (name, (_, lines)), text in zip(LAYOUTS.items(), got, strict=True)}
    assert {name: r for name, r in rates.items() if min(r) < 0.95} == {}
    exact = sum(text == "\n".join(lines) for (_, lines), text in zip(LAYOUTS.values(), got, strict=True))
    assert exact >= 0.9 * len(LAYOUTS)


@pytest.mark.parametrize("html", [
    "<div>" * 200_000, "<span>" * 90_000 + "</b>" * 110_000, "<p>" + "<span>" * 60_000 + "</i>" * 60_000, "<ul>" + "<li><b>" * 70_000,
    "<table>" + "<tr><td>" * 60_000, "<button><p>" + "<div>" * 100_000 + "</p>" * 80_000, "</div>" * 170_000,
])
def test_pages_of_a_megabyte_take_seconds(extractor, html):
    html += "<p>" + "x" * max(0, 1_000_000 - len(html))
    began = time.time()
    extractor.extract([html, "<article><p>Some other page.</p></article>"])
    assert time.time() - began < 5 * 3  # other tests may run beside this one
