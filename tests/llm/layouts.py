"""Pages written by hand: layouts that the labelled pages' grammar did not write. Each has the lines of its article."""

from __future__ import annotations

P = "The committee met on Tuesday evening to discuss how the new bridge would change traffic in the northern part of town, and nobody objected to it."
Q = "Engineers had warned for years that the old crossing could not carry heavy lorries any longer."
R = "Work is expected to begin next spring, provided that the weather allows it."
S = "Residents asked whether the footpath along the river stays open during construction."
SHORT = "It will."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>'
MENU = '<div class="menu"><a href="/a">Start</a> <a href="/b">Topics</a> <a href="/c">Contact</a></div>'
HEAD = f'<header class="site-header"><a href="/">The Paper</a>{NAV}</header>'
FOOT = '<footer><p>Copyright 2020 The Paper. All rights reserved.</p><a href="/imprint">Imprint</a></footer>'
SIDE = '<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Storm over the coast</a></li><li><a href="/2">Prices rise</a></li></ul></aside>'
COOKIE = '<div class="cookie-banner"><p>We use cookies to give you the best experience on our site.</p><button>OK</button></div>'
REPLIES = '<div id="comments"><h3>2 comments</h3><div class="comment"><p>I really do not like this idea at all, sorry.</p></div></div>'
AD = '<div class="advert">Buy two, get one free</div>'


def page(body: str, around: bool = True) -> str:
    body = f"{COOKIE}{HEAD}{body}{SIDE}{REPLIES}{FOOT}" if around else body
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>"


def ps(*texts: str) -> str:
    return "".join(f"<p>{t}</p>" for t in texts)


T = "<h1>New bridge for the north</h1>"
TITLE = "New bridge for the north"
WIKI = f"""<div id="content" class="mw-body"><h1>{TITLE}</h1><div id="bodyContent"><div id="mw-content-text">
<div class="mw-parser-output">{ps(P, Q)}<h2>History</h2>{ps(R, S)}</div></div></div></div>"""

LAYOUTS = {
    "main, sections": (page(f"<main><section><h2>Plans</h2>{ps(P)}</section><section><h2>Costs</h2>{ps(Q)}</section></main>"), ["Plans", P, "Costs", Q]),
    "wiki": (page(WIKI), [TITLE, P, Q, "History", R, S]),
    "wiki, plain inside": (page(f'<div id="content" class="mw-body">{T}<div id="bodyContent"><div id="mw-content-text"><div>{ps(P, Q)}</div></div></div></div>'), [TITLE, P, Q]),
    "blocks in divs": (page(f'<article>{T}<div class="section">{ps(P)}</div><div class="wp-block-group">{ps(Q)}</div></article>'), [TITLE, P, Q]),
    "one section beside paragraphs": (page(f"<article>{ps(P)}<section><h2>Costs</h2>{ps(Q)}</section>{ps(R)}</article>"), [P, "Costs", Q, R]),
    "paragraph that is a link": (page(f'<article>{T}{ps(P)}<p><a href="/more">{Q}</a></p>{ps(R)}</article>'), [TITLE, P, Q, R]),
    "classed paragraph": (page(f'<article>{T}{ps(P)}<p class="social">The social sciences study how people live together in towns.</p>{ps(Q)}</article>'),
                          [TITLE, P, "The social sciences study how people live together in towns.", Q]),
    "classed span": (page(f'<article>{T}<p>One <span class="ad-word">two</span> three bridges were planned at first.</p>{ps(P)}</article>'),
                     [TITLE, "One two three bridges were planned at first.", P]),
    "many kinds of parts": (page(f"""<article>{T}{ps(P)}<p><a href="/x">{S}</a></p><details><summary>Details</summary>{ps(Q)}</details>
        <ul><li>steel</li><li>concrete and stone</li></ul>{ps(R)}</article>"""), [TITLE, P, S, "Details", Q, "steel", "concrete and stone", R]),
    "math": (page(f"<article>{T}{ps(P)}<p>The span is <math><mi>x</mi><mo>+</mo><mn>2</mn></math> metres long.</p>{ps(Q)}</article>"), [TITLE, P, "The span is x+2 metres long.", Q]),
    "columns": (page(f'<div class="container"><div class="row"><div class="col-md-8"><article>{T}{ps(P, Q, R)}</article></div></div></div>'), [TITLE, P, Q, R]),
    "blog post": (page(f'<div id="main"><div class="post"><h2 class="entry-title">{TITLE}</h2><div class="entry-content">{ps(P, Q, R)}</div></div></div>'), [TITLE, P, Q, R]),
    "news with figure": (page(f'<article><header>{T}</header><figure><img src="x"><figcaption>The old bridge in 1950.</figcaption></figure>{ps(P, Q)}</article>'),
                         [TITLE, "The old bridge in 1950.", P, Q]),
    "nested divs": (page(f"<div><div><div><article><div><div>{T}{ps(P, Q)}</div></div></article></div></div></div>"), [TITLE, P, Q]),
    "main, divs": (page(f'<main id="main"><div class="inner"><div class="content">{T}{ps(P, Q, R)}</div></div></main>'), [TITLE, P, Q, R]),
    "advert inside": (page(f"<article>{T}{ps(P)}{AD}{ps(Q)}</article>"), [TITLE, P, Q]),
    "newsletter inside": (page(f'<article>{T}{ps(P)}<div class="newsletter-signup"><p>Get our letter every week.</p><input></div>{ps(Q, R)}</article>'), [TITLE, P, Q, R]),
    "share bar inside": (page(f'<article>{T}<div class="share-buttons"><a href="#">Post</a><a href="#">Mail</a></div>{ps(P, Q)}</article>'), [TITLE, P, Q]),
    "quote": (page(f"<article>{T}{ps(P)}<blockquote><p>{Q}</p></blockquote>{ps(R)}</article>"), [TITLE, P, Q, R]),
    "table": (page(f"<article>{T}{ps(P)}<table><tr><th>Year</th><th>Cost in millions</th></tr><tr><td>2020</td><td>14</td></tr></table>{ps(Q)}</article>"),
              [TITLE, P, "Year", "Cost in millions", "2020", "14", Q]),
    "code": (page(f'<article>{T}{ps(P)}<pre><code class="language-python">print(1)</code></pre>{ps(Q)}</article>'), [TITLE, P, "print(1)", Q]),
    "numbered list": (page(f"<article>{T}{ps(P)}<ol><li>{Q}</li><li>{R}</li></ol></article>"), [TITLE, P, Q, R]),
    "definition list": (page(f"<article>{T}{ps(P)}<dl><dt>Pier</dt><dd>{Q}</dd></dl>{ps(R)}</article>"), [TITLE, P, "Pier", Q, R]),
    "short paragraphs": (page(f"<article>{T}{ps(P, SHORT, Q, SHORT, R)}</article>"), [TITLE, P, SHORT, Q, SHORT, R]),
    "lead and classes": (page(f'<article>{T}<p class="lead">{P}</p><p class="has-drop-cap">{Q}</p><p class="wp-block-paragraph">{R}</p></article>'), [TITLE, P, Q, R]),
    "sections with ids": (page(f'<main><h1>{TITLE}</h1><section id="intro">{ps(P)}</section><section id="results"><h2>Results</h2>{ps(Q, R)}</section></main>'),
                          [TITLE, P, "Results", Q, R]),
    "documentation": (page(f'<div class="document"><div class="body" role="main"><section id="bridge"><h1>{TITLE}</h1>{ps(P)}<section id="use"><h2>Use</h2>{ps(Q)}</section></section></div></div>'),
                      [TITLE, P, "Use", Q]),
    "cards of one article": (page(f'<main>{T}<div class="card"><h2>Plans</h2>{ps(P)}</div><div class="card"><h2>Costs</h2>{ps(Q)}</div></main>'), [TITLE, "Plans", P, "Costs", Q]),
    "rows inside": (page(f'<article>{T}<div class="row"><div class="column">{ps(P)}</div><div class="column">{ps(Q)}</div></div>{ps(R)}</article>'), [TITLE, P, Q, R]),
    "bare paragraphs": (page(f"{T}{ps(P, Q, R)}"), [TITLE, P, Q, R]),
    "text in divs": (page(f"<article>{T}<div>{P}</div><div>{Q}</div></article>"), [TITLE, P, Q]),
    "old table layout": (page(f"<table><tr><td>{MENU}</td><td><h1>{TITLE}</h1>{ps(P, Q, R)}</td></tr></table>"), [TITLE, P, Q, R]),
    "line breaks": (page(f"<article>{T}<p>{P}<br><br>{Q}</p></article>"), [TITLE, P + " " + Q]),
    "emphasis and links": (page(f'<article>{T}<p><em>{R}</em></p><p>{P} See <a href="/y">the plans</a> for more.</p><p><strong>{Q}</strong></p></article>'),
                           [TITLE, R, P + " See the plans for more.", Q]),
    "menu above, nothing else": (page(f"{MENU}<article>{T}{ps(P, Q)}</article>", around=False), [TITLE, P, Q]),
    "medium style": (page(f'<div id="root"><div class="s t u"><article><div class="l m"><section><div class="n o p">{T}{ps(P, Q, R)}</div></section></div></article></div></div>'),
                     [TITLE, P, Q, R]),
    "itemprop": (page(f'<div itemscope><h1 itemprop="headline">{TITLE}</h1><div itemprop="articleBody">{ps(P, Q)}</div></div>'), [TITLE, P, Q]),
    "question page": (page(f'<main><div class="question"><h1>{TITLE}</h1>{ps(P)}</div><div class="answer">{ps(Q, R)}</div></main>'), [TITLE, P, Q, R]),
}
