"""Labelled pages that the extraction model learns from, written by a small grammar.

Pages differ in the element that holds the article, in what stands around and inside it, and in the
length of their texts. ``data-content`` marks where an element's subtree begins to be content
("yes") or something else ("no"); everything else has the label of its parent.
"""

from __future__ import annotations

from random import Random

#: Elements that hold articles; the empty one leaves the blocks in the page itself, whose body then is the article.
HOLDERS = [
    "article", "article", "article", "article", "main", "main", "div class=content", "div id=main-content", "section class=post", "div class=entry-content",
    "div class=article-body", "article class=post", "div role=main", "div itemprop=articleBody", "div class=story",
    "section id=article", "div class=text", "div class=page-body", "div", "article class=entry", *[""] * 8,
]
#: Parts inside articles that hold some of their blocks.
PARTS = [
    "section", "section", "section", "div", "div", "div", "div class=section", "div class=group", "div class=block", "div class=row", "div class=column",
    "div class=card", "section class=chapter", "div class=body", "div class=inner", "div class=paragraph", "div class=part", "section id=intro",
    "div class=answer", "div class=question", "div class=columns", "div class=s", "section class=block", "div id=x", "section id=results",
]
#: Words that blocks of an article carry now and then, though things around articles have them too.
CLASSES = [
    "lead", "intro", "first", "text", "paragraph", "social", "related", "note", "caption", "has-background", "share", "comment", "footer", "search",
    "links", "tags", "legal", "notice", "header", "reply", "subscribe",
]
#: Elements around them that say nothing.
WRAPPERS = ["div", "div class=wrapper", "div id=page", "div class=container", "div class=row", "div class=column", "section", "div class=inner"]
#: Kinds of things that aren't the article: menus, headers, footers, sidebars, notices, adverts, forms, comments.
LISTS = [
    "nav", "ul class=menu", "div class=nav", "div id=navigation", "ol class=breadcrumb", "div class=breadcrumbs",
    "div class=pagination", "div class=share", "div class=social", "ul class=tags", "div class=toolbar", "aside class=related",
    "div class=recommended", "div class=widget", "div class=links", "nav class=toc", "div role=navigation", "ul id=menu",
]
BOXES = [
    "header", "header class=site-header", "div class=masthead", "div id=header", "div class=banner", "footer", "footer class=site-footer",
    "div id=footer", "div class=footer", "div class=copyright", "div class=legal", "aside", "aside class=sidebar", "div class=sidebar",
    "div id=sidebar", "div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div class=sponsored", "div class=promo",
    "div class=notice", "div class=cookie-notice", "div id=cookie-banner", "div class=consent", "div class=popup", "div class=modal",
    "div class=alert", "div class=disclaimer", "div class=newsletter", "div class=subscribe", "div class=login", "div role=banner",
    "div role=contentinfo", "div role=complementary", "section class=cookies", "div class=teaser", "p class=ad", "div role=alert", "dialog",
]
COMMENTS = ["section class=comments", "div id=comments", "div class=comment-list", "div class=comments-area", "div class=discussion", "div class=replies", "div class=responses"]
REPLIES = ["div class=comment", "li class=comment", "div class=reply", "p", "div class=comment-body", "div class=comment", "div class=reply"]
FORMS = ["form", "form class=search", "div class=search", "fieldset", "form id=login", "form class=newsletter"]

_WORDS = "the of a river stone market and under early light people found several years between old water small house when city north".split()


def _tag(spec: str, inside: str, content: str | None = None) -> str:
    name, *attributes = spec.split(" ")
    marks = "".join(f' {k}="{v}"' for k, v in (a.split("=") for a in attributes))
    return f"<{name}{marks}{f' data-content={chr(34)}{content}{chr(34)}' if content else ''}>{inside}</{name}>"


class _Writer:
    def __init__(self, seed: int):
        self.r = Random(seed)

    def words(self, least: int, most: int) -> str:
        """So many words, more often few than many."""
        n = round(least * (most / least) ** self.r.random())
        text = " ".join(self.r.choice(_WORDS) for _ in range(n)).capitalize()
        return text + self.r.choice([".", ".", ".", "?", "", "!", ", and more.", " &amp; more"])

    def link(self) -> str:
        return f'<a href="/x">{self.words(1, 4)}</a>'

    def inline(self, text: str) -> str:
        if self.r.random() < 0.06:  # all of it one element
            kind = self.r.choice(["a href=/x", "em", "strong", "span class=x", "a href=/y"])
            return _tag(kind, text)
        kind = self.r.choice(["", "", "", "b", "em", "a", "span", "br", "strong", "code", "i"])
        if kind == "br":
            return text + "<br>" + self.words(1, 30)
        return text + (f" <{kind}>{self.words(1, 6)}</{kind}> " + self.words(1, 12) if kind else "")

    def listing(self) -> str:
        spec = self.r.choice(LISTS)
        links = [self.link() for _ in range(self.r.randint(1, 8))]
        inside = "".join(f"<li>{x}</li>" for x in links) if self.r.random() < 0.7 else " | ".join(links)
        if not spec.startswith(("ul", "ol")) and "<li>" in inside:
            inside = f"<ul>{inside}</ul>"
        return _tag(spec, (f"<h3>{self.words(1, 3)}</h3>" if self.r.random() < 0.2 else "") + inside, "no")

    def box(self) -> str:
        kind = self.r.random()
        inside = self.words(1, 60)
        if kind < 0.5:
            inside = f"<p>{self.inline(inside)}</p>"
        elif kind < 0.7:
            inside = f"<h2>{self.words(1, 5)}</h2><ul><li>{self.link()}</li><li>{self.link()}</li></ul><p>{inside}</p>"
        elif kind < 0.8:
            inside = f"&copy; {inside} &middot; {self.link()}"
        return _tag(self.r.choice(BOXES), inside, "no")

    def form(self) -> str:
        return _tag(self.r.choice(FORMS), f"<label>{self.words(1, 4)}</label><input><button>{self.words(1, 2)}</button>{self.words(1, 8)}", "no")

    def comments(self) -> str:
        kind = "article class=comment" if self.r.random() < 0.02 else self.r.choice(REPLIES)
        replies = "".join(_tag(kind, f"<p>{self.words(1, 80)}</p>") for _ in range(self.r.randint(1, 5)))
        return _tag(self.r.choice(COMMENTS), f"<h3>{self.words(1, 3)}</h3>" + replies, "no")

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.62:
            spec = "p" if self.r.random() < 0.8 else f"p class={self.r.choice(CLASSES)}"
            return _tag(spec, self.inline(self.words(1, 140)))
        if kind < 0.72:
            return f"<h{(level := self.r.choice('2234'))}>{self.words(1, 9)}</h{level}>"
        if kind < 0.8:
            return "<ul>" + "".join(f"<li>{self.inline(self.words(1, 25))}</li>" for _ in range(self.r.randint(1, 6))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote><p>{self.words(4, 60)}</p></blockquote>"
        if kind < 0.9:
            return f"<figure><img><figcaption>{self.words(2, 15)}</figcaption></figure>"
        if kind < 0.94:
            return f"<table><tr><th>{self.words(1, 3)}</th><td>{self.words(1, 6)}</td></tr></table>"
        if kind < 0.955:
            return f"<dl><dt>{self.words(1, 3)}</dt><dd>{self.words(2, 30)}</dd></dl>"
        if kind < 0.965:
            return f"<details><summary>{self.words(1, 5)}</summary><p>{self.words(3, 60)}</p></details>"
        if kind < 0.98:
            inside = self.words(1, 40)
            return f"<pre>{inside}</pre>" if self.r.random() < 0.5 else f"<pre><code class=x>{inside}</code></pre>"
        return f"<div>{self.words(2, 60)}</div>"

    def parted(self, blocks: list[str], depth: int = 0) -> list[str]:
        """Some of the blocks put into parts, which may hold parts again."""
        out = []
        while blocks:
            n = self.r.randint(1, max(1, len(blocks)))
            some, blocks = blocks[:n], blocks[n:]
            if self.r.random() < 0.7:
                inside = self.parted(some, depth + 1) if depth < 3 and self.r.random() < 0.4 else some
                if self.r.random() < 0.3:
                    inside = [f"<h2>{self.words(1, 6)}</h2>", *inside]
                if self.r.random() < 0.2:
                    inside = [_tag(self.r.choice(["div class=column", "div class=col", "div"]), x) for x in inside]
                    out.append(_tag(self.r.choice(["div class=row", "div class=columns"]), "".join(inside)))
                else:
                    out.append(_tag(self.r.choice(PARTS), "".join(inside)))
            else:
                out += some
        return out

    def page(self) -> str:
        title = f"<h1>{self.words(2, 14)}</h1>"
        if self.r.random() < 0.15:
            title = f"<header>{title}<p>{self.words(2, 10)}</p></header>"
        blocks = [title] * (self.r.random() < 0.85) + [self.block() for _ in range(self.r.randint(1, 12))]
        for make, share in ((self.box, 0.5), (self.box, 0.3), (self.listing, 0.35), (self.comments, 0.2), (self.form, 0.3)):
            if self.r.random() < share:
                blocks.insert(self.r.randint(0, len(blocks)), make())
        holder = self.r.choice(HOLDERS)
        if holder and self.r.random() < 0.45:
            blocks = self.parted(blocks)
        article = _tag(holder, "".join(blocks), "yes") if holder else "".join(blocks)
        around = [self.listing, self.box, self.box, self.form, self.comments]
        before = "".join(self.r.choice(around[:3])() for _ in range(self.r.randint(0, 3)))
        after = "".join(self.r.choice(around)() for _ in range(self.r.randint(0, 4)))
        body = before + article + after
        for _ in range(self.r.randint(0, 2)):
            body = _tag(self.r.choice(WRAPPERS), body)
        return f"<!DOCTYPE html><html><head><title>x</title></head>{_tag('body', body, None if holder else 'yes')}</html>"


def labelled_pages(n: int = 1200, seed: int = 7) -> list[str]:
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]
