"""Main text of web pages by a tree-structured graphical model.

Every element and every run of text of a page is a node with two states, content or not. Elements
speak through their tag and the words of class, id and role, texts through length, links and closing
punctuation of their block. Parent-child potentials couple the states along the tree. One pass of
sum-product messages upward and one downward gives each node's exact marginal; texts whose marginal
reaches one half are kept. All statistics are counted on labelled pages.

Messages run for all pages of a slice at once, one depth after the other.

Text inside a block element becomes a line: references decoded, white space (also from <br>) one
space, trimmed. Kept lines are joined in page order by a line feed.

Defined cases. Null or empty html, or no content found: empty text, 0 characters. Other columns are not read. Broken markup is
read as browsers mostly do: open paragraphs and list items end where the next begins, a head where
something begins that can't stand in it, stray end tags are passed over, a script or style that never ends takes the rest. Repeated rows: equal results.
Pages are read whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.labelled_pages import labelled_pages
from stratiform.llm.tables import beside, table

#: Fixed by HTML: elements without end tag, elements that aren't shown, elements that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style noscript template textarea select iframe object svg canvas audio video button".split())
RAW = frozenset("script style textarea title iframe noscript template xmp noembed noframes".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p pre search section summary "
    "table caption colgroup tbody td tfoot th thead tr ul".split()
)
#: An element ends these where it begins, up to the nearest of the elements that hold them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: What may stand in a head; any other element or text ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes".split())
LANDMARKS = frozenset("nav header footer aside form main article section dialog fieldset search".split())
#: Block elements that hold running text; the words of their classes say less than those of elements around them.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figure figcaption table caption tr td th summary details address center".split())
_KEEPS_P = frozenset("html body table td th caption button object".split())

#: A quoted value may hold < if its quote ends an attribute; otherwise the quote was never closed, and < ends the tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"'<=]|=\s*+(?:\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>])|)|\"[^\"<]*\"|'[^'<]*'|[\"'])*+(?=>)|(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_READ = frozenset("class id role itemprop data-content".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_LENGTHS = (2, 6, 15, 40, 100)


class Pages:
    """Nodes of the trees of several pages, in page order; the parent of a root is -1."""

    def __init__(self):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.key: list[tuple[str, str] | None] = []  # tag and words of an element, None for a text
        self.label: list[str | None] = []
        self.texts: list[tuple[int, int, str, int]] = []  # page, block, text, node
        self.linked: list[bool] = []  # by text
        self.blocks = 0

    def _node(self, parent: int, key: tuple[str, str] | None, label: str | None = None) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.key.append(key)
        self.label.append(label)
        return len(self.parent) - 1

    def read(self, page: int, html: str) -> None:
        root = self._node(-1, ("", ""))
        names, nodes = [""], [root]
        places: dict[str, list[int]] = defaultdict(list)  # of open elements, by name
        blocks: list[int] = []  # places of open block elements
        hidden = links = 0
        at = 0
        self.blocks += 1

        def text(raw: str) -> None:
            if names[-1] == "head" and raw and not raw.isspace():
                close(len(names) - 1)
            if raw and not hidden:
                if not raw.isspace():
                    leaf = self._node(nodes[-1], None)
                    self.linked.append(links > 0)
                else:
                    leaf = -1
                    self.linked.append(False)
                self.texts.append((page, self.blocks, unescape(raw) if "&" in raw else raw, leaf))

        def close(k: int) -> None:
            """End the open elements from the k-th on."""
            nonlocal hidden, links
            for name in names[k:]:
                places[name].pop()
                hidden -= name in HIDDEN
                links -= name == "a"
                if name in BLOCKS:
                    blocks.pop()
                    self.blocks += 1
            del names[k:], nodes[k:]

        def end_implied(which: set[str], holders: frozenset[str] | set[str]) -> None:
            """End the outermost open element of ``which`` within the nearest of ``holders``."""
            if any(places[w] for w in which):
                holder = max((places[h][-1] for h in holders if places[h]), default=0)
                inside = [p[i] for w in which if (i := bisect_right(p := places[w], holder)) < len(p)]
                if inside:
                    close(min(inside))

        while token := _TOKEN.search(html, at):
            text(html[at : token.start()])
            at = token.end()
            name = token["name"]
            if name is None:
                continue
            name = name.lower()
            if token["end"]:
                k = places[name][-1] if places[name] else 0
                if k and (name in BLOCKS or k > (blocks[-1] if blocks else 0)):
                    close(k)
                continue
            if names[-1] == "head" and name not in _IN_HEAD:
                close(len(names) - 1)
            if name in BLOCKS:
                if name in _ENDS:
                    end_implied(*_ENDS[name])
                elif name != "html":
                    end_implied({"p"}, _KEEPS_P)
                self.blocks += 1
            elif name in _ENDS:
                end_implied(*_ENDS[name])
            if name == "br":
                text(" ")
            if name in VOID:
                continue
            words, label = "", None
            if "=" in token["rest"]:
                said = {key: m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(token["rest"]) if (key := m[1].lower()) in _READ}
                label = said.pop("data-content", None)
                words = " ".join(said.values())
            places[name].append(len(names))
            if name in BLOCKS:
                blocks.append(len(names))
            names.append(name)
            nodes.append(self._node(nodes[-1], (name, words), label))
            hidden += name in HIDDEN
            links += name == "a"
            if name in RAW:
                found = _RAW_END[name].search(html, at)
                at = found.start() if found else len(html)
        text(html[at:])

    def block_features(self) -> dict[int, tuple[tuple[str, ...], float]]:
        """For each text node the features of its block, and its own share of them."""
        words, linked = Counter(), Counter()
        last: dict[int, str] = {}
        for (_, block, raw, leaf), link in zip(self.texts, self.linked, strict=True):
            if leaf >= 0:
                n = raw.count(" ") + 1
                words[block] += n
                linked[block] += n * link
                last[block] = raw
        out = {}
        for _, block, raw, leaf in self.texts:
            if leaf >= 0:
                n = words[block]
                length = sum(n > x for x in _LENGTHS)
                ends = last[block].rstrip()[-1:]
                features = (f"length {length}", f"links {round(3 * linked[block] / n)}", f"ends {'.' if ends in '.?!:;' else ','}")
                out[leaf] = features, (raw.count(" ") + 1) / n
        return out


def _kind(key: tuple[str, str] | None) -> int:
    """Which potentials couple a node to its parent: a plain element's, a text's or a named element's."""
    if key is None:
        return 1
    return 2 if key[0] in LANDMARKS or (key[1] and key[0] in BLOCKS and key[0] not in RUNNING) else 0


def _element_features(key: tuple[str, str]) -> list[str]:
    tag, words = key
    if tag not in BLOCKS:
        return [f"tag {tag}"]  # a word in a line doesn't make it another line
    kind = "block" if tag in RUNNING else "word"
    return [f"tag {tag}", *sorted({f"{kind} {w.lower()}" for w in _WORD.findall(words)})]


class Extractor:
    """Potentials counted on labelled pages."""

    def __init__(self, labelled: list[str], alpha: float = 0.5, most: float = 6.0):
        pages = Pages()
        for k, html in enumerate(labelled):
            pages.read(k, html)
        state: list[int] = []
        for parent, label in zip(pages.parent, pages.label, strict=True):
            state.append({"yes": 1, "no": 0}.get(label, state[parent] if parent >= 0 else 0))
        of_block = pages.block_features()
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        total = np.zeros((2, 2))  # element or text, state
        moves = np.full((3, 2, 2), 1.0)  # kind of the child, state of the parent, of the child
        for k, key in enumerate(pages.key):
            leaf = key is None
            total[int(leaf), state[k]] += 1
            for feature in of_block[k][0] if leaf else _element_features(key):
                seen[state[k]][feature] += 1
            if pages.parent[k] >= 0:
                moves[_kind(key), state[pages.parent[k]], state[k]] += 1
        self.log_odds = {}
        for feature in seen[0] | seen[1]:
            kind = int(feature.split(" ")[0] in ("length", "links", "ends"))
            odds = [(seen[s][feature] + alpha) / (total[kind, s] + 2 * alpha) for s in (0, 1)]
            self.log_odds[feature] = float(np.clip(np.log(odds[1] / odds[0]), -most, most))
        self.moves = moves / moves.sum(axis=2, keepdims=True)
        self.known: dict[tuple[str, str], float] = {}

    def _of_element(self, key: tuple[str, str]) -> float:
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[key] = sum(self.log_odds.get(f, 0.0) for f in _element_features(key))
        return found

    def marginals(self, pages: Pages) -> np.ndarray:
        """The probability of content of every node."""
        own = np.array([0.0 if key is None else self._of_element(key) for key in pages.key])
        for leaf, (features, share) in pages.block_features().items():
            own[leaf] = share * sum(self.log_odds.get(f, 0.0) for f in features)
        parent, depth = np.array(pages.parent, np.int64), np.array(pages.depth, np.int64)
        move = self.moves[[_kind(key) for key in pages.key]]
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        if 15 * len(levels) > len(own):  # deep and narrow: one node after the other is faster
            return self._one_by_one(own, parent, move)

        up = own.copy()  # log odds of what stands at and below a node
        sent = np.zeros(len(own))
        for level in reversed(levels[1:]):
            odds = np.exp(np.clip(up[level], -50, 50))
            m = move[level]
            sent[level] = np.log((m[:, 1, 1] * odds + m[:, 1, 0]) / (m[:, 0, 1] * odds + m[:, 0, 0]))
            np.add.at(up, parent[level], sent[level])
        belief = up
        for level in levels[1:]:
            odds = np.exp(np.clip(belief[parent[level]] - sent[level], -50, 50))
            m = move[level]
            belief[level] += np.log((m[:, 1, 1] * odds + m[:, 0, 1]) / (m[:, 1, 0] * odds + m[:, 0, 0]))
        return 1 / (1 + np.exp(-np.clip(belief, -50, 50)))

    @staticmethod
    def _one_by_one(own: np.ndarray, parent: np.ndarray, move: np.ndarray) -> np.ndarray:
        """The same messages node by node; parents stand before their children."""
        exp, log = math.exp, math.log
        up, above, sent, moves = own.tolist(), parent.tolist(), [0.0] * len(own), move.tolist()
        for k in range(len(up) - 1, -1, -1):
            if above[k] >= 0:
                odds = exp(min(50.0, max(-50.0, up[k])))
                (same, gain), (loss, stay) = moves[k]
                sent[k] = log((stay * odds + loss) / (gain * odds + same))
                up[above[k]] += sent[k]
        for k in range(len(up)):
            if above[k] >= 0:
                odds = exp(min(50.0, max(-50.0, up[above[k]] - sent[k])))
                (same, gain), (loss, stay) = moves[k]
                up[k] += log((stay * odds + gain) / (loss * odds + same))
        return 1 / (1 + np.exp(-np.clip(np.array(up), -50, 50)))

    def extract(self, htmls: list[str | None]) -> list[str]:
        """The main text of each page."""
        pages = Pages()
        for k, html in enumerate(htmls):
            if html:
                pages.read(k, html)
        lines: list[list[str]] = [[] for _ in htmls]
        if pages.parent:
            kept = self.marginals(pages) >= 0.5
            block, held, of = -1, [], 0
            for page, b, raw, leaf in [*pages.texts, (0, -1, "", -1)]:
                if b != block:
                    if line := " ".join("".join(held).split()):
                        lines[of].append(line)
                    block, held, of = b, [], page
                if leaf < 0 or kept[leaf]:
                    held.append(raw)
        return ["\n".join(x) for x in lines]


def _extractor(model):
    def make():
        extractor = model.value

        def compute(part: pa.RecordBatch) -> list:
            texts = extractor.extract(part.column("text").to_pylist())
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return compute

    return make


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    model = pages.sparkSession.sparkContext.broadcast(Extractor(labelled_pages()))
    given = pages.select("page_id", "url", F.col("html").alias("text"))
    added = {"main_text": "string", "n_chars": "bigint"}
    return beside(given, _extractor(model), added, ["page_id", "url"]).withColumnRenamed("main_text", "text").select("page_id", "url", "text", "n_chars")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
