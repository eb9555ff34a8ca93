"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to one error (character changed, missing or added) for every
ERROR_EVERY bytes of its normalised text. Cut into one piece more than it may have errors, at least
one piece of such an occurrence is untouched. An automaton finds all exact piece hits in one pass
over the document; stretches around hits are verified with Myers' bit-parallel edit distance.

Texts are compared as lower-case ASCII letters, digits and non-ASCII bytes, one space between words.
Items are read in blocks of at most BLOCK_BYTES, whatever their number; each block is broadcast and
passes over the documents in turn, without a shuffle.

Defined cases. Kept columns may have any name that doesn't begin with __items or __distances. Null or empty text: clean. Items that are null or without words: never found. Items
under SHORT bytes take no errors and have to stand between word bounds; unless ``quoted`` is set, as
the query and the pipeline do, they only match a whole document. Repeated items and
rows: the same result for each. Documents are searched whole; overlapping stretches are verified
once, so the work stays linear in a document's length.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.tables import beside, table

ERROR_EVERY = 20
SHORT = 24
BLOCK_BYTES = 4 << 20

_WORDS = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256)).lower()


def normalised(text: str | None) -> str:
    """Words of a text, its UTF-8 bytes one character each."""
    return b" ".join((text or "").encode().translate(_WORDS).split()).decode("latin-1")


def least_distance(masks: dict[str, int], size: int, text: str) -> int:
    """The smallest edit distance of a pattern to any stretch of ``text``; ``masks`` has for each
    character the bits of its places in the pattern of ``size`` characters."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best = full, 0, size, size
    for c in text:
        eq = masks.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        up = (minus | ~(across | plus)) & full
        down = plus & across
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best = score
        up, down = (up << 1) & full, (down << 1) & full
        eq |= minus
        plus = (down | ~(eq | up)) & full
        minus = up & eq
    return best


class Matcher:
    """Finds items in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], error_every: int = ERROR_EVERY, quoted: bool = False):
        self.patterns: list[tuple[int, str, int]] = []
        self.whole: dict[str, list[int]] = defaultdict(list)
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in sorted(set(items)):
            if not text:
                continue
            if len(text) < SHORT:
                self.whole[text].append(item_id)
                continue
            errors = len(text) // error_every
            cuts = [len(text) * k // (errors + 1) for k in range(errors + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces[text[a:b]].append((len(self.patterns), a))
            self.patterns.append((item_id, text, errors))
        self.automaton = ahocorasick.Automaton()
        short = self.whole if quoted else {}
        for piece in pieces.keys() | short.keys():
            self.automaton.add_word(piece, (len(piece), pieces.get(piece, ()), short.get(piece)))
        if pieces or short:
            self.automaton.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}

    def _masks(self, k: int) -> dict[str, int]:
        if k not in self.masks:
            found: dict[str, int] = defaultdict(int)
            for i, c in enumerate(self.patterns[k][1]):
                found[c] |= 1 << i
            self.masks[k] = dict(found)
        return self.masks[k]

    def find(self, text: str) -> dict[int, int]:
        """The items in a normalised text, with their least distances."""
        found = dict.fromkeys(self.whole.get(text, ()), 0)
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        if len(self.automaton):
            for last, (length, places, short) in self.automaton.iter(text):
                begin = last + 1 - length
                if short and (begin == 0 or text[begin - 1] == " ") and (last + 1 == len(text) or text[last + 1] == " "):
                    found.update(dict.fromkeys(short, 0))
                for k, offset in places:
                    _, pattern, errors = self.patterns[k]
                    a = max(0, begin - offset - errors)
                    b = begin - offset + len(pattern) + errors
                    runs = stretches[k]
                    # the end of hits grows, but their offsets differ: put them in order below
                    if runs and runs[-1][0] <= a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
        for k, runs in stretches.items():
            item_id, pattern, errors = self.patterns[k]
            runs.sort()
            merged = runs[:1]
            for a, b in runs[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            parts = [text[a:b] for a, b in merged]
            if any(pattern in part for part in parts):
                found[item_id] = 0
                continue
            least = min(least_distance(self._masks(k), len(pattern), part) for part in parts)
            if least <= errors:
                found[item_id] = min(least, found.get(item_id, least))
        return found


_matchers: dict[int, Matcher] = {}


def _matcher(name: int, items, quoted: bool) -> Matcher:
    """Built once by each Python worker, and kept until a task needs another."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(items.value, quoted=quoted)
    return _matchers[name]


def _search(block, name: int, quoted: bool):
    """Lists of the items of a block that each text holds, and their distances."""

    def make():
        find = _matcher(name, block, quoted).find

        def compute(part: pa.RecordBatch) -> list:
            found = [sorted(find(normalised(text)).items()) for text in part.column("text").to_pylist()]
            items = pa.array([[i for i, _ in row] for row in found], pa.list_(pa.int64()))
            return [items, pa.array([[d for _, d in row] for row in found], pa.list_(pa.int32()))]

        return compute

    return make


def _blocks(items: DataFrame) -> list[DataFrame]:
    """The items in as many parts as their size asks for."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def contaminations(docs: DataFrame, items: DataFrame, keep: list[str] | None = None, quoted: bool = False) -> DataFrame:
    """Columns ``keep`` (doc_id) of every row of ``docs``, with __items (ids, ascending) and __distances
    of the items in its text."""
    context = docs.sparkSession.sparkContext
    keep = keep or ["doc_id"]
    out, lists = docs, []
    for k, block in enumerate(_blocks(items)):
        texts = [(r["item_id"], normalised(r["text"])) for r in block.toLocalIterator()]
        held = context.broadcast(texts)
        added = {f"__items_{k}": "array<bigint>", f"__distances_{k}": "array<int>"}
        passed = [c for c in out.columns if c in keep or c == "text" or c.startswith("__items_") or c.startswith("__distances_")]
        out = beside(out, _search(held, held._jbroadcast.id(), quoted), added, passed)
        lists.append(added)
    ids = F.concat(F.array().cast("array<bigint>"), *(F.col(f"__items_{k}") for k in range(len(lists))))
    far = F.concat(F.array().cast("array<int>"), *(F.col(f"__distances_{k}") for k in range(len(lists))))
    return out.select(*(f"`{c}`" for c in keep), F.array_sort(F.array_distinct(ids)).alias("__items"), far.alias("__distances"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids and the least distance (null if clean) of each document."""
    found = contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), quoted=True)
    return found.select(
        "doc_id",
        (F.size("__items") > 0).alias("contaminated"),
        F.size("__items").cast("long").alias("n_items"),
        F.col("__items").alias("item_ids"),
        F.array_min("__distances").alias("least_distance"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that hold no item of the benchmark."""
    found = contaminations(docs, table(spark, sf_dir, "benchmark"), docs.columns, quoted=True)
    return found.filter(F.size("__items") == 0).select(*docs.columns)
