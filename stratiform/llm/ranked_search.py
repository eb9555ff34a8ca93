"""Ranked lexical search with K2-treaps over the term-document grid.

Rows of the grid are the terms of the items, columns the documents, and a point is the impact of a term
in a document (the part of its score that the item doesn't weigh). A K2-treap is a quadtree over such
a grid, its non-empty cells in level order: for each cell four bits that tell which quarters have points,
the number of bits before it (the j-th bit of all is the j-th cell below the root), and the largest
impact within.

All documents are indexed, in shards of SHARD_ROWS neighbours of a task, with their columns in
the order of doc_id. The rows of an item's terms descend jointly: a document range stands with one cell
for each term, and the weighed sum of their maxima bounds the score of all its documents. The ranges with
the highest bounds are opened first, LANES at a time; those below the item's worst kept score are dropped.
At the last level a range is one document, and its bound is its score. A task hands on its best
documents of each item, so that few rows are shuffled.

Two passes over the documents: the statistics (N, L, df of the items' terms), then index and search.
Items are read in blocks of at most BLOCK_BYTES; a block's terms and weights are broadcast under that bound.

Defined cases. Null text or text without terms: no terms, never returned. Rows without doc_id count
in the statistics and are never returned. Repeated rows are documents of their own and take a rank each.
Rows of items with the same id are one item with the terms of all; items that are null or have no terms
return nothing. Empty tables: no rows. Equal scores stand in the order of doc_id. Very long
texts only make a larger slice. Other columns are not read. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.tables import in_arrow, table
from stratiform.llm.texts import LOWER, Lookup, flat, hash_spans, slices, words

TOP = 50
SHARD_ROWS = 8192
SHARD_POINTS = 4_000_000
BLOCK_BYTES = 4 << 20
#: Ranges opened at once.
LANES = 256
#: Groups of documents whose best are found before those of an item meet.
GROUPS = 64

_TERM_BYTES = np.where([c >= 128 or (chr(c).isalnum() and c < 128) for c in range(256)], LOWER, 0x20).astype(np.uint8)
_ONES = np.array([[bin(n & ((1 << q) - 1)).count("1") for q in range(4)] for n in range(16)], np.int32)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each term of each text, and the bounds of the rows."""
    data, bounds = flat(column)
    data = _TERM_BYTES[data]
    starts, ends, first = words(data, bounds)
    return hash_spans(data, starts, ends), first


def _interleaved(rows: np.ndarray, columns: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(rows), np.int64)
    for k in range(bits):
        out |= (rows >> k & 1) << (2 * k + 1) | (columns >> k & 1) << 2 * k
    return out


class K2Treap:
    """Points (row, column, value > 0) of a square grid of 2 ** height rows; cell 0 is empty, cell 1 the root."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int):
        self.height = height
        code = _interleaved(rows.astype(np.int64), columns.astype(np.int64), height)
        order = np.argsort(code, kind="stable")
        code, value = code[order], values[order].astype(np.int32)
        levels = []
        for level in range(height, -1, -1):  # from the points to the root
            levels.append((code, value))
            if level and len(code):
                start = np.flatnonzero(np.concatenate([[True], code[1:] >> 2 != code[:-1] >> 2]))
                code, value = code[start] >> 2, np.maximum.reduceat(value, start)
        levels.reverse()
        quarters = [np.zeros(1, np.uint8)]
        for (above, _), (below, _) in zip(levels, levels[1:], strict=False):
            found = np.zeros(len(above), np.uint8)
            np.bitwise_or.at(found, np.searchsorted(above, below >> 2), np.uint8(1) << (below & 3).astype(np.uint8))
            quarters.append(found)
        quarters.append(np.zeros(len(levels[-1][0]), np.uint8))
        self.bits = np.concatenate(quarters)
        self.most = np.concatenate([np.zeros(1, np.int32), *(v for _, v in levels)])
        count = _ONES[self.bits, 3] + (self.bits >> 3)
        self.before = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int32) + 2

    def quarter(self, cells: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The cells of quarter ``q`` (2 * row bit + column bit) of ``cells``; 0 if it has no points."""
        bits = self.bits[cells]
        return np.where(bits >> q & 1, self.before[cells] + _ONES[bits, q], 0)

    def best(self, rows: np.ndarray, weights: np.ndarray, top: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) with the ``top`` highest weighed sums over ``rows``, of at least ``least``; with all
        columns that tie with the last one, in no order."""
        none = np.zeros(0, np.int64)
        if len(self.bits) < 2 or not len(rows):
            return none, none
        cells = np.ones((1, len(rows)), np.int32)
        bound, column, level = self.most[cells] @ weights, np.zeros(1, np.int64), np.zeros(1, np.int64)
        found_columns, found = none, none
        while len(bound):
            keep = bound >= least
            bound, column, level, cells = bound[keep], column[keep], level[keep], cells[keep]
            if len(bound) > LANES:
                order = np.argpartition(-bound, LANES)
                now, later = order[:LANES], order[LANES:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            whole = level[now] == self.height
            if whole.any():
                found_columns = np.concatenate([found_columns, column[now[whole]]])
                found = np.concatenate([found, bound[now[whole]]])
                if len(found) >= top:
                    least = max(least, int(np.partition(found, len(found) - top)[len(found) - top]))
                    found_columns, found = found_columns[found >= least], found[found >= least]
                now = now[~whole]
            shift = self.height - 1 - level[now]
            up = (rows[None, :] >> shift[:, None] & 1) << 1
            opened = [self.quarter(cells[now], up | bit) for bit in (0, 1)]
            new = np.concatenate(opened).astype(np.int32)
            column = np.concatenate([column[later], column[now] << 1, column[now] << 1 | 1])
            level = np.concatenate([level[later], level[now] + 1, level[now] + 1])
            bound = np.concatenate([bound[later], self.most[new] @ weights])
            cells = np.concatenate([cells[later], new])
        return found_columns, found


class Query:
    """The items of a block: their terms as rows of the grid."""

    def __init__(self, items: dict[int, set[bytes]]):
        spelled = sorted(set().union(*items.values())) if items else []
        data = np.frombuffer(b"".join(spelled), np.uint8)
        ends = np.cumsum([len(t) for t in spelled], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if spelled else ends
        self.codes = hash_spans(data, starts, ends) if spelled else np.zeros(0, np.uint64)
        place = {t: k for k, t in enumerate(spelled)}
        self.items = {i: np.array(sorted(place[t] for t in found), np.int64) for i, found in items.items()}


def item_terms(text: str | None) -> set[bytes]:
    return set(_TERM_BYTES[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split())


def _statistics(held):
    """(term, n): documents that hold each term of the block; behind them the number of documents with
    a term and of all their terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = held.value.codes
        find, size = Lookup(codes), len(codes)
        total = np.zeros(size + 2, np.int64)
        for part in slices(batches, "text"):
            hashes, first = terms(part.column("text"))
            n = np.diff(first)
            term = find.find(hashes).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)[term >= 0]
            total[:size] += np.bincount(np.unique(row * size + term[term >= 0]) % max(1, size), minlength=size)
            total[size] += (n > 0).sum()
            total[size + 1] += n.sum()
        yield pa.record_batch([np.arange(size + 2), total], names=["term", "n"])

    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 100 - 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _search(held, weights: np.ndarray, documents: int, length: int, top: int):
    """(item_id, doc_id, score): the best documents of a task for each item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = held.value
        size = len(query.codes)
        order = np.argsort(weights, kind="stable")  # terms of like weight share cells
        row_of = np.empty(size, np.int64)
        row_of[order] = np.arange(size)
        find = Lookup(query.codes)
        best = {i: (np.zeros(0, np.int64), np.zeros(0, np.int64), 1) for i in query.items}
        shard: list[tuple[np.ndarray, ...]] = []

        def searched() -> None:
            ids = np.concatenate([s[0] for s in shard])
            at = np.cumsum([0, *(len(s[0]) for s in shard)])
            place = np.empty(len(ids), np.int64)
            place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
            columns = place[np.concatenate([s[1] + k for s, k in zip(shard, at, strict=False)])]
            rows, values = (np.concatenate([s[k] for s in shard]) for k in (2, 3))
            ids.sort()
            treap = K2Treap(rows, columns, values, max(1, int(max(size, len(ids)) - 1).bit_length()))
            for item, found in query.items.items():
                docs, scores, least = best[item]
                more, new = treap.best(row_of[found], weights[found], top, least)
                if len(more):
                    docs, scores = np.concatenate([docs, ids[more]]), np.concatenate([scores, new])
                    first = np.lexsort((docs, -scores))[:top]
                    docs, scores = docs[first], scores[first]
                    best[item] = docs, scores, int(scores[-1]) if len(scores) == top else 1
            shard.clear()

        for part in slices(batches, "text"):
            hashes, first = terms(part.column("text"))
            n = np.diff(first)
            term = find.find(hashes).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)[term >= 0]
            point, tf = np.unique(row * size + term[term >= 0], return_counts=True)
            row, term = np.divmod(point, max(1, size))
            value = impacts(tf, n[row], documents, length)
            shard.append((part.column("doc_id").to_numpy().astype(np.int64), row, row_of[term], value))
            if sum(len(s[0]) for s in shard) >= SHARD_ROWS or sum(len(s[1]) for s in shard) >= SHARD_POINTS:
                searched()
        if shard:
            searched()
        full = [(i, *found[:2]) for i, found in best.items() if len(found[0])]
        if full:
            columns = [np.concatenate([np.full(len(d), i) for i, d, _ in full]), *(np.concatenate([f[k] for f in full]) for k in (1, 2))]
            yield pa.record_batch(columns, names=["item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[dict[int, set[bytes]]]:
    """The items' terms in as many parts as their size asks for; all rows of an item are in one."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    for k in range(count):
        found: dict[int, set[bytes]] = defaultdict(set)
        for r in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).toLocalIterator():
            found[r["item_id"]] |= item_terms(r["text"])
        yield {i: t for i, t in found.items() if t}


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    schema = "item_id long, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(items):
        query = Query(block)
        held, size = spark.sparkContext.broadcast(query), len(query.codes)
        counted = in_arrow(docs.select("text"), _statistics(held), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        n = np.zeros(size + 2, np.int64)
        for r in counted.collect():  # one row for each term of the block
            n[r["term"]] = r["n"]
        documents, length = int(n[size]), int(n[size + 1])
        if not documents:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in n[:size]], np.int64)
        known = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        out = out.unionByName(in_arrow(known, _search(held, weights, documents, length, top), schema))
    first = (F.desc("score"), F.asc("doc_id"))
    grouped = out.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
    grouped = grouped.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "group").orderBy(*first))).filter(F.col("rank") <= top)
    ranks = grouped.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*first)))
    return ranks.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def oracle_sql() -> str:
    found = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH found AS (SELECT doc_id, {found} AS t FROM documents),
        total AS (SELECT count(*) AS documents, sum(len(t))::BIGINT AS length FROM found WHERE len(t) > 0),
        asked AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
        points AS (
            SELECT doc_id, len(t) AS n, term, count(*) AS tf
            FROM (SELECT doc_id, t, unnest(t) AS term FROM found) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM points, total GROUP BY term
        ),
        scores AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // length))))::BIGINT AS score
            FROM asked JOIN points USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id
        ),
        ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50
    """
