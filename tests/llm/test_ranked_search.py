from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect

from stratiform.llm import ranked_search as R
from stratiform.llm.queries import QUERIES, SQL

from .conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    counts = [(i, Counter(found(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(found(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in counts:
            if i is None or not c:
                continue
            m = 100 - 50 + 50 * c.total() * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "shard"), [(1, 8192), (2, 7)])
def test_ranks_equal_brute_force(spark, make_docs, monkeypatch, seed, shard):
    monkeypatch.setattr(R, "SHARD_ROWS", shard)
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "日本", "x-y", "A_b"]
    docs = [(i, prose(seed * 1000 + i, r.choice([1, 3, 10, 80]), words).upper()) for i in range(150)]
    docs += [(200 + i, docs[i][1]) for i in range(30)]  # ties
    docs += [(i, docs[i][1]) for i in range(5)]  # repeated rows
    docs += [(None, "w1 w2 w3"), (300, None), (301, ""), (302, "?! --")]
    items = [(i, prose(i, r.choice([1, 4, 12]), words)) for i in range(20)]
    items += [(3, "w7 w8"), (50, None), (51, "..."), (52, "unheard of"), (None, "w1")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = R.ranked(make_docs(docs), asked, 10)
    assert sorted(map(tuple, rows.collect())) == brute(docs, items, 10)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]


def test_items_in_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 40)
    docs = [(i, prose(i, 30)) for i in range(40)]
    items = [(i, prose(100 + i, 5)) for i in range(9)]
    rows = R.ranked(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"), 5)
    assert sorted(map(tuple, rows.collect())) == brute(docs, items, 5)


def test_awkward_tables(spark, make_docs, awkward):
    items = spark.createDataFrame([(1, "river stone"), (2, "日本語")], "item_id long, text string")
    rows = [(x["doc_id"], x["text"]) for x in awkward.collect()]
    assert sorted(map(tuple, R.ranked(awkward, items).collect())) == brute(rows, [(1, "river stone"), (2, "日本語")], 50)
    assert R.ranked(make_docs([]), items).count() == 0
    assert R.ranked(make_docs([(1, None)]), items).count() == 0
    assert R.ranked(awkward, items.limit(0)).count() == 0


def test_treap_opens_few_cells():
    r = np.random.default_rng(3)
    code = np.unique(r.integers(0, 1 << 20, 60_000))
    rows, columns, values = code >> 10, code & 1023, r.integers(1, 1000, len(code))
    treap = R.K2Treap(rows, columns, values, 10)
    grid = np.zeros((1024, 1024), np.int64)
    grid[rows, columns] = values
    opened = []
    quarter = treap.quarter
    treap.quarter = lambda cells, q: (opened.append(len(cells)), quarter(cells, q))[1]
    for trial in range(20):
        asked, weights = r.choice(1024, 6, replace=False), r.integers(0, 50, 6)
        got, scores = treap.best(asked, weights, 10)
        total = weights @ grid[asked]
        least = max(1, np.sort(total)[-10])
        assert dict(zip(got.tolist(), scores.tolist(), strict=True)) == {int(k): int(total[k]) for k in np.flatnonzero(total >= least)}
    assert sum(opened) / 40 < 2047
    empty = R.K2Treap(rows[:0], columns[:0], values[:0], 3)
    assert not len(empty.best(np.array([1]), np.array([1]), 5)[0])


def test_query_equals_sql_on_other_rows(spark):
    got, _, problems = compare(QUERIES["op11_ranked_search"](spark, "/root/testdata/sf0.01"), connect("/root/testdata/sf0.01"), SQL["op11_ranked_search"])
    assert got and not problems
