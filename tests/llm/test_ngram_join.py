from __future__ import annotations

import random
from collections import Counter

import pytest

from stratiform.llm.components import components
from stratiform.llm.ngram_join import drop_linked, link_documents

from .conftest import prose


def brute(rows):
    """(n_shingles, component) of each (doc_id, text) by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(text, edits, r):
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, make_docs, seed):
    r = random.Random(seed)
    passage = prose(99, 60)
    rows, i = [], 0
    for group in range(12):
        vocabulary = [f"w{group}x{k}" for k in range(400)]
        text = prose(seed * 100 + group, r.choice([6, 30, 120, 300]), vocabulary)
        for _ in range(r.choice([1, 2, 9])):
            rows.append((i, edited(text, r.randrange(0, 1 + len(text.split()) // 12), r).upper()))
            i += 1
        rows.append((i, passage + " " + prose(i, r.choice([3, 12, 20, 60]), vocabulary)))
        i += 1
    chain = prose(7, 100, [f"c{k}" for k in range(500)]).split()  # links only between neighbours
    for step in range(8):
        rows.append((i, " ".join(chain[: 100 - 12 * step] if step < 5 else chain[:8])))
        i += 1
    found = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in link_documents(make_docs(rows)).collect()}
    assert found == brute(rows)


def test_large_group_of_near_copies_is_one(spark, make_docs):
    r = random.Random(3)
    text = prose(3, 120, [f"w{k}" for k in range(900)])
    rows = [(k, edited(text, 2, r)) for k in range(300)]
    found = link_documents(make_docs(rows)).collect()
    assert {x["component_id"] for x in found} == {0}


def test_awkward_rows(awkward):
    rows = link_documents(awkward).collect()
    assert len(rows) == awkward.count()
    found = Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in rows)
    assert found[(1, rows_n(rows, 1), 1)] == 2 and found[(2, rows_n(rows, 1), 1)] == 1
    for i in (3, 4, 5):
        assert found[(i, 0, i)] == 1
    assert found[(6, 1, 6)] == 1 and found[(7, 1, 7)] == 1
    assert sum(n for (i, _, c), n in found.items() if i is None and c is None) == 2


def rows_n(rows, doc_id):
    return next(x["n_shingles"] for x in rows if x["doc_id"] == doc_id)


def test_empty_table(spark, make_docs):
    assert link_documents(make_docs([])).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(spark, awkward):
    kept = drop_linked(spark, awkward, "")
    assert kept.columns == awkward.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert ids.count(None) == 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(5, 5)]
    found = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 60)}


def test_stage_keeps_different_texts_of_one_doc_id(spark, make_docs):
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (1, prose(1, 80)), (2, prose(1, 80)), (3, None), (3, None), (3, prose(4, 9))]
    kept = drop_linked(spark, make_docs(rows), "")
    found = sorted((x["doc_id"], x["text"] or "") for x in kept.collect())
    assert found == sorted([(1, prose(1, 80)), (1, prose(2, 80)), (3, ""), (3, prose(4, 9))])
