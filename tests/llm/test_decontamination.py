from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from stratiform.llm import decontamination
from stratiform.llm.decontamination import ERROR_EVERY, SHORT, Matcher, contaminations, drop_contaminated, normalised, op2_decontamination

from .conftest import prose


def distance(pattern, text):
    """Smallest edit distance of the pattern to any stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[:], i
        for j, t in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc ", min_size=SHORT, max_size=70), st.text(alphabet="abc ", max_size=150), st.integers(0, 7), st.integers(0, 10**6))
def test_equals_the_full_table(pattern, text, edits, seed):
    r = random.Random(seed)
    planted = list(pattern)
    for _ in range(edits):
        k = r.randrange(len(planted) + 1)
        planted[k : k + r.randrange(2)] = r.choice(["", "a", "z"])
    text = normalised(text + " " + "".join(planted) + " " + text[::-1])
    pattern = normalised(pattern)
    if len(pattern) < SHORT:
        return
    far = distance(pattern, text)
    found = Matcher([(7, pattern)]).find(text)
    assert found == ({7: far} if far <= len(pattern) // ERROR_EVERY else {})


def test_documents(spark, make_docs, awkward, monkeypatch):
    item = prose(50, 40)
    changed = item.replace("the", "teh", 2).replace("river", "rivers", 1)
    items = spark.createDataFrame(
        [(1, item, "x"), (1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "one two, THREE", "x"), (None, "lost item", "x"), (5, prose(51, 30), "x")],
        "item_id long, text string, lang string",
    )
    docs = make_docs([
        (1, prose(1, 50) + " " + item.upper().replace(" ", "\n") + "! " + prose(2, 50)),
        (2, prose(3, 50) + " " + changed),
        (3, prose(4, 300)),
        (4, "One, two: three."),
        (5, "one two three four"),
        (6, " ".join(item.split()[:20])),
        (None, item + prose(51, 30)),
        (7, None),
    ])

    def found():
        return {x["doc_id"]: (x["__items"], min(x["__distances"], default=None)) for x in contaminations(docs, items).collect()}

    expected = {1: ([1], 0), 3: ([], None), 4: ([4], 0), 5: ([], None), 6: ([], None), None: ([1, 5], 0), 7: ([], None)}
    got = found()
    assert got.pop(2)[0] == [1]
    assert got == expected
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)  # several blocks
    assert found() | {2: None} == expected | {2: None}
    assert contaminations(awkward, items).count() == awkward.count()
    assert contaminations(docs, items.limit(0)).filter("size(__items) > 0").count() == 0
    assert contaminations(make_docs([]), items).count() == 0


def test_stage(spark, make_docs, tmp_path):
    item = prose(50, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([(1, "before " + item), (2, prose(8, 100)), (None, None)])
    kept = drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {2, None}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=6).map(normalised), max_size=6), st.text(alphabet="ab ", max_size=60).map(normalised))
def test_quoted_short_items(patterns, text):
    found = Matcher(list(enumerate(patterns)), quoted=True).find(text)
    assert found == {k: 0 for k, pattern in enumerate(patterns) if pattern and f" {pattern} " in f" {text} "}


def test_query_and_stage_find_short_items(spark, make_docs, tmp_path):
    item = prose(50, 40)
    rows = [(1, item), (2, "One two, three?"), (3, item.split()[0] + "x"), (4, None)]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([(1, "he said: one, two three. Then"), (2, "none two three"), (3, "one two threes"), (4, "one two three"), (5, item + " ONE TWO\nTHREE"), (6, None)])
    docs.drop("ids").write.parquet(f"{tmp_path}/documents.parquet")
    found = {x["doc_id"]: (x["item_ids"], x["least_distance"]) for x in op2_decontamination(spark, str(tmp_path)).collect()}
    assert found == {1: ([2], 0), 2: ([], None), 3: ([], None), 4: ([2], 0), 5: ([1, 2], 0), 6: ([], None)}
    assert {x["doc_id"] for x in drop_contaminated(spark, docs, str(tmp_path)).collect()} == {2, 3, 6}
