from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stratiform.llm import bpe_tree
from stratiform.llm.bpe_tree import RANKS, coder, encode, round_trip
from stratiform.llm.tables import table

PATH = public_tokenizers.path(RANKS)


@pytest.fixture(scope="module")
def theirs():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ours(text):
    return np.frombuffer(coder(PATH, public_tokenizers.PATTERN).encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text(alphabet="abcdeinorst ", max_size=300), st.text(alphabet="ao ", max_size=400)))
def test_equals_the_library(theirs, text):
    assert ours(text) == theirs.encode_ordinary(text)
    assert coder(PATH, public_tokenizers.PATTERN).decode(np.asarray(ours(text), "<u4").tobytes()) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 900, " " * 2000 + "x", "=" * 777, "inging" * 300, "日本" * 300, "thereinafteronward" * 60, "\n \n" * 400])
def test_long_matches(theirs, text):
    assert ours(text) == theirs.encode_ordinary(text)


def test_joins_at_every_place(theirs):
    bpe = coder(PATH, public_tokenizers.PATTERN).bpe
    text = b"internationalizationalistically" * 2
    whole = bpe.merged(text)
    for k in range(len(text) + 1):
        assert bpe.join(bpe.merged(text[:k]), bpe.merged(text[k:])) == whole


def test_awkward_rows(spark, awkward, make_docs, theirs):
    rows = round_trip(awkward).collect()
    texts = awkward.collect()
    assert len(rows) == len(texts)
    found = {x["doc_id"]: x for x in rows if x["doc_id"] is not None}
    for x in texts:
        if x["doc_id"] is not None:
            ids = theirs.encode_ordinary(x["text"] or "")
            assert found[x["doc_id"]]["n_tokens"] == len(ids)
            assert found[x["doc_id"]]["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
            assert found[x["doc_id"]]["decoded_sha256"] == hashlib.sha256((x["text"] or "").encode()).hexdigest()
    assert round_trip(make_docs([])).count() == 0
    lists = {x["doc_id"]: x["ids"] for x in encode(spark, awkward, "").collect()}
    assert lists[3] == [] and lists[7] == theirs.encode_ordinary("one two three")


@settings(max_examples=300, deadline=None)
@given(
    text=st.one_of(st.text(max_size=120), st.text(alphabet="ab' \n1.!slvre", max_size=150), st.text(alphabet="a \n\t", max_size=80)),
    leaf=st.integers(1, 9),
)
def test_matches_join_at_any_cut(text, leaf):
    code = coder(PATH, public_tokenizers.PATTERN)
    whole = code.find.findall(text)
    for k in range(len(text) + 1):
        assert code.joined(code.find.findall(text[:k]), code.find.findall(text[k:])) == whole
    old, bpe_tree.LEAF_TEXT = bpe_tree.LEAF_TEXT, leaf
    try:
        assert code.matches(text) == whole
    finally:
        bpe_tree.LEAF_TEXT = old


@pytest.mark.parametrize("text", ["don'" + "t", "x'l" + "l y", " " * 9000 + "x", "we'" * 3000 + "ve", "a" * 9000, "\n" * 8191 + " b", "'" * 5000 + "re"])
def test_awkward_seams(theirs, text):
    assert ours(text) == theirs.encode_ordinary(text)


def test_trees_run_on_the_given_documents(spark, theirs):
    texts = [x["text"] or "" for x in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    bpe_tree.coder.cache_clear()
    code = coder(PATH, public_tokenizers.PATTERN)
    unknown = {m for t in texts for m in code.find.findall(t) if m.encode() not in code.bpe.ranks}
    for text in texts:
        assert np.frombuffer(code.encode(text), "<u4").tolist() == theirs.encode_ordinary(text)
    assert code.joins > 100 and code.bpe.joins > len(unknown) / 2
