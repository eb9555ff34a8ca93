from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratiform.llm import token_files
from stratiform.llm.token_files import coder, packed, read_tokens, unpacked, write_tokens
from stratiform.session import scratch_dir

PATH = public_tokenizers.path(token_files.TOKENIZER)


@pytest.fixture(scope="module")
def theirs():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=60))
def test_packing_is_exact(ranks):
    control, data = packed(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert unpacked(control, data, len(ranks)).tolist() == ranks


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=120))
def test_words_alone_equal_the_whole_text(theirs, text):
    code = coder(PATH)
    assert np.frombuffer(code.encode([text, text])[1], code.kind).tolist() == theirs(text)


@pytest.mark.parametrize("text", ["á ë", " ́x", "İ Σ ΑΣ", "don't I'LL", "<|endoftext|> x", "x\x1cy z\x85w", "\r\n\t"])
def test_odd_texts(theirs, text):
    code = coder(PATH)
    assert np.frombuffer(code.encode([text])[0], code.kind).tolist() == theirs(text)


@pytest.mark.parametrize("file_ids", [4_000_000, 50])
def test_files_round_trip(spark, awkward, theirs, monkeypatch, file_ids):
    monkeypatch.setattr(token_files, "FILE_IDS", file_ids)
    folder = scratch_dir(spark, "tokens")
    write_tokens(awkward, folder)
    found = sorted(read_tokens(spark, folder).collect(), key=lambda x: x["start"])
    assert len(found) == awkward.count()
    ids = [x["doc_id"] for x in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    start, crcs = 0, {}
    for x in found:
        assert x["start"] == start
        start += x["n_tokens"]
        crcs.setdefault(x["doc_id"], []).append((x["n_tokens"], x["ids_crc32"]))
    expected = {}
    for x in awkward.collect():
        ids = np.array([*theirs(x["text"] or ""), 1], "<u4")
        expected.setdefault(x["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert {k: sorted(v) for k, v in crcs.items()} == {k: sorted(v) for k, v in expected.items()}


def test_empty_table(spark, make_docs):
    folder = scratch_dir(spark, "tokens")
    write_tokens(make_docs([]), folder)
    assert read_tokens(spark, folder).count() == 0


@pytest.fixture(scope="module")
def unchanged():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


_PIECES = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "a", " ", "\n", "\u00e9", "\u0301", "\u3000", "b's", "1"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), max_size=12).map("".join))
def test_special_tokens_as_in_the_unchanged_library(unchanged, text):
    code = coder(PATH, False)
    assert np.frombuffer(code.encode([text])[0], code.kind).tolist() == unchanged(text)


def test_files_hold_special_tokens(spark, make_docs, unchanged):
    texts = ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>y z", "after"]
    assert unchanged(texts[0]) == [320, 49407, 321]
    folder = scratch_dir(spark, "tokens")
    write_tokens(make_docs(list(enumerate(texts))), folder)
    ids = [np.array([*unchanged(text), 1], "<u4") for text in texts]
    found = sorted((x["doc_id"], x["n_tokens"], x["ids_crc32"]) for x in read_tokens(spark, folder).collect())
    assert found == [(k, len(x), zlib.crc32(x.tobytes())) for k, x in enumerate(ids)]


class Counted:
    """A tokenizer that notes how many texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **options)


def test_new_words_share_their_pieces_and_calls(unchanged):
    code = token_files.WordCoder(PATH, False)
    code.tokenizer = Counted(code.tokenizer)
    letters = [a + b + c for a in "abcdefghij" for b in "klmnop" for c in "uvwxyzéß"]
    text = " ".join(word + sign for word in letters for sign in [",", "!!", "."]) + "\n" + " ".join(letters).title()
    assert np.frombuffer(code.encode([text])[0], code.kind).tolist() == unchanged(text)
    assert len(set(text.split())) == 4 * 480 and code.tokenizer.texts < 20


_PARTS = ["Ã", "×", "÷", "ÿ", "À", "ß", "Ÿ", "ª", "µ", "İ", "Å", " ", "́", "中", "\U0001f600"]
_PARTS += ["'s", "'LL", "'", ".", "!!", "</w>", "_", "~", "1", "Ab", "z", "<|endoftext|>", "<|ENDOFTEXT|>", "\x00", "\x7f", "\x85", " ", "\t", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_PARTS), max_size=12).map("".join), max_size=4))
def test_pieces_as_in_the_unchanged_library(unchanged, texts):
    code = coder(PATH, False)
    code.known.clear()
    assert [np.frombuffer(x, code.kind).tolist() for x in code.encode(texts)] == [unchanged(text) for text in texts]


def test_every_character_beside_letters_and_signs(unchanged):
    code = token_files.WordCoder(PATH, False)
    odd = [chr(c) for c in [*range(0x250), *range(0x300, 0x310), *range(0x2000, 0x2070), *range(0xFF00, 0xFF60)]]
    texts = [text for c in odd for text in (c, f"Ab{c}", f"{c}Ab", f"A{c}b.", f".{c}", f"ab.{c} ab")]
    for text, ids in zip(texts, code.encode(texts), strict=True):
        assert np.frombuffer(ids, code.kind).tolist() == unchanged(text), ascii(text)


@pytest.mark.parametrize("change", ["case", "suffix", "added", "last"])
def test_other_tokenizers_encode_word_by_word(tmp_path, change):
    with open(PATH, encoding="utf-8") as file:
        made = json.load(file)
    if change == "case":
        made["normalizer"]["normalizers"].pop()
    elif change == "suffix":
        made["model"]["end_of_word_suffix"] = None
    elif change == "added":
        made["added_tokens"].append({**made["added_tokens"][0], "id": 49408, "content": "The"})
    else:  # signs lose their last forms
        made["model"]["vocab"] = {k if k != ".</w>" else "gone": v for k, v in made["model"]["vocab"].items()}
        made["model"]["merges"] = []
    path = tmp_path / "other.json"
    path.write_text(json.dumps(made), encoding="utf-8")
    library, code = Tokenizer.from_file(str(path)), token_files.WordCoder(str(path), False)
    assert code.cuts == (change == "last")
    texts = ["The THE the. Été . x.", "", "Ab.c <|endoftext|>"]
    assert [np.frombuffer(x, code.kind).tolist() for x in code.encode(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
