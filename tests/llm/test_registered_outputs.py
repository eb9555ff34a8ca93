"""Columns of the registered queries without SQL, each against plain Python or the public library."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from stratiform.llm.queries import QUERIES
from stratiform.llm.tables import table

sys.path.insert(0, "/opt/tokenizers")
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {x["doc_id"]: x for x in table(spark, SF, "documents").collect()}


def rows_of(spark, name):
    rows = {x["doc_id"]: x for x in QUERIES[name](spark, SF).collect()}
    return rows


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_id(spark, docs):
    rows = rows_of(spark, "op1_language_id")
    assert rows.keys() == docs.keys()
    langs = {x["lang"] for x in docs.values()}
    assert all(x["held_out"] == (fold(i, 5) == 0) and 0 <= x["score"] <= 1 for i, x in rows.items())
    for i, x in rows.items():
        lettered = any(map(str.isalpha, docs[i]["text"] or ""))
        assert x["lang_pred"] in langs if lettered else x["lang_pred"] == "und"
    held = [i for i, x in rows.items() if x["held_out"] and docs[i]["lang"] and x["lang_pred"] != "und"]
    assert len(held) > 20 and sum(rows[i]["lang_pred"] == docs[i]["lang"] for i in held) >= 0.95 * len(held)


def test_quality_rules(spark, docs):
    for i, x in rows_of(spark, "op3_quality_rules").items():
        text = docs[i]["text"] or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        symbols = sum(c in "#*$%&|<>" for c in text)
        expected = (len(words), sum(map(len, words)), symbols, again, len(repeated))
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == expected
        assert x["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (x["base_failed"] and x["kept"])


def test_lm_scoring(spark, docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*WORD.findall((x["text"] or "").translate(lower)), None] for i, x in docs.items()}
    counts = Counter(t for i, found in tokens.items() if fold(i, 7) != 2 for t in found)
    total = counts.total()
    for i, x in rows_of(spark, "op6_lm_scoring").items():
        found = tokens[i]
        assert x["held_out"] == (fold(i, 7) == 2) and x["train_tokens"] == total
        assert (x["n_tokens"], x["n_known"]) == (len(found), sum(counts[t] > 0 for t in found))
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in found)
        assert x["base_score"] == pytest.approx(base, rel=1e-9)
        assert x["score"] < 0


def test_token_files(spark, docs):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, start = rows_of(spark, "op8_token_files"), 0
    for i in sorted(docs):
        ids = [*library.encode(docs[i]["text"] or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_bpe_tree(spark, docs):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = rows_of(spark, "op9_bpe_tree")
    assert rows.keys() == docs.keys()
    for i, x in rows.items():
        text = docs[i]["text"] or ""
        ids = library.encode_ordinary(text)
        assert x["n_tokens"] == len(ids) and x["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
