from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from stratiform.llm import induced_sort
from stratiform.llm import suffix_dedup as S
from stratiform.llm.tables import table

from .conftest import prose

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(n_bytes, removed spans, kept) of each (doc_id, bytes), in the order of documents."""
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            if text[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(text[i : i + 100])
        spans, i = [], 0
        while i < len(text):
            j = i
            while j < len(text) and gone[j] == gone[i]:
                j += 1
            if gone[i]:
                spans.append((i, j - i))
            i = j
        out.append((doc_id, len(text), spans, bytes(x for x, g in zip(text, gone, strict=True) if not g)))
    return out


def found(df):
    return sorted((x["doc_id"], x["n_bytes"], [tuple(s) for s in x["spans"]], bytes(x["kept"])) for x in df.collect())


def random_text(r):
    letters = r.choice([1, 2, 3, 200])
    text = [r.randrange(1, letters + 1) for _ in range(r.choice([1, 2, 5, 30, 300]))]
    for _ in range(r.randrange(3)):
        unit = [r.randrange(1, letters + 1) for _ in range(r.randrange(1, 150))]
        for _ in range(r.randrange(1, 4)):
            at = r.randrange(len(text) + 1)
            text[at:at] = unit
    return np.array([*text, 0], np.uint8)


@pytest.mark.parametrize("memory", [1 << 20, 16, 3])
def test_suffixes_equal_plain_sorting(tmp_path, memory):
    r = random.Random(memory)
    for _ in range(120):
        text = random_text(r)
        raw = text.tobytes()
        expected = sorted(range(len(raw) - 1), key=lambda i: raw[i:], reverse=True)
        shared = []
        for a, b in zip(expected, expected[1:], strict=False):
            k = 0
            while k < 100 and raw[a + k] == raw[b + k]:
                k += 1
            shared.append(k)
        blocks = list(induced_sort.suffixes(text, str(tmp_path), memory, 100))
        places = [p for b in blocks for p in b[0].tolist()]
        common = [c for b in blocks for c in b[1].tolist()]
        assert places == expected and common[1:] == shared


def test_queue_spills_and_stays_in_order(tmp_path):
    r = np.random.default_rng(1)
    queue, out, pushed = induced_sort.DiskQueue(str(tmp_path), [np.int32], 100), [], []
    low = 0
    for _ in range(60):
        key = np.sort(r.integers(low, low + 10_000, 70)).astype(np.uint64)
        queue.push(key, key.astype(np.int32))
        pushed.append(key)
        got, value = queue.peek(40)
        assert len(got) >= 40 and (got == value.astype(np.uint64)).all()
        queue.take(got[-1])
        out.append(got)
        low = int(got[-1])
    assert queue.spilled > 1000
    while len(queue.peek(1000)[0]):
        got = queue.peek(1000)[0]
        queue.take(got[-1])
        out.append(got)
    assert (np.concatenate(out) == np.sort(np.concatenate(pushed))).all()
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("memory", [1 << 20, 64])
def test_first_windows_equal_brute_force(tmp_path, memory):
    r = random.Random(memory)
    passage = bytes(r.randrange(32, 90) for _ in range(400))
    parts = []
    for _ in range(40):
        a = r.randrange(250)
        parts.append(bytes(r.randrange(32, 90) for _ in range(r.randrange(60))) + passage[a : a + r.randrange(90, 150)] + b"x" * r.randrange(120))
    parts = [p for p in parts if len(p) >= 100]
    text = np.frombuffer(b"".join(bytes(c + 2 for c in p) + b"\1" for p in parts) + b"\0", np.uint8)
    first = S.first_windows(np.array([len(p) for p in parts]), text, str(tmp_path), memory)
    seen, at, again = set(), 0, 0
    for p in parts:
        for i in range(len(p) - 99):
            assert first[at + i] == (p[i : i + 100] not in seen)
            again += not first[at + i]
            seen.add(p[i : i + 100])
        at += len(p) + 1
    assert again > 200


def corpus(seed):
    r = random.Random(seed)
    line = prose(9, 30)
    rows, i = [], 0
    for group in range(8):
        text = prose(seed * 50 + group, r.choice([15, 60, 400]), [f"w{k}" for k in range(500)])
        for _ in range(r.choice([1, 2, 6])):
            words = text.split()
            for _ in range(r.randrange(3)):
                words[r.randrange(len(words))] = f"new{r.randrange(999)}"
            rows.append((i, " ".join(words)))
            i += 1
    for _ in range(30):  # a line with something else around it each time
        rows.append((i, f"{r.random()} {line} {r.random()}"))
        i += 1
    rows += [(i, "ab" * 300), (i + 1, "y" * 1000), (i + 2, "é日本🙂" * 60), (i + 3, text), (i + 4, text)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_operator_equals_brute_force(make_docs, monkeypatch, small):
    if small:  # hot anchors, many shards and buckets, spills, gathering in two steps
        for name, value in {"HOT": 3, "SHARD_BYTES": 2000, "BUCKET_BYTES": 4000, "MEMORY": 50, "SPAN": 1, "CHUNK_BYTES": 20_000}.items():
            monkeypatch.setattr(S, name, value)
    rows = corpus(1 + small)
    docs = make_docs(rows).repartition(4)
    expected = brute([(i, t.encode()) for i, t in rows])
    assert found(S.without_repeats(docs)) == expected
    assert sum(len(x[2]) for x in expected) > 30


def test_awkward_rows(spark, make_docs, awkward):
    rows = {(x["doc_id"], x["n_bytes"], len(x["kept"])) for x in S.without_repeats(awkward).collect()}
    once = len(prose(1, 80))
    assert {(1, once, once), (1, once, 0), (2, once, 0), (3, 0, 0), (4, 0, 0), (None, 0, 0)} <= rows
    assert (9, 50_000, 1) in rows and S.without_repeats(awkward).count() == awkward.count()
    assert S.without_repeats(make_docs([])).count() == 0
    text = prose(3, 60)
    last = S.without_repeats(make_docs([(None, text), (7, text)])).collect()
    assert {(x["doc_id"], len(x["kept"])) for x in last} == {(None, 0), (7, len(text))}


def test_query_equals_brute_force(spark):
    rows = [(x["doc_id"], (x["text"] or "").encode()) for x in table(spark, SF, "documents").collect()]
    expected = {i: (n, sum(k for _, k in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute(rows)}
    got = S.op13_suffix_dedup(spark, SF).collect()
    assert {x["doc_id"]: tuple(x)[1:] for x in got} == expected and len(got) == len(rows)
    assert sum(x["n_removed"] for x in got) > 1000
