from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratiform.llm import lm_scoring
from stratiform.llm.lm_scoring import DEPTH, scores
from stratiform.llm.texts import SLICE_BYTES

from .conftest import prose


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    """(n_tokens, n_known, train_tokens, base, score) by walking the contexts with exclusion."""
    counts, ends, seen = Counter(), 0, {}
    for i, text in rows:
        if not held_out(i):
            counts.update((text or "").encode().lower().split())
            ends += 1
            line = b"\xff" * DEPTH + (text or "").encode().lower() + b"\xff"
            for p in range(DEPTH, len(line)):
                for k in range(DEPTH + 1):
                    context = seen.setdefault(line[p - k : p], Counter()) if k else seen.setdefault(b"", Counter())
                    context[line[p]] += 1
    total, different = sum(counts.values()) + ends, len(counts) + (ends > 0)

    def code(line, p):
        out, excluded = 0.0, set()
        for k in range(DEPTH, -1, -1):
            context = seen.get(line[p - k : p] if k else b"")
            left = {s: n for s, n in (context or {}).items() if s not in excluded}
            if left:
                whole = sum(left.values()) + len(left)
                if line[p] in left:
                    return out + math.log10(left[line[p]] / whole)
                out += math.log10(len(left) / whole)
                excluded |= set(context)
        return out - math.log10(256 - len(excluded))

    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        line = b"\xff" * DEPTH + (text or "").encode().lower() + b"\xff"
        found = [counts[w] for w in words] + [ends]
        base = sum(math.log10((c + 1) / (total + different + 1)) for c in found)
        score = sum(code(line, p) for p in range(DEPTH, len(line)))
        out.append((i, held_out(i), len(found), sum(c > 0 for c in found), total, base, score))
    return out


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 400])
def test_equals_brute_force(make_docs, chunk_bytes):
    rows = [(k, prose(k, 12 + k) + (" Éß 日本 ZZ" if k % 5 == 0 else "")) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "the THE the"), (3, "the sea"), (None, "an unknown one"), (103, "\n\t x \x0b")]
    found = scores(make_docs(rows), chunk_bytes).collect()
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(x[c] for c in columns) for x in found), key=repr)
    expected = sorted(brute(rows), key=repr)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


def test_awkward_rows(awkward, make_docs):
    found = scores(awkward).collect()
    assert len(found) == awkward.count() and all(x["score"] < 0 for x in found)
    assert scores(make_docs([])).count() == 0
    only_held_out = next(k for k in range(1000) if held_out(k))
    row = scores(make_docs([(only_held_out, "ab")])).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
    assert row["score"] == pytest.approx(-3 * math.log10(256))


def packed(texts, pack_bytes, monkeypatch):
    """Packs of one chunk."""
    monkeypatch.setattr(lm_scoring, "PACK_BYTES", pack_bytes)
    rows = [pa.record_batch({"doc_id": [k], "held_out": [held_out(k)], "text": pa.array([text], pa.string()), "chunk": [0]}) for k, text in enumerate(texts)]
    return pa.Table.from_batches(lm_scoring._packed(rows))


def test_work_follows_bytes_not_packs(monkeypatch):
    texts = [prose(k, 30) for k in range(300)] + ["x" * (SLICE_BYTES + 1), None, "", "the end"]
    many, one = packed(texts, 1, monkeypatch), packed(texts, 1 << 30, monkeypatch)
    assert (many.num_rows, one.num_rows) == (len(texts), 1)
    assert [s.num_rows for s in lm_scoring._rows(many)] == [300, 1, 3]
    for packs in (many, one):
        assert [x for s in lm_scoring._rows(packs) for x in s.column("text").to_pylist()] == texts

    asked = lm_scoring._asked(many)
    assert asked.sort_by([("gram", "ascending"), ("word", "ascending")]).equals(
        lm_scoring._asked(one).sort_by([("gram", "ascending"), ("word", "ascending")])
    )
    answers = asked.append_column("c", asked.column("n")).append_column("direct", pa.array(np.linspace(-9, -1, asked.num_rows)))
    listed = []
    monkeypatch.setattr(lm_scoring, "_finder", lambda words, f=lm_scoring._finder: listed.append(len(words)) or f(words))
    found = [lm_scoring._scorer(100, 10, 5)(packs, answers).to_pylist() for packs in (many, one)]
    assert len(listed) == 2  # the words of a chunk are listed once, not for each pack
    assert [x["doc_id"] for x in found[0]] == list(range(len(texts)))
    for x, y in zip(*found, strict=True):
        assert x == pytest.approx(y, rel=1e-12)


def test_each_chunk_gets_its_rows(monkeypatch):
    monkeypatch.setattr(lm_scoring, "PACK_BYTES", 2000)
    text = [prose(k, 9) for k in range(200)]
    rows = pa.record_batch({"doc_id": list(range(200)), "held_out": [k % 3 == 0 for k in range(200)], "text": text, "chunk": [k * 7 % 5 for k in range(200)]})
    got = {}
    for part in lm_scoring._packed([rows.slice(0, 50), rows.slice(50, 0), rows.slice(50)]):
        assert part.column("chunk").to_pylist() == sorted(set(part.column("chunk").to_pylist()))
        for chunk, pack in zip(*part.to_pydict().values(), strict=True):
            for s in lm_scoring._rows(pa.table({"pack": [pack]})):
                got.setdefault(chunk, []).extend(s.to_pylist())
    assert got == {c: [{"doc_id": k, "held_out": k % 3 == 0, "text": text[k]} for k in range(200) if k * 7 % 5 == c] for c in range(5)}


@pytest.mark.parametrize("words", [[], [b"a"], [b"the", b"a", b"\xc3\xa9", b"\x00"], [b"b", b"a" * (SLICE_BYTES + 1), b"a"]])
def test_words_are_found(words, monkeypatch):
    asked = pa.array([w for w in words for _ in range(3)][::-1], pa.binary())
    expected = [words.index(w) for w in asked.to_pylist()]
    assert lm_scoring._finder(pa.array(words, pa.binary()))(asked).tolist() == expected
    monkeypatch.setattr(lm_scoring, "hash_spans", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert lm_scoring._finder(pa.array(words, pa.binary()))(asked).tolist() == expected
