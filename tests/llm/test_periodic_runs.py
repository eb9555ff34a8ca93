from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from stratiform.llm.periodic_runs import find_runs, op12_periodic_runs, periodic_runs, planted
from stratiform.llm.tables import table

SF = "/root/testdata/sf0.001"


def brute(words):
    """(start, length, period) of all runs, by every lag; periods that a smaller one explains go."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    rows = []
    for _ in range(120):
        alphabet = r.choice([1, 2, 3, 6, 40])
        words = [r.randrange(alphabet) for _ in range(r.choice([0, 1, 5, 7, 30, 90, 200]))]
        for _ in range(r.randrange(4)):
            unit = [r.randrange(alphabet) for _ in range(r.randrange(1, 14))]
            at = r.randrange(len(words) + 1)
            repeated = unit * r.randrange(2, 9) + unit[: r.randrange(len(unit) + 1)]
            words[at:at] = repeated
        rows.append(words)
    first = np.concatenate([[0], np.cumsum([len(w) for w in rows])])
    found = find_runs(np.array([x for w in rows for x in w], np.int64), first)
    got = [[] for _ in rows]
    for i, *run in zip(*(f.tolist() for f in found), strict=True):
        got[i].append(tuple(run))
    assert got == [brute(w) for w in rows]
    assert sum(map(len, got)) > 100


def test_one_word_many_times_is_not_quadratic():
    n = 2_000_000
    began = time.time()
    found = find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert [f.tolist() for f in found] == [[0], [0], [n], [1]]
    r = np.random.default_rng(1)
    find_runs(r.integers(0, 3, n), np.array([0, n]))
    assert time.time() - began < 60


def test_awkward_rows(awkward, make_docs):
    kept = periodic_runs(awkward, ["doc_id", "n_words", "text"]).collect()
    assert len(kept) == awkward.count()
    for x in kept:
        words = split(x["text"])
        runs = brute(words) if len(words) < 1000 else [tuple(r) for r in x["runs"]]
        assert [tuple(r) for r in x["runs"]] == runs and x["collapsed"] == collapsed(words, runs)
    assert periodic_runs(make_docs([])).count() == 0
    text = "x  a b\ta b a b a b\ny y y y y y z"
    (row,) = periodic_runs(make_docs([(1, text)])).collect()
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 2), (9, 6, 1)] and row["collapsed"] == "x a b y z"


def test_query_equals_brute_force(spark):
    texts = {x["doc_id"]: x["text"] for x in table(spark, SF, "documents").collect()}
    rows = op12_periodic_runs(spark, SF).collect()
    assert sorted(x["doc_id"] for x in rows) == sorted(texts)
    periodic = 0
    for x in rows:
        words = split(texts[x["doc_id"]])
        h = zlib.crc32(str(x["doc_id"]).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
        runs = brute(words)
        periodic += bool(runs)
        best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
        assert (x["n_runs"], x["start"], x["length"], x["period"]) == (len(runs), *best)
        assert x["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert x["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert x["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert periodic > 5
    assert planted(None, 5) is None and planted(1, 0) is None
