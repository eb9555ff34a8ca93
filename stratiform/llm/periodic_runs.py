"""Runs of periodic words by an online sparse diagonal DP.

A diagonal is a lag: word i lies on the diagonal of lag q if it equals word i - q, and the DP's value there
is how many words up to i do so one after the other. All lags of all words would be quadratic. But
for periods up to k it is enough to match windows of k words: a window of at least one period inside
a run recurs first at exactly its smallest period (Fine and Wilf). So for every k = 1, 2, 4, ... each word has
at most one active diagonal, the distance to the last earlier window like the one that it ends, and the
DP increments it while it stays the same. When it changes, a diagonal that is long enough has ended,
and it is a run with smallest period q, which nothing extends: k / 2 < q <= k, the k + q - 1 words before the
first increment included. Windows are only looked at where both their halves recur, so larger k
cost next to nothing in common prose; the work is O(n log n) for any text.

A run is reported from max(SHORTEST, EXPONENT * q) words on. Documents are independent: one pass, no shuffle.

Defined cases. Null or empty text, text without words: no runs and an empty collapsed text.
Repeated rows give the same result each, rows without doc_id too. Ties among longest runs: smallest start, then
period. Very long texts make a larger slice. Words and windows are compared by 64-bit hashes. Columns that
are not kept are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.tables import beside, table
from stratiform.llm.texts import flat, hash_spans, mix, words

SHORTEST = 6
EXPONENT = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _last_like(code: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each place to the last earlier one of its row with the same code, 0 if there is none;
    and whether there is an earlier or a later one."""
    order = np.lexsort((place, code, row)) if len(code) else np.zeros(0, np.int64)
    lag = np.zeros(len(code), np.int64)
    here, before = order[1:], order[:-1]
    same = (code[here] == code[before]) & (row[here] == row[before])
    lag[here[same]] = place[here[same]] - place[before[same]]
    recurs = lag > 0
    recurs[before[same]] = True
    return lag, recurs


def find_runs(code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs of the rows' words, by row, start and period.

    ``code`` has one number for each word, ``first`` the bounds of the rows; starts count from the row's first word.
    """
    n = len(code)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = []
    place, window, k = np.arange(n), code.astype(np.uint64), 1
    while len(place):
        lag, recurs = _last_like(window, row[place], place)
        # the DP: a diagonal goes on where the next place has the same lag
        goes_on = (np.diff(place) == 1) & (np.diff(lag) == 0) & (np.diff(row[place]) == 0)
        begin = np.flatnonzero(np.concatenate([[True], ~goes_on]))
        end = np.append(begin[1:], len(place)) - 1
        q = lag[begin]
        length = place[end] - place[begin] + k + q
        ended = (2 * q > k) & (q <= k) & (length >= np.maximum(SHORTEST, EXPONENT * q))
        begin, q = begin[ended], q[ended]
        out.append((row[place[begin]], place[begin] - k + 1 - q, length[ended], q))
        # windows of 2 * k words, where both halves recur
        at = np.full(n, -1, np.int64)
        at[place] = np.arange(len(place))
        again = np.flatnonzero(recurs)
        again = again[place[again] >= k]
        half = at[place[again] - k]
        both = (half >= 0) & recurs[half] & (row[place[again]] == row[place[again] - k])
        again, half = again[both], half[both]
        window = mix(window[again] * _STEP + mix(window[half] + np.uint64(k)))
        place, k = place[again], 2 * k
    rows, start, length, period = (np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(4))
    start = start - first[rows]
    order = np.lexsort((period, start, rows))
    return rows[order], start[order], length[order], period[order]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """Words joined by one space, a text for each row."""
    size = ends - starts + 1
    total = np.concatenate([[0], np.cumsum(size)])
    out = np.full(total[-1], 0x20, np.uint8)
    step = np.arange(total[-1]) - np.repeat(total[:-1], size)
    inside = step < np.repeat(size - 1, size)
    out[inside] = data[(np.repeat(starts, size) + step)[inside]]
    # the space behind the last word of a row goes
    last = total[first[1:]][np.diff(first) > 0] - 1
    keep = np.ones(len(out), bool)
    keep[last] = False
    bounds = total[first] - np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out[keep])])


def _compute(reorder: Callable[[object, int], tuple[int, int] | None] | None):
    def compute(part: pa.RecordBatch) -> list:
        data, bounds = flat(part.column("text"))
        starts, ends, first = words(data, bounds)
        if reorder:
            order = np.arange(len(starts))
            for i, (doc_id, n) in enumerate(zip(part.column("doc_id").to_pylist(), np.diff(first).tolist(), strict=True)):
                if (found := reorder(doc_id, n)) is not None:
                    a, p = found
                    order[first[i] + a : first[i + 1]] = first[i] + a + np.arange(n - a) % p
            starts, ends = starts[order], ends[order]
        row, start, length, period = find_runs(hash_spans(data, starts, ends), first)
        edge = np.zeros(len(starts) + 1, np.int64)  # runs open at each word, behind their first period
        np.add.at(edge, first[row] + start + period, 1)
        np.add.at(edge, first[row] + start + length, -1)
        kept = np.cumsum(edge[:-1]) == 0
        left = np.concatenate([[0], np.cumsum(kept)])[first]
        at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN))
        collapsed = _joined(data, starts[kept], ends[kept], left)
        return [pa.ListArray.from_arrays(pa.array(at), runs), collapsed.cast(pa.string()) if collapsed.nbytes < 1 << 30 else collapsed]

    return compute


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, reorder: Callable[[object, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """Columns ``keep`` (doc_id) of each row with ``runs`` (start, length, period; by start, then period) and
    ``collapsed``, the text without the words that repeat a run's first period.

    ``reorder`` may give (a, p) for a document of n words: from word a on, its first p words then stand again and again.
    """
    added = {"runs": "array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed": "string"}
    return beside(docs, lambda: _compute(reorder), added, list(dict.fromkeys([*(keep or ["doc_id"]), *(["doc_id"] if reorder else [])])))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The documents of the query that have a periodic end, by a hash of their ids."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli, and digests of all runs and of what is left."""
    found = periodic_runs(table(spark, sf_dir, "documents"), reorder=planted)
    longest = F.expr("aggregate(runs, runs[0], (a, r) -> IF(r.length > a.length, r, a))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, longest).alias("run"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "run.start", "run.length", "run.period",
        F.expr("1000 * run.length div run.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
