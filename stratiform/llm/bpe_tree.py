"""Byte-level BPE encoding and decoding as a tree reduction.

Encodings form a monoid, on two levels. A long text is cut in halves at any character; the halves are cut into matches of
the pattern recursively and joined by matching again in a window around the seam. A match is cut in halves at any
byte; the halves are encoded recursively and joined by encoding again a window of tokens around the seam. Windows grow
until what is outside provably stands:

* matches: on the left, when the match before the window comes out again with the text behind it; on the right, when
  a match begins where one of the right half begins and does so before the window's end can matter. The pattern
  looks at nothing before the place where it matches, so from there on both go the same way.
* tokens: when the pairs at both edges of the window are stable, that is, encode to themselves when put together. An
  encoding is the right one exactly if all its neighbouring pairs are stable.

Small strings and windows are remembered in bounded tables, as most occur again. Decoding concatenates up the same kind of tree.

Defined cases. Null text: empty, no ids. Empty table: no rows. Repeated rows: equal results. Extra columns are not read. Very
long texts and matches are what the trees are for.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.tables import beside, table

RANKS = "byte_bpe_50k.tiktoken"
#: Byte strings up to this length are merged directly, and remembered up to the other.
LEAF = 6
KEPT = 12
#: Texts up to this many characters are matched at once.
LEAF_TEXT = 4096
#: Matches up to this many characters are remembered, and this many of them.
SHORT = 40
REMEMBERED = 300_000


class TreeBpe:
    """Encodes byte strings by ``ranks`` (bytes to id; single bytes included)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.spelled[rank] = token
        self.pairs: dict[int, list[int] | None] = {}
        self.held: dict[bytes, list[int]] = {}
        self.joins = 0

    def merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none merges."""
        if len(data) > 96:
            return self._merged_long(data)
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        joins = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while joins:
            best = min((r for r in joins if r is not None), default=None)
            if best is None:
                break
            i = joins.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joins[i]
            if i < len(joins):
                joins[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                joins[i - 1] = ranks.get(parts[i - 1] + parts[i])
        return [ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap of neighbours, for windows that had to grow."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that begins here; 0 for places inside a part
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = end[i]
            if not j or j >= n or ranks.get(data[i : end[j]]) != rank:
                continue  # one of the two has merged with another since
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (r := ranks.get(data[i : end[end[i]]])) is not None:
                    heappush(heap, (r, i))
            if i and (r := ranks.get(data[before[i] : end[i]])) is not None:
                heappush(heap, (r, before[i]))
        return [ranks[data[i : end[i]]] for i in range(n) if end[i]]

    def _window(self, data: bytes) -> list[int]:
        """``merged``, remembered if it is short."""
        found = self.held.get(data)
        if found is None:
            found = self.merged(data)
            if len(data) <= KEPT:
                self._keep(self.held, data, found)
        return found

    @staticmethod
    def _keep(kept: dict, key, value) -> None:
        if len(kept) >= REMEMBERED:
            kept.clear()
        kept[key] = value

    def stable(self, a: int, b: int) -> bool:
        return self._pair(a, b) is None

    def _pair(self, a: int, b: int) -> list[int] | None:
        """What two tokens become when they are put together; None if they stay."""
        key = a << 32 | b
        found = self.pairs.get(key, False)
        if found is False:
            found = self._window(self.spelled[a] + self.spelled[b])
            found = None if found == [a, b] else found
            self._keep(self.pairs, key, found)
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded strings put together."""
        if not left or not right:
            return left + right
        window = self._pair(left[-1], right[0])
        if window is None:
            return left + right
        i = j = 1
        while True:
            calm_left = i >= len(left) or self.stable(left[-i - 1], window[0])
            calm_right = j >= len(right) or self.stable(window[-1], right[j])
            if calm_left and calm_right:
                return left[: max(0, len(left) - i)] + window + right[j:]
            i = i if calm_left else min(2 * i, len(left))
            j = j if calm_right else min(2 * j, len(right))
            window = self._window(b"".join([self.spelled[t] for t in (*left[-i:], *right[:j])]))

    def tree(self, data: bytes) -> list[int]:
        """Encode the halves and join them."""
        found = self.held.get(data)
        if found is not None:
            return found
        if len(data) <= LEAF:
            out = self.merged(data)
        else:
            half = len(data) // 2
            self.joins += 1
            out = self.join(self.tree(data[:half]), self.tree(data[half:]))
        if len(data) <= KEPT:
            self._keep(self.held, data, out)
        return out

    def encode(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern; a match that is a token is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tree(data)

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.spelled.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class TextCoder:
    """Texts to ids as little-endian 32-bit integers, and back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = TreeBpe(ranks)
        self.find = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.joins = 0

    def _coded(self, match: str) -> bytes:
        out = np.asarray(self.bpe.encode(match.encode()), "<u4").tobytes()
        if len(match) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[match] = out
        return out

    def encode(self, text: str) -> bytes:
        known = self.known
        return b"".join([known.get(m) or self._coded(m) for m in self.matches(text)])

    def matches(self, text: str) -> list[str]:
        """The pattern's matches in a text."""
        if len(text) <= LEAF_TEXT:
            return self.find.findall(text)
        parts = [self.find.findall(text[a : a + LEAF_TEXT]) for a in range(0, len(text), LEAF_TEXT)]
        while len(parts) > 1:  # up the tree, level by level
            parts = [self.joined(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0]

    def joined(self, left: list[str], right: list[str]) -> list[str]:
        """The matches of two matched strings put together; the lists given are used up."""
        if not left or not right:
            return left or right
        self.joins += 1
        i = j = 4
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            before = left[-i - 1] if i < len(left) else ""
            window = before + "".join(left[-i:]) + "".join(right[:j])
            found = self.find.findall(window)
            if before and (not found or found[0] != before):
                i *= 2
                continue
            # where the right half's matches begin in the window, and which of them
            place, begins = len(before) + sum(map(len, left[-i:])), {}
            for k in range(j):
                begins[place] = k
                place += len(right[k])
            sure = len(found) if j == len(right) else len(found) - 2  # the window's end may matter for the last ones
            at = 0
            for n in range(sure + 1):
                if n >= bool(before) and at in begins:
                    left[-i:] = found[1 if before else 0 : n]
                    left.extend(right[begins[at] :])
                    return left
                at += len(found[n]) if n < len(found) else 0
            if j == len(right):  # all of the right half has been matched again
                left[-i:] = found[1 if before else 0 :]
                return left
            j *= 2

    def decode(self, ids: bytes) -> bytes:
        return self.bpe.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> TextCoder:
    """Read once by each Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return TextCoder(ranks, pattern)


def _digests(path: str, pattern: str):
    def make():
        code = coder(path, pattern)

        def compute(part: pa.RecordBatch) -> list:
            n, of_ids, of_bytes = [], [], []
            for text in part.column("text").to_pylist():
                ids = code.encode(text or "")
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(code.decode(ids)).hexdigest())
            return [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

        return compute

    return make


def _lists(path: str, pattern: str):
    def make():
        code = coder(path, pattern)

        def compute(part: pa.RecordBatch) -> list:
            ids = [np.frombuffer(code.encode(text or ""), "<i4") for text in part.column("text").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            return [pa.ListArray.from_arrays(bounds, np.concatenate([np.zeros(0, "<i4"), *ids]))]

        return compute

    return make


def round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs`` (doc_id, text)."""
    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return beside(docs, _digests(path or public_tokenizers.path(RANKS), pattern), added, ["doc_id"])


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: doc_id and the ids of each text (``ids``, a list of int; empty for null)."""
    return beside(docs, _lists(public_tokenizers.path(RANKS), public_tokenizers.PATTERN), {"ids": "array<int>"}, ["doc_id"])
