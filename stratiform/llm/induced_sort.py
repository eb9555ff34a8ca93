"""Suffix sorting by induction through disk-backed priority queues.

A suffix is S-type if it is smaller than the one behind it, else L-type; an S-type suffix behind an L-type
one is S*. The substrings between S* places are sorted and named; if names repeat, their string is
sorted by the same method, one level up. The order of the S* suffixes then induces that of all: a queue
holds tuples (first symbol, turn, place, common prefix); the smallest one goes out and
sends the suffix in front of it into the queue, if that is L-type, behind all that have its symbol.
A second queue does the same from the largest down for S-type suffixes.

Tuples carry the length of the prefix they share with the last one sent under their symbol: one more than
the least of those that went out in between. So every suffix leaves with its common prefix with its
neighbour, up to ``cap``; only neighbours among the S* suffixes are compared in the text.

Tuples go out in blocks. A block is cut before the first tuple that one of its own successors precedes,
so the order is the same as one by one. Queues are sorted runs: small ones in memory, merged as they grow,
and beyond ``memory`` rows written to ``folder`` and read back by blocks. The text and the names are mapped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_BLOCK = 1 << 18


def mapped(folder: str, size: int, kind, memory: int) -> np.ndarray:
    """An array of its own, in a file of ``folder`` if it has over ``memory`` values."""
    if size <= memory:
        return np.empty(size, kind)
    return np.memmap(os.path.join(folder, uuid.uuid4().hex), kind, "w+", shape=size)


class DiskQueue:
    """Rows (key, columns...) that leave by ascending key; rows with equal keys leave together."""

    def __init__(self, folder: str, kinds: list, memory: int):
        self.folder, self.kinds, self.memory = folder, [np.uint64, *kinds], memory
        self.runs: list[list] = []  # [arrays, rows that have left, whether on disk]
        self.spilled = 0

    def _merge(self, runs: list[list]) -> list:
        arrays = [np.concatenate([r[0][k][r[1] :] for r in runs]) for k in range(len(self.kinds))]
        order = np.argsort(arrays[0], kind="stable")
        return [[a[order] for a in arrays], 0, False]

    def push(self, key: np.ndarray, *columns: np.ndarray) -> None:
        """Add rows in ascending order of their keys."""
        if not len(key):
            return
        self.runs.append([[np.asarray(a, kind) for a, kind in zip((key, *columns), self.kinds, strict=True)], 0, False])
        size = lambda run: len(run[0][0]) - run[1]
        while len(self.runs) > 1 and not self.runs[-2][2] and size(self.runs[-2]) <= 2 * size(self.runs[-1]):
            self.runs[-2:] = [self._merge(self.runs[-2:])]
        held = [r for r in self.runs if not r[2]]
        if sum(map(size, held)) > self.memory:
            whole = self._merge(held)
            arrays = []
            for a in whole[0]:
                arrays.append(mapped(self.folder, len(a), a.dtype, 0))
                arrays[-1][:] = a
            self.runs = [r for r in self.runs if r[2]] + [[arrays, 0, True]]
            self.spilled += len(arrays[0])

    def peek(self, least: int) -> list[np.ndarray]:
        """The first rows, at least ``least`` of them if there are so many, in order."""
        ends = [r[0][0][r[1] + least - 1] for r in self.runs if len(r[0][0]) - r[1] >= least]
        limit = min(ends, default=_ALL)
        parts = []
        for arrays, left, _ in self.runs:
            to = left + int(np.searchsorted(arrays[0][left:], limit, "right"))
            if to > left:
                parts.append([a[left:to] for a in arrays])
        if len(parts) < 2:
            return [np.array(a) for a in parts[0]] if parts else [np.zeros(0, k) for k in self.kinds]
        rows = [np.concatenate([p[k] for p in parts]) for k in range(len(self.kinds))]
        order = np.argsort(rows[0], kind="stable")
        return [a[order] for a in rows]

    def take(self, last: np.uint64) -> None:
        """Let all rows up to the key ``last`` leave."""
        kept = []
        for run in self.runs:
            run[1] += int(np.searchsorted(run[0][0][run[1] :], last, "right"))
            if run[1] < len(run[0][0]):
                kept.append(run)
            elif run[2]:
                for a in run[0]:
                    os.unlink(a.filename)
        self.runs = kept


def _s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is S-type; the last symbol is the smallest and stands alone."""
    n = len(text)
    rises = np.zeros(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    rises[-1] = True
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    place = np.flatnonzero(differs)
    return np.repeat(rises[place], np.diff(np.concatenate([[-1], place])))


def _run_lengths(text: np.ndarray, cap: int) -> np.ndarray:
    """How many symbols equal to it begin at each place, up to ``cap``."""
    n = len(text)
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    place = np.flatnonzero(differs)
    size = np.diff(np.concatenate([[-1], place]))
    return np.minimum(np.repeat(place, size) - np.arange(n) + 1, cap).astype(np.uint8)


class _Words:
    """Eight bytes of text, or two names, as one number that compares like them."""

    def __init__(self, text: np.ndarray):
        self.step = 8 // text.itemsize
        # symbols behind the end never decide: the last one stands alone
        self.text = text
        if text.itemsize == 1:
            padded = np.concatenate([text, np.zeros(8, np.uint8)]) if not isinstance(text, np.memmap) else text
            self.view = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
        else:
            self.view = None

    def __call__(self, place: np.ndarray) -> np.ndarray:
        if self.view is not None:
            return self.view[np.minimum(place, len(self.view) - 1)].astype(np.uint64)
        last = len(self.text) - 1
        return self.text[np.minimum(place, last)].astype(np.uint64) << np.uint64(32) | self.text[np.minimum(place + 1, last)].astype(np.uint64)


def _split(rank: np.ndarray, rows: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Tell tied ``rows`` apart by ``word``: sets their ranks (how many are smaller), returns the rows still tied."""
    if int(word.max()) >> 32 == 0:
        key = rank[rows].astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        r = rank[rows][order]
    else:
        order = np.lexsort((word, rank[rows]))
        r, w = rank[rows][order], word[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (w[1:] != w[:-1])])
    at = np.arange(len(r))
    first = np.maximum.accumulate(np.where(np.concatenate([[True], r[1:] != r[:-1]]), at, 0))
    rank[rows[order]] = r + np.maximum.accumulate(np.where(new, at, 0)) - first
    alone = new & np.append(new[1:], True)
    return rows[order[~alone]]


def _names(text: np.ndarray, stars: np.ndarray, folder: str, memory: int) -> tuple[np.ndarray, int]:
    """The S* substrings' names in the order of the text, and how many there are."""
    m, words = len(stars), _Words(text)
    bits = np.uint64(64 // words.step)
    size = mapped(folder, m, np.int64, memory)
    size[:-1] = np.diff(stars) + 1
    size[-1] = 1

    def word(k: np.ndarray, off: int) -> np.ndarray:
        """Symbols from ``off`` on of the k-th substrings; what ends is larger than what goes on."""
        left = np.clip(size[k] - off, 0, words.step).astype(np.uint64)
        mask = np.where(left >= words.step, np.uint64(0), _ALL >> np.minimum(left * bits, np.uint64(63)))
        mask[left == 0] = _ALL
        return words(stars[k] + off) | mask

    queue = DiskQueue(folder, [np.int64], memory)
    for a in range(0, m, memory):
        k = np.arange(a, min(m, a + memory))
        key = word(k, 0)
        order = np.argsort(key, kind="stable")
        queue.push(key[order], k[order])
    names, count = mapped(folder, m, np.int32, memory), 0
    while True:
        key, k = queue.peek(min(memory, _BLOCK))
        if not len(key):
            return names, count
        rank, off = np.searchsorted(key, key, "left"), words.step
        tied = np.arange(len(k))
        while True:
            longer = np.zeros(len(k), bool)
            longer[rank[tied[size[k[tied]] > off]]] = True
            tied = tied[longer[rank[tied]]]
            if not len(tied):
                break
            tied = _split(rank, tied, word(k[tied], off))
            off += words.step
        new = np.zeros(len(k), np.int32)
        new[rank] = 1
        names[k] = count + np.cumsum(new)[rank] - 1
        count += int(new.sum())
        queue.take(key[-1])


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of a small string's suffixes by doubling what has been compared."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    by = names[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.searchsorted(by, by, "left")
    h, tied = 1, np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        behind = np.where(tied + h < n, rank[np.minimum(tied + h, n - 1)] + 1, 0)
        tied = _split(rank, tied, behind)
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, up to ``cap``."""
    words, out = _Words(text), np.zeros(len(a), np.int64)
    rows = np.arange(len(a))
    for off in range(0, cap, 8):
        differ = words(a[rows] + off) ^ words(b[rows] + off)
        same = sum((differ >> np.uint64(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 8)) + (differ == 0)
        out[rows] += same
        rows = rows[same == 8]
        if not len(rows):
            break
    return np.minimum(out, cap).astype(np.uint8)


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a : b + 1] for each pair, a <= b."""
    tables, width = [values], 1
    longest = int((b - a).max()) + 1 if len(a) else 0
    while 2 * width <= longest:
        tables.append(np.minimum(tables[-1][:-width], tables[-1][width:]))
        width *= 2
    level = np.zeros(len(a), np.int64)
    for k in range(1, len(tables)):
        level[b - a + 1 >= 1 << k] = k
    out = np.empty(len(a), values.dtype)
    for k, t in enumerate(tables):
        here = level == k
        if here.any():
            out[here] = np.minimum(t[a[here]], t[b[here] - (1 << k) + 1])
    return out


def _induced(text: np.ndarray, s_type: np.ndarray, seeds: DiskQueue, runs: np.ndarray | None, cap: int, down: bool) -> Iterator[tuple]:
    """Blocks (places, common prefixes, whether a seed) of all suffixes as they leave the queue.

    Seeds stand in the queue already, with flag 1 in their keys. ``down``: from the largest to the smallest.
    """
    top = int(text.max()) if down else 0
    wanted = down  # the type that is sent
    turn, block = 0, 1 << 12
    since = np.full(256, cap, np.uint8)  # the least common prefix since a symbol was last sent
    last_name, last_flag, last_run = -1, -1, 0
    while True:
        key, place, common = seeds.peek(block)
        if not len(key):
            return
        name, flag = (key >> np.uint64(33)).astype(np.int64), (key >> np.uint64(32) & np.uint64(1)).astype(np.int64)
        place = place.astype(np.int64)
        before = np.maximum(place - 1, 0)
        sends = (place > 0) & (s_type[before] == wanted)
        symbol = text[before].astype(np.int64)
        sent = top - symbol if down else symbol
        # a row leaves if no earlier one of its block sends one that goes before it
        first = np.minimum.accumulate(np.where(sends, 2 * sent, 1 << 62))
        late = first[:-1] < 2 * name[1:] + flag[1:]
        cut = int(late.argmax()) + 1 if late.any() else len(key)
        seeds.take(key[cut - 1])
        if cut < len(key):
            name, flag, place, common, sends, sent = (x[:cut] for x in (name, flag, place, common, sends, sent))
            block = max(256, min(block, 2 * cut))
        else:
            block = min(2 * block, _BLOCK)
        if runs is not None:
            common, run = common.copy(), runs[place]
            same = np.concatenate([[last_name], name[:-1]]) == name
            seam = same & (np.concatenate([[last_flag], flag[:-1]]) != flag)
            common[seam] = np.minimum(run, np.concatenate([[last_run], run[:-1]]))[seam]
            common[~same] = 0
            last_name, last_flag, last_run = name[-1], flag[-1], run[-1]
        source = np.flatnonzero(sends)
        order = np.argsort(sent[source], kind="stable")
        source = source[order]
        to = sent[source]
        if runs is not None:
            shared = np.empty(len(source), np.uint8)
            if len(source):
                new = np.concatenate([[True], to[1:] != to[:-1]])
                shared[new] = np.minimum(since[to[new]], np.minimum.accumulate(common)[source[new]])
                old = np.flatnonzero(~new)
                shared[old] = _least(common, source[old - 1] + 1, source[old])
            since = np.minimum(since, common.min())
            if len(source):
                final = np.append(np.flatnonzero(new)[1:], len(to)) - 1
                behind = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(cap))
                since[to[final]] = behind[source[final] + 1]
            shared = np.minimum(shared, cap - 1) + np.uint8(1)
        else:
            shared = np.zeros(len(source), np.uint8)
        turns = (turn + order).astype(np.uint64)
        seeds.push(to.astype(np.uint64) << np.uint64(33) | turns, place[source] - 1, shared)
        turn += len(source)
        yield place, common, flag == 1


def _seeded(folder: str, memory: int, parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DiskQueue:
    queue = DiskQueue(folder, [np.int32, np.uint8], memory)
    turn = 0
    for name, place, common in parts:
        queue.push(name.astype(np.uint64) << np.uint64(33) | np.uint64(1 << 32) | np.arange(turn, turn + len(name), dtype=np.uint64), place, common)
        turn += len(name)
    return queue


def _blocks(n: int, memory: int) -> Iterator[slice]:
    for a in range(0, n, memory):
        yield slice(a, min(n, a + memory))


def suffixes(text: np.ndarray, folder: str, memory: int, cap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (places, common prefix with the one before, up to ``cap``) of all suffixes but the last, from the
    largest to the smallest.

    ``text`` ends with its only 0 and holds no 255 (bytes), or names of 32 bits. Common prefixes are for bytes.
    """
    s_type = _s_types(text)
    runs = _run_lengths(text, cap) if cap else None
    stars = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if not len(stars) or stars[-1] != len(text) - 1:
        stars = np.append(stars, len(text) - 1)
    names, count = _names(text, stars, folder, memory)
    order = mapped(folder, len(stars), np.int32, memory)
    if count == len(stars):
        order[names] = np.arange(len(stars))
    elif len(stars) <= memory:
        order[:] = _doubled(names)
    else:
        at = len(stars)
        for place, _ in suffixes(names, folder, memory):
            at -= len(place)
            order[at : at + len(place)] = place[::-1]
        order[0] = len(stars) - 1

    def star_rows() -> Iterator[tuple]:
        last = None
        for part in _blocks(len(stars), memory):
            place = stars[order[part]]
            common = np.zeros(len(place), np.uint8)
            if cap:
                before = np.concatenate([place[:1] if last is None else last, place[:-1]])
                common = _common(text, before, place, cap)
            last = place[-1:]
            yield text[place], place, common

    places, shares, n = [], [], 0
    for place, common, seed in _induced(text, s_type, _seeded(folder, memory, star_rows()), runs, cap, False):
        for held, values in ((places, place), (shares, common)):
            out = values[~seed]
            kept = mapped(folder, len(out), np.int32 if held is places else np.uint8, memory)
            kept[:] = out
            held.append(kept)
    del order, stars, names

    def large_rows() -> Iterator[tuple]:
        share = np.zeros(1, np.uint8)
        for place, common in zip(reversed(places), reversed(shares), strict=True):
            if len(place):
                place, found = place[::-1], common[::-1]
                yield int(text_top) - text[place].astype(np.int64), place, np.concatenate([share, found[:-1]])
                share = found[-1:]

    text_top = text.max()
    for place, common, _ in _induced(text, s_type, _seeded(folder, memory, large_rows()), runs, cap, True):
        yield place, common
