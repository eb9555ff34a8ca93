"""Removal of repeated 100-byte strings by external induced suffix sorting.

A byte goes if a string of WINDOW bytes covers it that also starts earlier, in a document with a smaller
doc_id or further ahead in its own. Overlaps count, and strings are judged on the input.

1. Documents are packed into chunks of about CHUNK_BYTES, once, in a table bucketed by chunk, so that
   the steps below shuffle only what chunks ask and are told.
2. Each window of WINDOW bytes has an anchor, the GRAM bytes in it whose hash is the least. Equal windows have
   equal anchors at the same offset. Windows in a row with one anchor are a segment; windows whose anchor
   stands nowhere else repeat nowhere. So a chunk asks which of its anchors other chunks have too.
3. Segments of anchors that repeat are gathered, equal ones as one: before the shuffle in each chunk, then by
   their hashes, the earliest kept. A later segment that equals an earlier one repeats whole.
4. Segments are dealt into shards by anchor, so that equal windows meet, and each shard is sorted by suffixes
   (induced_sort.py): windows next to each other that share WINDOW bytes are equal, and the first in the order
   of documents stays. Queues spill to Spark's local folders, so a shard may be larger than memory. An anchor that
   stands in one segment only has nothing to be compared with. Anchors in over HOT segments are cut into their
   single windows, which an aggregation counts, so no task holds all that surrounds a common line.
5. Chunks are told which windows are first and cut what the others cover.

Defined cases. Null text: empty. Texts under WINDOW bytes lose nothing. A row without doc_id stands behind all
others. Of repeated rows one counts as the first, the others repeat it; rows with one doc_id and different
texts stand in an order given by their texts' hashes. Empty table: no rows. A very long text makes a larger
chunk. Other columns are not read. Kept bytes may end inside a character, so they are binary. Anchors and, among
segments of one anchor, equality are compared by 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.induced_sort import suffixes
from stratiform.llm.tables import in_arrow, ship, stored, table
from stratiform.llm.texts import flat, hash_spans, slices
from stratiform.session import scratch_dir

WINDOW = 100
GRAM = 32
#: Bytes whose grams are hashed at once.
SLICE = 1 << 18
CHUNK_BYTES = 2 << 20
#: Text of the chunks of one bucket.
BUCKET_BYTES = 32 << 20
SHARD_BYTES = 3 << 20
#: Rows of a queue in memory.
MEMORY = 1 << 19
HOT = 4000
#: Chunks whose segments one task gathers.
SPAN = 4096

_LAST = np.iinfo(np.int64).max
#: A segment: its anchor, the order of its document, and where it stands: the row of the chunk, then 32 bits for the place.
_TYPES = "anchor long, doc_id long, tie int, chunk long, place long, segment binary"


def anchored(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Begin of the first window, number of windows, and begin and hash of the anchor of each segment of the rows' texts."""
    none = *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64)
    n = len(data)
    if n < WINDOW:
        return none
    grams = hash_spans(data, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    # the least hash first, then the first place
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    width, span = 1, WINDOW - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: width - span], least[span - width :])
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    place = np.flatnonzero(row[: n - WINDOW + 1] == row[WINDOW - 1 :])
    if not len(place):
        return none
    at = (least[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(place) != 1)]))
    return place[begin], np.diff(np.append(begin, len(place))), at[begin], grams[at[begin]]


def _ipc(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, pack): the rows of a task in compressed packs of about CHUNK_BYTES."""
    held: list[pa.RecordBatch] = []
    number, size = TaskContext.get().partitionId() << 32, 0

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array([number], pa.int64()), pa.array([_ipc(pa.Table.from_batches(held))], pa.binary())], names=["chunk", "pack"])

    for part in slices(batches, "text", CHUNK_BYTES // 4):
        held.append(part)
        size += part.nbytes
        if size >= CHUNK_BYTES:
            yield flush()
            held, size, number = [], 0, number + 1
    if held:
        yield flush()


class _Chunk:
    """The documents of a chunk, and the segments of their texts."""

    def __init__(self, packs: pa.Table):
        rows = pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in packs.column("pack")]).combine_chunks()
        self.doc_id = rows.column("doc_id").combine_chunks() if rows.num_rows else pa.array([], pa.int64())
        self.data, self.bounds = flat(rows.column("text"))
        a, n = 0, len(self.bounds) - 1
        self.slices: list[tuple[int, int]] = []  # of whole rows; they keep arrays of hashes small
        parts = []
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.bounds, self.bounds[a] + SLICE, "right")) - 1)
            part = self.bounds[a : b + 1]
            self.slices.append((int(part[0]), int(part[-1])))
            begin, count, at, anchor = anchored(self.data[part[0] : part[-1]], part - part[0])
            parts.append((begin + part[0], count, at + part[0], anchor))
            a = b
        kinds = (np.int64, np.int64, np.int64, np.uint64)
        self.begin, self.count, self.at, self.anchor = (np.concatenate([np.zeros(0, k), *(p[i] for p in parts)]) for i, k in enumerate(kinds))

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of spans in ascending order, none of which leaves its row."""
        out = np.full(len(begin), hash_spans(self.data[:0], np.zeros(1, np.int64), np.zeros(1, np.int64))[0])
        for a, b in self.slices:
            i, j = np.searchsorted(begin, [a, b])
            out[i:j] = hash_spans(self.data[a:b], begin[i:j] - a, end[i:j] - a)
        return out

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.isin(self.anchor, anchors))


def _dealt(chunk: int, parts: Iterable[tuple[int, dict]], fields: list[tuple]) -> pa.Table:
    """Rows (part, chunk, ...) with the given columns."""
    rows = [(k, x) for k, x in parts]
    arrays = {"part": pa.array([k for k, _ in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64())}
    return pa.table(arrays | {name: pa.array([x[name] for _, x in rows], kind) for name, kind in fields})


def _asked(parts: int):
    """The chunk's different anchors for each part; the first ``twice`` of them stand in it more than once."""

    def run(packs: pa.Table) -> pa.Table:
        anchor, n = np.unique(_Chunk(packs).anchor, return_counts=True)
        part = (anchor % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((n == 1, part))
        anchor, part, n = anchor[order], part[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        ends = [*at[1:], len(part)]
        found = ((int(part[a]), {"twice": int((n[a:b] > 1).sum()), "anchors": anchor[a:b].tobytes()}) for a, b in zip(at, ends, strict=False))
        return _dealt(packs.column("chunk")[0].as_py(), found, [("twice", pa.int32()), ("anchors", pa.binary())])

    return run


def _repeated(rows: pa.Table) -> pa.Table:
    """For each chunk those of its anchors that repeat."""
    lists = [np.frombuffer(a.as_buffer(), np.uint64) for a in rows.column("anchors")]
    twice = rows.column("twice").to_pylist()
    anchor, n = np.unique(np.concatenate([*lists, *(a[:k] for a, k in zip(lists, twice, strict=True))]), return_counts=True)
    anchor = anchor[n > 1]
    found = [np.intersect1d(a, anchor, assume_unique=True).tobytes() for a in lists]
    return pa.table({"chunk": rows.column("chunk"), "anchors": pa.array(found, pa.binary())})


def _anchors(rows: pa.Table) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(a.as_buffer(), np.uint64) for a in rows.column("anchors") if a.is_valid)])


def _segments(parts: int):
    """The chunk's different segments of repeated anchors, dealt by their hashes, each where it stands first."""

    def run(packs: pa.Table, told: pa.Table) -> pa.Table:
        number, chunk = packs.column("chunk")[0].as_py(), _Chunk(packs)
        pick = chunk.repeated(_anchors(told))
        begin, size, anchor = chunk.begin[pick], chunk.count[pick] + WINDOW - 1, chunk.anchor[pick]
        row = np.searchsorted(chunk.bounds, begin, "right") - 1
        ids = chunk.doc_id.fill_null(_LAST).to_numpy().astype(np.int64)
        ties = (chunk.hashes(chunk.bounds[:-1], chunk.bounds[1:]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        hashes = chunk.hashes(begin, begin + size)
        order = _first_rows(begin, ties[row], ids[row], hashes, anchor)
        part = (hashes[order] % np.uint64(parts)).astype(np.int64)
        order = order[np.lexsort((begin[order], part))]
        begin, size, row = begin[order], size[order], row[order]
        part = (hashes[order] % np.uint64(parts)).astype(np.int64)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        spelled = chunk.data[np.repeat(begin, size) + step]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        texts = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)])
        rows = pa.table({
            "at": (chunk.at[pick[order]] - begin).astype(np.int16), "doc_id": ids[row], "tie": ties[row],
            "place": row << 32 | begin - chunk.bounds[row], "segment": texts,
        })
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        ends = [*at[1:], len(part)]
        return _dealt(number, ((int(part[a]), {"rows": _ipc(rows.slice(a, b - a))}) for a, b in zip(at, ends, strict=False)), [("rows", pa.binary())])

    return run


def _first_rows(*keys: np.ndarray) -> np.ndarray:
    """Of rows that agree in the last two keys the first one by all keys, the last of which counts most."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    for k in keys[-2:]:
        new[1:] &= k[order][1:] == k[order][:-1]
    new[1:] = ~new[1:]
    new[:1] = True
    return order[new]


def _distinct(packed: bool):
    """Of equal segments the first one in the order of documents."""

    def run(blobs: pa.Table) -> pa.Table:
        read, keys = [], []
        for blob, chunk in zip(blobs.column("rows"), blobs.column("chunk"), strict=True):
            rows = pa.ipc.open_stream(blob.as_buffer()).read_all()
            read.append(rows if "chunk" in rows.column_names else rows.append_column("chunk", pa.array(np.full(rows.num_rows, chunk.as_py()))))
            data, bounds = flat(rows.column("segment"))
            begin = bounds[:-1] + rows.column("at").to_numpy()
            keys.append((hash_spans(data, bounds[:-1], bounds[1:]), hash_spans(data, begin, begin + GRAM)))
        rows = pa.concat_tables(read)
        del read
        hashes, anchor = (np.concatenate([k[i] for k in keys]) for i in range(2))
        pick = _first_rows(*(rows.column(c).to_numpy() for c in ("place", "chunk", "tie", "doc_id")), hashes, anchor)
        rows = rows.take(pa.array(pick))
        pa.default_memory_pool().release_unused()  # a worker serves many groups
        if packed:
            return _dealt(blobs.column("chunk")[0].as_py(), [(blobs.column("part")[0].as_py(), {"rows": _ipc(rows)})], [("rows", pa.binary())])
        return rows.append_column("anchor", pa.array(anchor[pick].view(np.int64))).select(["anchor", "doc_id", "tie", "chunk", "place", "segment"])

    return run


def first_windows(lengths: np.ndarray, text: np.ndarray, folder: str, memory: int = MEMORY) -> np.ndarray:
    """Which places of ``text`` begin a window that none before it equals.

    ``text`` has segments of the given lengths in the order of documents, as bytes plus 2, each with a 1 behind it, and a
    0 at the end. Places whose window leaves its segment mean nothing.
    """
    first = np.ones(len(text), bool)
    lead, many = -1, False  # the first place of the last group of equal windows, and whether it has others
    for place, share in suffixes(text, folder, memory, WINDOW):
        new = share < WINDOW
        if lead >= 0 and not new[0]:
            stop = int(new.argmax()) if new.any() else len(new)
            first[place[:stop]] = False
            first[lead] = False
            lead, many = min(lead, int(place[:stop].min())), True
            place, new = place[stop:], new[stop:]
        if not len(place):
            continue
        if many:
            first[lead] = True
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(place)))
        least = np.minimum.reduceat(place, start)
        first[place[np.repeat(size > 1, size)]] = False
        first[least[:-1]] = True
        lead, many = int(least[-1]), bool(size[-1] > 1)
    if many:
        first[lead] = True
    return first


def _spill_folder() -> str | None:
    """One of the folders that Spark names for the spills of this task."""
    return next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)), None)


def _sorted(memory: int):
    """(chunk, place, first): for each segment of a shard the bits of its windows that are first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        del held
        rows = rows.take(pa.array(np.lexsort([rows.column(c).to_numpy() for c in ("place", "chunk", "tie", "doc_id")])))
        data, bounds = flat(rows.column("segment"))
        _, kind, n = np.unique(rows.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
        many = n[kind] > 1
        lengths = np.diff(bounds)
        text = np.ones(int(lengths[many].sum()) + int(many.sum()) + 1, np.uint8)
        text[-1] = 0
        start = np.zeros(len(many), np.int64)
        start[many] = np.cumsum(lengths[many] + 1) - lengths[many] - 1
        taken = np.repeat(many, lengths)
        goal = np.arange(len(data)) + np.repeat(start - bounds[:-1], lengths)
        text[goal[taken]] = data[taken] + np.uint8(2)
        del goal, taken, data
        first = np.ones(len(text), bool)
        if many.any():
            with tempfile.TemporaryDirectory(dir=_spill_folder()) as folder:
                first = first_windows(lengths[many], text, folder, memory)
        bits = [np.packbits(first[a : a + n - WINDOW + 1] if m else np.ones(n - WINDOW + 1, bool)).tobytes() for a, n, m in zip(start.tolist(), lengths.tolist(), many.tolist(), strict=True)]
        found = pa.table({"chunk": rows.column("chunk"), "place": rows.column("place"), "first": pa.array(bits, pa.binary())})
        yield from found.combine_chunks().to_batches()

    return run


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the segments as a row of its own."""
    for batch in batches:
        for part in slices([batch], "segment", 1 << 17):
            data, bounds = flat(part.column("segment"))
            n = np.diff(bounds) - WINDOW + 1
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begin = np.repeat(bounds[:-1], n) + step
            spelled = np.ascontiguousarray(data[begin[:, None] + np.arange(WINDOW)])
            offsets = (np.arange(len(begin) + 1) * WINDOW).astype(np.int32)
            texts = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)])
            kept = [np.repeat(part.column(c).to_numpy(), n) for c in ("doc_id", "tie", "chunk", "place")]
            yield pa.record_batch([texts, *kept[:-1], kept[-1] + step], names=["window", "doc_id", "tie", "chunk", "place"])


def _first_of(segments: DataFrame, size: int) -> DataFrame:
    """(chunk, place, first) of all segments."""
    counted = segments.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor")
    hot = stored(counted, "hot")
    schema = "chunk long, place long, first binary"
    some = hot.first() is not None
    shards = max(1, -(-size // SHARD_BYTES))
    dealt = (segments.join(hot, "anchor", "left_anti") if some else segments).repartition(shards, "anchor")
    out = in_arrow(dealt, _sorted(MEMORY), schema)
    if some:
        single = in_arrow(segments.join(hot, "anchor", "left_semi"), _windows, "window binary, doc_id long, tie int, chunk long, place long")
        least = single.groupBy("window").agg(F.min(F.struct("doc_id", "tie", "chunk", "place")).alias("x"))
        out = out.unionByName(least.select("x.chunk", "x.place", F.unhex(F.lit("80")).alias("first")))
    return out


def _kept(packs: pa.Table, told: pa.Table) -> pa.Table:
    """The chunk's documents without what is repeated."""
    chunk = _Chunk(packs)
    pick = chunk.repeated(_anchors(told))
    begin, count = chunk.begin[pick], chunk.count[pick]
    edge = np.zeros(len(chunk.data) + 1, np.int32)
    edge[begin] += 1
    edge[begin + count] -= 1
    again = np.cumsum(edge[:-1]) > 0
    firsts = told.filter(told.column("first").is_valid())
    if firsts.num_rows:
        bits, bounds = flat(firsts.column("first"))
        row, pos = np.divmod(firsts.column("place").to_numpy(), 1 << 32)
        start = chunk.bounds[row] + pos
        place = np.repeat(start - 8 * bounds[:-1], 8 * np.diff(bounds)) + np.arange(8 * len(bits))
        again[place[np.unpackbits(bits).view(bool)]] = False
    edge[:] = 0
    place = np.flatnonzero(again)
    edge[place] += 1
    edge[place + WINDOW] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(gone)])
    before = np.concatenate([[False], gone[:-1]])
    before[chunk.bounds[:-1][chunk.bounds[:-1] < len(gone)]] = False
    after = np.concatenate([gone[1:], [False]])
    after[chunk.bounds[1:][chunk.bounds[1:] > 0] - 1] = False
    from_, to = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    at = np.searchsorted(from_, chunk.bounds)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    spans = pa.StructArray.from_arrays([pa.array(from_ - chunk.bounds[row]), pa.array(to - from_)], ["start", "length"])
    removed = np.diff(total[chunk.bounds])
    left = (chunk.bounds - total[chunk.bounds]).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(removed), [None, pa.py_buffer(left), pa.py_buffer(np.ascontiguousarray(chunk.data[~gone]))])
    return pa.table({
        "doc_id": chunk.doc_id, "n_bytes": np.diff(chunk.bounds), "n_removed": removed,
        "spans": pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans), "kept": kept,
    })


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row: what is removed (start, length) and the bytes left."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    parts = 2 * buckets
    packs = _bucketed(in_arrow(docs, _packed, "chunk long, pack binary"), buckets)
    asked = packs.groupBy("chunk").applyInArrow(_asked(parts), "part long, chunk long, twice int, anchors binary")
    told = stored(asked.groupBy("part").applyInArrow(_repeated, "chunk long, anchors binary"), "repeated")

    found = packs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_segments(parts), "part long, chunk long, rows binary")
    spans = -(-total // (SPAN * CHUNK_BYTES))
    if spans > 1:
        found = found.groupBy("part", F.pmod(F.xxhash64("chunk"), F.lit(spans))).applyInArrow(_distinct(True), "part long, chunk long, rows binary")
    segments = stored(found.groupBy("part").applyInArrow(_distinct(False), _TYPES), "segments")
    size = segments.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    firsts = stored(_first_of(segments, size), "firsts")

    told = told.unionByName(firsts, allowMissingColumns=True)
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:bigint,length:bigint>>, kept binary"
    return packs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_kept, schema)


def _bucketed(packs: DataFrame, buckets: int) -> DataFrame:
    """``packs`` written to the shared folder, one bucket of chunks in each file."""
    spark, path = packs.sparkSession, scratch_dir(packs.sparkSession, "packs")
    name = path.rpartition("/")[2].replace("-", "_")
    packs.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(name)
    return spark.table(name)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is left of each document."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
