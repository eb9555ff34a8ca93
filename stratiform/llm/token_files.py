"""Token ids in binary files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank of frequency, so that the commonest take one byte. Four ranks share a
control byte, two bits each for a rank's length of one to four bytes; the ranks' bytes stand apart
from the control bytes. A reader looks the four lengths up in a table of 256 rows and gathers the
bytes of all ranks at once with numpy.

A file holds documents in ascending order of doc_id, and the files of a folder, by name, hold
ascending ranges. `ranks.bin` has the ids by rank. Layout of a file, all little-endian:

    magic TOK1, documents (u64), ids (u64), control bytes (u64), data bytes (u64),
    doc_id presence (u8 each), doc_ids (i64 each), ids of each document (u64 each), control, data

Tasks write each file under a name of its own and move it into place, so tasks may run again.

Defined cases. The string of a special token in a text gives that token's id, as the library does by
itself. Null text is empty: its only id is the end. A null doc_id comes first. Repeated
rows are kept, in the order of their texts' hashes. An empty table gives no files and no rows. A very long text
makes a larger file. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratiform.llm.files import write_file
from stratiform.llm.tables import in_arrow, stored, table
from stratiform.llm.texts import LOWER, SPACE, flat, slices, words
from stratiform.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END = 1
MAGIC = b"TOK1"
#: Ids in a file, about; a document is never cut.
FILE_IDS = 4_000_000
#: Pieces remembered by a Python worker: some 200 bytes each.
REMEMBERED = 1_200_000
#: New pieces that are encoded in one call.
TOGETHER = 256
#: Letters whose lower case and normal form are plain (ASCII and Latin-1, in UTF-8), or ASCII signs.
_LETTERS, _SIGNS = rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf]|\xc3\x9f)", rb"[!-/:-@\[-`{-~]"
PIECE = re.compile(_LETTERS + b"+|" + _SIGNS + b"+").fullmatch
WORD = re.compile(_LETTERS + b"*" + _SIGNS + b"*").fullmatch
_LETTER, _SIGN = 1, 2
#: The kind of each byte; the bytes of other letters begin with one of kind 0.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _SIGN
#: What a tokenizer has to do with text for that; it may have no token of its own that such words hold.
CUTTING = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
HEADER = "<4sQQQQ"

#: For each control byte the lengths of its four ranks.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a list of ranks below 2 ** 32."""
    ranks = np.asarray(ranks, "<u4")
    length = 1 + (ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = length - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    place = np.cumsum(length) - length
    data = np.empty(int(length.sum()), np.uint8)
    data[place] = ranks & 0xFF
    more = np.arange(len(ranks))
    for k in range(1, 4):  # fewer and fewer are so long
        more = more[length[more] > k]
        data[place[more] + k] = ranks[more] >> (8 * k) & 0xFF
    return control.tobytes(), data.tobytes()


def unpacked(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks back, ``n`` of them."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    place, data = np.cumsum(length) - length, np.frombuffer(data, np.uint8)
    out = data[place].astype("<u4")
    more = np.arange(n)
    for k in range(1, 4):
        more = more[length[more] > k]
        out[more] |= data[place[more] + k].astype("<u4") << np.uint32(8 * k)
    return out


class WordCoder:
    """Ids by the tokenizers library, for tokenizers that drop white space and never merge across it:
    words are encoded by themselves, and what was seen before is looked up. No special token may hold
    white space. If ``plain``, the strings of special tokens are ordinary text; the library takes them for the tokens.

    Tokenizers that lower-case and cut like ``CUTTING`` encode letters and the signs after them apart, whatever
    stands beside them. There a word that is letters and then signs counts as two pieces, its letters in lower case, and
    new pieces are encoded many at a time: each of them ends with the one id that has the suffix of a word's end."""

    def __init__(self, path: str, plain: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        #: Ids take two bytes where the vocabulary allows it.
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        made, suffix = json.loads(self.tokenizer.to_str()), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        own = [WORD(token["content"].lower().encode()) for token in made["added_tokens"]]
        self.cuts = bool(suffix) and {k: made[k] for k in CUTTING} == CUTTING and not any(own)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        if self.cuts:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as an array of ``kind``."""
        data, bounds = self.encoded(pa.array(texts, pa.string()))
        data, bounds = data.tobytes(), (bounds * np.dtype(self.kind).itemsize).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encoded(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``end`` if given, and where each text begins and ends (n + 1 bounds)."""
        data, at, bounds = self._pieces(*flat(texts))
        at = pa.array(at, pa.int32()).buffers()[1]
        pieces = pa.Array.from_buffers(pa.binary(), int(bounds[-1]), [None, at, pa.py_buffer(data)]).dictionary_encode()
        table, sizes = self._table(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = pieces.indices.to_numpy()
        if end is not None:  # one more piece
            table, sizes = np.append(table, np.array([end], self.kind)), np.append(sizes, 1)
            which, bounds = np.insert(which, bounds[1:], len(sizes) - 1), bounds + np.arange(len(bounds))
        n = sizes[which]
        to = np.concatenate([[0], np.cumsum(n)])
        begin = np.cumsum(sizes) - sizes
        return table[np.repeat(begin[which] - to[:-1], n) + np.arange(to[-1])], to[bounds]

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all words, where each piece begins and the last ends, and for each text the index of its first piece."""
        starts, ends, first = words(data, bounds)
        data = data[~SPACE[data]]
        at = np.concatenate([[0], np.cumsum(ends - starts)])
        if not self.cuts or not len(data):
            return data, at, first
        kind = _KIND[data]
        lead = np.flatnonzero(data == 0xC3)
        after = data[lead + 1]
        kind[lead[(after == 0x97) | (after == 0xB7)]] = 0  # the signs of multiplication and division
        turns = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        turns = turns[at[np.searchsorted(at, turns)] != turns]  # within a word
        odd = np.zeros(len(at) - 1, bool)
        wrong = np.concatenate([turns[(kind[turns] == _LETTER) & (kind[turns - 1] == _SIGN)], np.flatnonzero(kind == 0)])
        odd[np.searchsorted(at, wrong, "right") - 1] = True
        turns = turns[~odd[np.searchsorted(at, turns, "right") - 1]]
        low = LOWER[data]
        low[lead[(after >= 0x80) & (after <= 0x9E)] + 1] += 0x20
        data = np.where(np.repeat(odd, np.diff(at)), data, low)
        return data, np.insert(at, np.searchsorted(at, turns), turns), first + np.searchsorted(turns, at[first])

    def _table(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each of them has."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = list(map(self.known.get, pieces))
        if places := [i for i, ids in enumerate(found) if ids is None]:
            new = [pieces[i] for i in places]
            plain = list(map(bool, map(PIECE, new))) if self.cuts else [False] * len(new)
            self._learn([piece for piece, x in zip(new, plain, strict=True) if x])
            self._learn_each([piece for piece, x in zip(new, plain, strict=True) if not x])
            for i, piece in zip(places, new, strict=True):
                found[i] = self.known[piece]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        return np.frombuffer(b"".join(found), self.kind), sizes

    def _learn_each(self, pieces: list[bytes]) -> None:
        texts = [piece.decode() for piece in pieces]
        for piece, made in zip(pieces, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            self.known[piece] = array(self.kind, made.ids).tobytes()

    def _learn(self, pieces: list[bytes]) -> None:
        """The same for pieces that are letters or signs only."""
        width = np.dtype(self.kind).itemsize
        for i in range(0, len(pieces), TOGETHER):
            some = pieces[i : i + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.closes[ids]) + 1) * width).tolist()
            if len(ends) != len(some) or ends[-1] != ids.nbytes:  # a vocabulary without some byte's last form
                self._learn_each(some)
                continue
            raw = ids.tobytes()
            self.known.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))


@lru_cache(maxsize=2)
def coder(path: str, plain: bool = True) -> WordCoder:
    """Read once by each Python worker. Spark gives a task one core, so the library's threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordCoder(path, plain)


def _ids(path: str, end: int):
    """The ids of each document, and one more row for each task: how often each id occurs in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, False)
        total = np.zeros(0, np.int64)
        names = ["doc_id", "__ids", "__counts"]
        for part in slices(batches, "text"):
            data, bounds = code.encoded(part.column("text"), end)
            found = np.bincount(data, minlength=len(total))
            found[: len(total)] += total
            total = found
            bounds = pa.array(bounds * data.itemsize, pa.int32())  # refuses what doesn't fit
            ids = pa.Array.from_buffers(pa.binary(), len(part), [None, bounds.buffers()[1], pa.py_buffer(data)])
            yield pa.record_batch([part.column("doc_id"), ids, pa.nulls(len(ids), pa.binary())], names=names)
        if len(total):
            none = pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())
            yield pa.record_batch([*none, pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    return run


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of each task's counts."""
    for batch in batches:
        for counts in batch.column("__counts").to_pylist():
            n = np.frombuffer(counts, "<i8")
            used = np.flatnonzero(n)
            yield pa.record_batch([used, n[used]], names=["id", "n"])


def _writer(folder: str, kind: str, rank_of):
    """One file of the rows of each partition, which are in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        doc_ids, sizes, ids = [], [], []
        ranks = rank_of.value
        for batch in batches:
            doc_ids += batch.column("doc_id").to_pylist()
            data, bounds = flat(batch.column("__ids"))
            ids.append(ranks[data.view(kind)])
            sizes += (np.diff(bounds) // np.dtype(kind).itemsize).tolist()
        if not doc_ids:
            return
        control, data = packed(np.concatenate(ids))
        body = [
            struct.pack(HEADER, MAGIC, len(doc_ids), sum(sizes), len(control), len(data)),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(sizes, "<u8").tobytes(),
            control,
            data,
        ]
        write_file(f"{folder}/part-{number:08d}.tok", b"".join(body))
        yield pa.record_batch([[number], [len(doc_ids)]], names=["number", "documents"])

    return run


def _reader(id_of):
    """Documents of whole files, decoded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_by_rank = id_of.value
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                raw = content.as_buffer()
                magic, documents, n, control, data = struct.unpack_from(HEADER, raw)
                if magic != MAGIC:
                    raise ValueError(f"{name} isn't a token file")
                at = struct.calcsize(HEADER)
                present = np.frombuffer(raw, np.uint8, documents, at).astype(bool)
                doc_ids = np.frombuffer(raw, "<i8", documents, at := at + documents)
                sizes = np.frombuffer(raw, "<u8", documents, at := at + 8 * documents).astype(np.int64)
                at += 8 * documents
                ranks = unpacked(raw[at : at + control], raw[at + control : at + control + data], n)
                ids = ids_by_rank[ranks].astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                held, ends = memoryview(ids.view(np.uint8)), (4 * bounds).tolist()
                crc = [zlib.crc32(held[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.record_batch(
                    [
                        pa.array([int(name.rpartition("-")[2].removesuffix(".tok"))] * documents, pa.int64()),
                        pa.array(doc_ids, mask=~present),
                        bounds[:-1],
                        sizes,
                        pa.array(crc, pa.int64()),
                    ],
                    names=["number", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Files with the ids of all rows of ``docs`` (doc_id, text), each text closed by ``end``."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(TOKENIZER)
    kind = coder(path, False).kind
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    written = stored(in_arrow(docs, _ids(path, end), "doc_id long, __ids binary, __counts binary"), "tokens")
    encoded = written.filter("__ids is not null").drop("__counts")
    # as many rows as the vocabulary has ids, at most
    found = in_arrow(written.select("__counts").filter("__counts is not null"), _frequencies, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = (found.column(c).to_numpy().astype(np.int64) for c in ("id", "n"))
    ids = ids[np.lexsort((ids, -n))].astype("<u4")
    write_file(f"{folder}/ranks.bin", ids.tobytes())
    if not len(ids):
        return
    rank_of = np.zeros(int(ids.max()) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))
    files = max(1, -(-int(n.sum()) // FILE_IDS))
    ordered = (
        encoded.withColumn("__tie", F.xxhash64("__ids"))
        .repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "__tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "__tie")
        .drop("__tie")
    )
    made = in_arrow(ordered, _writer(folder, kind, spark.sparkContext.broadcast(rank_of)), "number long, documents long")
    made.agg(F.sum("documents")).collect()


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents in the files of a folder."""
    ranks = spark.read.format("binaryFile").load(f"{folder}/ranks.bin").select("content").first()
    schema = "number long, doc_id long, place long, n_tokens long, ids_crc32 long"
    if ranks is None or not ranks.content:
        return spark.createDataFrame([], schema).select("doc_id", F.col("place").alias("start"), "n_tokens", "ids_crc32")
    id_of = spark.sparkContext.broadcast(np.frombuffer(ranks.content, "<u4"))
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(folder).select("path", "content")
    rows = stored(in_arrow(whole, _reader(id_of), schema), "read")
    # one row for each file
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("number").agg(F.sum("n_tokens").alias("n"))
    files = files.select("number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(files, "number").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder)
