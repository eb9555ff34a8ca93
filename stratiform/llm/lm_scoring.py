"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to DEPTH deep with the counts of all training texts, as Spark
tables of any size: one row for each byte string of the corpus, a level for each length. A byte that
a context has not seen is coded by an escape, weighed by the number of different bytes seen, and the
next shorter context, where the bytes that the longer one has seen are excluded. Below the shortest
stands a uniform code over the bytes not seen at all. Since a longer context has seen a subset of what
its suffix has seen, the exclusions of a step are those of the context just above, so each row's log
probability follows from the row of its suffix: one join and one window for each level.

No task holds the model. Documents are dealt into chunks by a hash; a chunk asks for the words and
byte strings that it holds, the tables answer by a join, and the chunk's documents are scored with
the answers. Texts travel as compressed packs, one for each task and chunk. What moves grows with
the corpus; a chunk's share is bounded by CHUNK_BYTES of text.

Defined cases. Null text: empty, one end token. A row without doc_id is held out. Repeated rows count
and score alike. No training text: counts of 0 and a uniform code. Texts are coded whole; a text
over CHUNK_BYTES makes a larger chunk. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.tables import in_arrow, ship, stored, table
from stratiform.llm.texts import LOWER, SLICE_BYTES, SPACE, Lookup, flat, hash_spans, slices, sums, words

DEPTH = 4
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 12 << 20
PACK_BYTES = 24 << 20
#: Stands before a text and ends it; no byte of UTF-8.
MARK = 0xFF


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each lower-case byte of each text and its end: that byte behind the DEPTH bytes before it,
    as one number; and the bounds of the rows."""
    data, bounds = flat(column)
    rows = len(column)
    size = np.diff(bounds) + 1
    at = np.concatenate([[0], np.cumsum(size)])
    line = np.full(at[-1] + DEPTH * rows, MARK, np.uint8)
    line[np.arange(len(data)) + np.repeat(np.arange(rows) * (DEPTH + 1) + DEPTH, size - 1)] = LOWER[data]
    out = np.zeros(len(line) - DEPTH if rows else 0, np.uint64)
    for k in range(DEPTH, -1, -1):
        out <<= np.uint64(8)
        out |= line[DEPTH - k : len(line) - k]
    if rows > 1:  # not those that end in the marks between two rows
        inner = np.ones(len(out), bool)
        inner[((at[1:-1] + np.arange(rows - 1) * DEPTH)[:, None] + np.arange(DEPTH)).ravel()] = False
        out = out[inner]
    return out, at


def tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words of all texts, and the bounds of the rows among them."""
    data, bounds = flat(column)
    data = LOWER[data]
    starts, ends, first = words(data, bounds)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    spelled = np.ascontiguousarray(data[~SPACE[data]])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)]), first


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each chunk in this task, compressed."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        whole = pa.concat_batches(held)
        held.clear()
        chunk, rows = whole.column("chunk").to_numpy(), whole.select(["doc_id", "held_out", "text"])
        order = np.argsort(chunk, kind="stable")
        found, starts = np.unique(chunk[order], return_index=True)
        packs = []
        for own in np.split(order, starts[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows.take(pa.array(own)))
            packs.append(sink.getvalue().to_pybytes())
        return pa.record_batch([pa.array(found, pa.int64()), pa.array(packs, pa.binary())], names=["chunk", "pack"])

    for part in slices(batches, "text"):
        if held and size + part.nbytes > PACK_BYTES:
            yield flush()
            size = 0
            pa.default_memory_pool().release_unused()
        held.append(part)
        size += part.nbytes
    if held:
        yield flush()


def _rows(packs: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk in slices of about SLICE_BYTES, however many packs they lie in: a pack is as small as
    the corpus is large, and what is done for each slice takes its time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for pack in packs.column("pack"):
        for part in slices(pa.ipc.open_stream(pack.as_buffer()), "text"):
            if held and size + part.nbytes > SLICE_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.concat_batches(held)


def _asked(packs: pa.Table) -> pa.Table:
    """What the documents of a chunk ask for, with their own counts for training."""
    grams, weights, spelled = [], [], []
    for part in _rows(packs):
        train = (~part.column("held_out").to_numpy(zero_copy_only=False)).astype(np.int64)
        code, at = codes(part.column("text"))
        found, n = np.unique(code << np.uint64(1) | np.repeat(train.astype(np.uint64), np.diff(at)), return_counts=True)
        grams.append(found >> np.uint64(1))
        weights.append(n * (found & np.uint64(1)).astype(np.int64))
        word, first = tokens(part.column("text"))
        spelled.append(pa.table({"word": word, "n": np.repeat(train, np.diff(first))}).group_by("word").aggregate([("n", "sum")]))
    pa.default_memory_pool().release_unused()  # a worker serves many chunks
    gram, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]), return_inverse=True)
    n = np.bincount(place, np.concatenate([np.zeros(0), *weights]), len(gram)).astype(np.int64)
    found = pa.concat_tables(spelled).rename_columns(["word", "n"]).group_by("word").aggregate([("n", "sum")])
    of_words, of_grams = pa.nulls(found.num_rows, pa.int64()), pa.nulls(len(gram), pa.binary())
    return pa.table({
        "chunk": pa.array(np.full(len(gram) + found.num_rows, packs.column("chunk")[0].as_py())),
        "gram": pa.concat_arrays([pa.array(gram.astype(np.int64)), of_words]),
        "word": pa.concat_arrays([of_grams, *found.column("word").chunks]),
        "n": pa.concat_arrays([pa.array(n), *found.column("n_sum").chunks]),
    })


def _level(longer: DataFrame, level: int) -> DataFrame:
    """Counts of the strings of ``level`` + 1 bytes, from those one byte longer."""
    return longer.groupBy(F.expr(f"code & {(1 << 8 * (level + 1)) - 1}L").alias("code")).agg(F.sum("c").alias("c"))


def _scored(rows: DataFrame, level: int, shorter: DataFrame | None) -> DataFrame:
    """``rows`` (code, c) of a level with what the next level and the answers need:

    n, d: how often and how many different bytes the context has seen; direct: log probability of the
    last byte behind the context; excluded: the same after an escape from the context.
    """
    if shorter is not None:
        low = shorter.select(F.col("code").alias("low"), *(F.col(c).alias(f"low_{c}") for c in ("c", "n", "d", "direct", "excluded")))
        rows = rows.withColumn("low", F.expr(f"code & {(1 << 8 * level) - 1}L")).join(low, "low")
    rows = rows.withColumn("context", F.shiftright("code", 8))
    context = Window.partitionBy("context")
    seen = F.col("c") > 0
    rows = rows.withColumn("n", F.sum("c").over(context)).withColumn("d", F.sum(seen.cast("long")).over(context))
    if shorter is None:
        excluded = -F.log(F.lit(256) - F.when(F.col("d") < 256, F.col("d")).otherwise(0))
        below = -F.log(F.lit(256.0))
    else:
        rows = rows.withColumn("same", F.sum(F.when(seen, F.col("low_c")).otherwise(0)).over(context))
        left = F.col("low_n") - F.col("same") + F.col("low_d") - F.col("d")
        weight = F.when(F.col("low_c") > 0, F.col("low_c")).otherwise(F.col("low_d") - F.col("d"))
        deeper = F.when(F.col("low_c") > 0, F.lit(0.0)).otherwise(F.col("low_excluded"))
        excluded = F.when(left > 0, F.log(weight) - F.log(left) + deeper).otherwise(F.col("low_excluded"))
        below = F.col("low_direct")
    both = F.log(F.col("n") + F.col("d"))
    direct = (
        F.when(F.col("n") == 0, below)
        .when(seen, F.log(F.greatest("c", F.lit(1))) - both)
        .otherwise(F.log(F.greatest("d", F.lit(1))) - both + excluded)
    )
    return rows.select("code", "c", "n", "d", direct.alias("direct"), F.when(seen, F.lit(0.0)).otherwise(excluded).alias("excluded"))


def log_probabilities(grams: DataFrame) -> DataFrame:
    """(code, direct): log probability of the last byte of every string of DEPTH + 1 bytes in ``grams``
    (code, c), where c is 0 for strings that only held-out texts have."""
    levels = [grams]
    for level in range(DEPTH - 1, -1, -1):
        levels.append(stored(_level(levels[-1], level), f"level-{level}"))
    found = None
    for level, rows in enumerate(reversed(levels)):
        found = stored(_scored(rows, level, found), f"scored-{level}")
    return found.select("code", "direct")


def _finder(listed: pa.Array) -> Callable[[pa.Array], np.ndarray]:
    """The function that finds the places of words in ``listed``, which has all of them: by their hashes, unless
    two listed words share one or one is longer than a slice."""

    def by_index(word: pa.Array) -> np.ndarray:
        return pc.index_in(word, value_set=listed).to_numpy(zero_copy_only=False).astype(np.int64)

    def hashes(word: pa.Array) -> np.ndarray:
        found = [np.zeros(0, np.uint64)]
        for part in slices([pa.record_batch([word], names=["word"])], "word"):
            data, bounds = flat(part.column("word"))
            found.append(hash_spans(data, bounds[:-1], bounds[1:]))
        return np.concatenate(found)

    if (pc.max(pc.binary_length(listed)).as_py() or 0) > SLICE_BYTES:
        return by_index
    known = hashes(listed)
    order = np.argsort(known)
    known = known[order]
    if (known[1:] == known[:-1]).any():
        return by_index
    return lambda word: order[np.searchsorted(known, hashes(word))]


def _scorer(total: int, different: int, train_docs: int):
    """Scores of a chunk's documents from the answers to what it asked."""

    def score(packs: pa.Table, answers: pa.Table) -> pa.Table:
        of_words = answers.filter(pc.is_valid(answers.column("word")))
        counts, place = of_words.column("c").to_numpy(), _finder(of_words.column("word").combine_chunks())
        of_grams = answers.filter(pc.is_valid(answers.column("gram")))
        find, logs = Lookup(of_grams.column("gram").to_numpy().astype(np.uint64)), of_grams.column("direct").to_numpy()
        out = []
        for part in _rows(packs):
            code, at = codes(part.column("text"))
            score = sums(logs[find.find(code)], at) / np.log(10)
            word, first = tokens(part.column("text"))
            c = counts[place(word)]
            n = np.diff(first) + 1
            base = sums(np.log10(c + 1.0), first) + np.log10(train_docs + 1.0) - n * np.log10(total + different + 1.0)
            columns = [part.column("doc_id"), part.column("held_out"), n, sums((c > 0).view(np.int8), first) + (train_docs > 0), base, score]
            out.append(pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        answers = of_words = of_grams = place = None
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(out)

    return score


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", _held_out().alias("held_out"), "text")
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("size"), F.sum((~F.col("held_out")).cast("long")).alias("train")).first()
    train_docs = sizes["train"] or 0
    chunks = max(1, -(-(sizes["size"] or 0) // chunk_bytes))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    packs = in_arrow(dealt, _packed, "chunk long, pack binary")

    asked = stored(packs.groupBy("chunk").applyInArrow(_asked, "chunk long, gram long, word binary, n long"), "asked")
    spelled, grams = asked.filter("word is not null"), asked.filter("gram is not null").withColumnRenamed("gram", "code")
    counted = spelled.groupBy("word").agg(F.sum("n").alias("c"))
    whole = counted.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    total, different = (whole["n"] or 0) + train_docs, (whole["v"] or 0) + (train_docs > 0)

    model = log_probabilities(stored(grams.groupBy("code").agg(F.sum("n").alias("c")), "grams"))
    none = F.lit(None)
    of_words = spelled.join(counted, "word").select("chunk", none.cast("long").alias("gram"), none.cast("double").alias("direct"), "word", "c")
    of_grams = grams.join(model, "code").select("chunk", F.col("code").alias("gram"), "direct", none.cast("binary").alias("word"), none.cast("long").alias("c"))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = packs.groupBy("chunk").cogroup(of_words.unionByName(of_grams).groupBy("chunk")).applyInArrow(
        _scorer(total, different, train_docs), schema
    )
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
