"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes deep. A byte that a context has not seen
is coded by an escape and the next shorter context, down to a uniform code over all bytes; escapes
are weighed by the number of different bytes a context has seen. The statistics are frozen after
training, so a text's code length in a language is a sum of fixed costs, one for each byte, and the
language with the shortest code wins. Texts are lower-cased and everything that isn't a letter
counts as one space, so that numbers and symbols speak for no language.

Training takes texts with a language whose crc32(doc_id) is not divisible by 5: pieces of PIECE bytes,
chosen by a hash of doc_id and place, of about TRAINED bytes shared evenly by the languages, however
long the documents are. The model is broadcast: that bound is its bound.

Defined cases. Null text, or text without a letter: `und`, score 0. No training text: `und` for all.
Equal code lengths: the language first in alphabetical order. Repeated rows: equal results. A row
without doc_id is held out. The whole text is scored, however long. lang, source, doc_id and extra
columns play no part in a prediction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.tables import beside, in_arrow, table
from stratiform.llm.texts import Lookup, flat, slices, sums

DEPTH = 3
FOLDS = 5
TRAINED = 16 << 20
PIECE = 4096
UNKNOWN = "und"
#: Belief below which the pipeline takes a language for unknown.
SURE = 0.5
#: Times the bits per byte of a language's own training texts beyond which the pipeline takes a text for foreign: the
#: belief only compares the known languages, and the best of them may be far from the text's own.
FOREIGN = 3.0

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x80:] = np.arange(0x80, 0x100)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and Latin-1 letters; other ASCII bytes are spaces."""
    out = _PLAIN[data]
    if len(data):
        wide = np.flatnonzero(data[:-1] == 0xC3) + 1
        capital = wide[(data[wide] >= 0x80) & (data[wide] <= 0x9E) & (data[wide] != 0x97)]
        out[capital] += 0x20
    return out


def codes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each byte behind the DEPTH bytes before it, as one number; zeros stand before a text."""
    out = data.astype(np.uint64)
    starts = bounds[:-1][np.diff(bounds) > 0]
    ends = bounds[1:][np.diff(bounds) > 0]
    for k in range(1, DEPTH + 1):
        before = np.zeros(len(data), np.uint64)
        before[k:] = data[:-k] if k < len(data) else 0
        for m in range(k):
            at = starts + m
            before[at[at < ends]] = 0
        out |= before << np.uint64(8 * k)
    return out


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Trees:
    """Frozen costs in nats of all known byte strings, by language, and of escapes."""

    def __init__(self, languages: list[str], grams: np.ndarray, counts: np.ndarray):
        """``grams``: distinct codes of DEPTH + 1 bytes; ``counts``: occurrences by gram and language."""
        self.languages = languages
        levels = [(grams, counts.astype(np.float64))]
        for k in range(DEPTH, 0, -1):
            levels.append(self._merged(levels[-1][0] & np.uint64((1 << 8 * k) - 1), levels[-1][1]))
        self.cost: list[tuple[Lookup, np.ndarray]] = []
        self.escape: list[tuple[Lookup, np.ndarray]] = []
        shorter = np.full((1, len(languages)), np.log(256))
        for level, (gram, n) in enumerate(reversed(levels)):
            context = gram >> np.uint64(8)
            known, place = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((2, len(known), len(languages)))
            np.add.at(total, place, n)
            np.add.at(kinds, place, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log(total + kinds) - np.log(kinds), 0.0)
                direct = np.log((total + kinds)[place]) - np.log(n)
            if level:
                below = shorter[self.cost[-1][0].find(gram & np.uint64((1 << 8 * level) - 1))]
            else:
                below = np.repeat(shorter, len(gram), axis=0)
            shorter = np.where(n > 0, direct, escape[place] + below)
            self.cost.append((Lookup(gram), shorter))
            self.escape.append((Lookup(known), escape.astype(np.float32)))
        self.cost = [(find, cost.astype(np.float32)) for find, cost in self.cost]
        #: Bits per byte that each language's training texts take in its own tree.
        self.usual = (counts * np.where(counts > 0, shorter, 0.0)).sum(axis=0) / np.maximum(counts.sum(axis=0), 1) / np.log(2)

    @staticmethod
    def _merged(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept, place = np.unique(gram, return_inverse=True)
        out = np.zeros((len(kept), n.shape[1]))
        np.add.at(out, place, n)
        return kept, out

    def code_lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Nats of each text in each language."""
        code = codes(data, bounds)
        find, cost = self.cost[-1]
        row = find.find(code)
        spent = cost[row]
        left = np.flatnonzero(row < 0)
        if len(left):
            spent[left] = self._shorter(code[left], DEPTH)
        return sums(spent, bounds)

    def _shorter(self, code: np.ndarray, level: int) -> np.ndarray:
        """Costs of bytes that no language has seen behind ``level`` bytes."""
        find, cost = self.escape[level]
        row = find.find((code & np.uint64((1 << 8 * (level + 1)) - 1)) >> np.uint64(8))
        out = np.where((row >= 0)[:, None], cost[row], np.float32(0))
        if not level:
            return out + np.float32(np.log(256))
        find, cost = self.cost[level - 1]
        row = find.find(code & np.uint64((1 << 8 * level) - 1))
        add = cost[row]
        left = np.flatnonzero(row < 0)
        if len(left):
            add[left] = self._shorter(code[left], level - 1)
        return out + add


def _drawn(place: np.ndarray, share: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte whether its piece is drawn, from a hash and a share for each text."""
    size = np.diff(bounds)
    n = -(-size // PIECE)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    x = np.repeat(place.view(np.uint64), n) + (number + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    taken = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53 < np.repeat(share, n)
    return np.repeat(taken, np.minimum(PIECE, np.repeat(size, n) - number * PIECE))


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the drawn pieces; a piece's first bytes stand behind the ones before it."""
    for part in slices(batches, "text"):
        langs = part.column("lang").dictionary_encode()
        where, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        for k, name in enumerate(names):
            rows = part.filter(pa.array(where == k))
            data, bounds = flat(rows.column("text"))
            drawn = _drawn(rows.column("__place").to_numpy(), rows.column("__share").to_numpy(), bounds)
            if drawn.any():
                gram, n = np.unique(codes(_letters(data), bounds)[drawn], return_counts=True)
                yield pa.record_batch([pa.array([name] * len(gram)), gram.astype(np.int64), n], names=["lang", "gram", "n"])


def train(docs: DataFrame, trained: int = TRAINED) -> Trees | None:
    """Trees of all languages in ``docs`` (doc_id, text, lang) outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").filter(
        (_fold() != 0) & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    if not sizes:
        return None
    share = trained / len(sizes)
    parts = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, share / r["bytes"]))))
    place = F.xxhash64(F.col("doc_id").cast("string")).alias("__place")
    given = known.select("text", "lang", place, parts[F.col("lang")].alias("__share"))
    rows = in_arrow(given, _gathered, "lang string, gram long, n long")
    found = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    languages = sorted({r["lang"] for r in sizes})
    grams, place_of = np.unique(found.column("gram").to_numpy().astype(np.uint64), return_inverse=True)
    counts = np.zeros((len(grams), len(languages)))
    at = {name: k for k, name in enumerate(languages)}
    counts[place_of, [at[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    return Trees(languages, grams, counts)


def _predictor(model):
    def make():
        trees = model.value

        def compute(part: pa.RecordBatch) -> list:
            data, bounds = flat(part.column("text"))
            lettered = sums(((_PLAIN[data] != 0x20) & (data < 0x80)).view(np.int8), bounds) > 0
            plain = np.flatnonzero(~lettered)
            for i, text in zip(plain, part.column("text").take(pa.array(plain)).to_pylist(), strict=True):
                lettered[i] = _has_letter(text)
            length = trees.code_lengths(_letters(data), bounds)
            nearest = length.min(axis=1)
            score = 1 / np.exp(np.maximum(nearest[:, None] - length, -700)).sum(axis=1)
            best = length.argmin(axis=1)
            lang = pa.array(np.where(lettered, np.array(trees.languages, object)[best], UNKNOWN), pa.string())
            bits = nearest / np.maximum(np.diff(bounds), 1) / np.log(2)
            return [lang, np.where(lettered, score, 0.0), bits, np.asarray(trees.usual, np.float64)[best]]

        return compute

    return make


def predicted(docs: DataFrame, trees: Trees | None, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (doc_id) of every row of ``docs``, with __lang, __score, __bits_per_byte, and the __usual_bits of
    that language's training texts."""
    keep = keep or ["doc_id"]
    if trees is None:
        none = [F.lit(UNKNOWN).alias("__lang"), F.lit(0.0).alias("__score"), F.lit(0.0).alias("__bits_per_byte"), F.lit(0.0).alias("__usual_bits")]
        return docs.select(*(f"`{c}`" for c in keep), *none)
    model = docs.sparkSession.sparkContext.broadcast(trees)
    return beside(docs, _predictor(model), {"__lang": "string", "__score": "double", "__bits_per_byte": "double", "__usual_bits": "double"}, keep)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, train(docs)).select(
        "doc_id",
        F.coalesce(_fold() == 0, F.lit(True)).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
        F.col("__bits_per_byte").alias("bits_per_byte"),
    )


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows whose language is known, with at least SURE of the belief, and that read like it: in its
    tree a text takes at most FOREIGN times the bits per byte that its training texts take."""
    found = predicted(docs, train(docs), docs.columns)
    known = (F.col("__lang") != UNKNOWN) & (F.col("__score") >= SURE)
    return found.filter(known & (F.col("__bits_per_byte") <= FOREIGN * F.col("__usual_bits"))).select(*docs.columns)
