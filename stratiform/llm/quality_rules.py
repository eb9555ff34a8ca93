"""Quality rules: a decision list learned by sequential covering.

Each document gets counts over its whole text. From labelled documents, rules for low quality are
grown one after another: a conjunction of thresholds grows by information gain on two thirds of the
labels that no rule covers yet, loses its last conditions while that helps on the other third, and
joins the list if it is precise enough there. The list becomes one Spark conditional expression.

The labels used are a sample of at most LABELS rows, those with the smallest hash of doc_id; counts
and verdicts cover all documents.

Defined cases. Null or empty text: all counts 0, base_failed true. No usable labels (none, null, or
contradicting): an empty list, so the base decides alone. Repeated rows are judged alike. Columns
other than doc_id and text, and extra columns of labels, are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.tables import beside, table
from stratiform.llm.texts import SPACE, flat, hash_spans, sums, windows, words

LABELS = 20_000
SYMBOLS = b"#*$%&|<>"
#: Share of low quality that a rule needs among the labels that prune it, and the least number of them.
PRECISION = 0.9
LEAST = 5
MAX_CONDITIONS = 4
MAX_RULES = 32
CUTS = 64

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_letters", "n_capitals", "n_digits", "n_exclamations", "n_ends",
]


def _marks(chosen: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chosen)] = True
    return out


_CAPITALS = _marks(bytes(range(65, 91)))
#: Lead bytes of two- and three-byte letters count as letters too: exact classes aren't needed here.
_LETTERS = _marks(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC3, 0xF0)))
_FLAGS = {
    "n_symbols": _marks(SYMBOLS),
    "n_letters": _LETTERS,
    "n_capitals": _CAPITALS,
    "n_digits": _marks(b"0123456789"),
    "n_exclamations": _marks(b"!"),
    "n_ends": _marks(b".?!"),
}
_FIRST_BYTES = ~_marks(bytes(range(0x80, 0xC0)))


def _repeats(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether each code occurs twice or more in its row."""
    order = np.lexsort((code, row))
    same = (code[order][1:] == code[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(code), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _distinct(row: np.ndarray, code: np.ndarray, rows: int) -> np.ndarray:
    """Number of different codes in each row."""
    order = np.lexsort((code, row))
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[order][1:] != code[order][:-1]) | (row[order][1:] != row[order][:-1])
    return np.bincount(row[order][fresh], minlength=rows)


def counts(column: pa.Array, window: int = 3) -> dict[str, np.ndarray]:
    """The counts of each text, by the names in COUNTS."""
    rows = len(column)
    data, bounds = flat(column)
    out = {name: sums(flags[data].view(np.int8), bounds) for name, flags in _FLAGS.items()}
    out["word_chars"] = sums((~SPACE[data] & _FIRST_BYTES[data]).view(np.int8), bounds)

    starts, ends, first = words(data, bounds)
    row = np.repeat(np.arange(rows), np.diff(first))
    hashes = hash_spans(data, starts, ends)
    out["n_words"] = np.diff(first)
    out["n_distinct_words"] = _distinct(row, hashes, rows)

    grams, at = windows(hashes, first, window)
    of = np.repeat(np.arange(rows), np.diff(at))
    begin = np.arange(len(grams)) - at[of] + first[of]
    begin = begin[_repeats(of, grams)]
    covered = np.zeros(len(hashes), bool)
    for k in range(window):
        covered[begin + k] = True
    out["n_repeat_words"] = sums(covered.view(np.int8), first)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    line_row = np.sort(np.concatenate([np.arange(rows), np.searchsorted(bounds, breaks, "right") - 1]))
    line_ends = np.minimum(np.append(line_starts[1:], len(data)), bounds[line_row + 1])
    line_ends -= (line_ends > line_starts) & (data[np.maximum(line_ends, 1) - 1] == 10) if len(data) else 0
    worded = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends, line_row = line_starts[worded], line_ends[worded], line_row[worded]
    out["n_lines"] = np.bincount(line_row, minlength=rows)
    out["n_dup_lines"] = out["n_lines"] - _distinct(line_row, hash_spans(data, line_starts, line_ends), rows)
    return out


def _counter():
    def compute(part: pa.RecordBatch) -> list:
        found = counts(part.column("text"))
        fields = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
        return [pa.StructArray.from_arrays(fields, COUNTS)]

    return compute


def with_counts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (doc_id) of every row of ``docs``, with a struct ``__counts`` of all counts
    and ``__base_failed``."""
    added = {"__counts": "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"}
    n_words, repeated = F.col("__counts.n_words"), F.col("__counts.n_repeat_words")
    failed = (n_words < 50) | (repeated * 100 > n_words * 50)
    return beside(docs, _counter, added, keep or ["doc_id"]).withColumn("__base_failed", failed)


def shares() -> dict[str, Column]:
    """What the rules have thresholds on; independent of a text's length."""

    def per(count: str, of: str) -> Column:
        return F.col(f"__counts.{count}") / F.greatest(F.col(f"__counts.{of}"), F.lit(1))

    return {
        "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "distinct_words": per("n_distinct_words", "n_words"),
        "repeated_lines": per("n_dup_lines", "n_lines"),
        "words_per_line": per("n_words", "n_lines"),
        "letters": per("n_letters", "word_chars"),
        "capitals": per("n_capitals", "word_chars"),
        "digits": per("n_digits", "word_chars"),
        "exclamations_per_word": per("n_exclamations", "n_words"),
        "ends_per_word": per("n_ends", "n_words"),
    }


#: A condition: column of the statistics, whether values at or above the cut (else below) hold, cut.
Condition = tuple[int, bool, float]


def _holds(x: np.ndarray, rule: list[Condition]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for column, above, cut in rule:
        out &= (x[:, column] >= cut) == above
    return out


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[tuple[np.ndarray, np.ndarray]]) -> list[Condition]:
    """Add the condition with the highest information gain, among equals the one with the widest gap
    around its cut, until no good document is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (~bad[inside]).any() and bad[inside].any():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best: tuple[tuple[float, float], Condition | None] = ((1e-9, 0.0), None)
        for column, (places, gaps) in enumerate(cuts):
            at = np.searchsorted(places, x[inside, column], "right")  # cuts at or below the value
            p_from = np.bincount(at, bad[inside], len(places) + 1)[::-1].cumsum()[::-1][1:]
            n_from = np.bincount(at, ~bad[inside], len(places) + 1)[::-1].cumsum()[::-1][1:]
            for above, p, n in ((True, p_from, n_from), (False, p0 - p_from, n0 - n_from)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0.0)
                if len(gain):
                    k = int(np.lexsort((gaps, gain.round(9)))[-1])
                    if (worth := (float(gain[k].round(9)), float(gaps[k]))) > best[0]:
                        best = (worth, (column, above, float(places[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _holds(x, rule[-1:])
    return rule


def _prune(x: np.ndarray, bad: np.ndarray, rule: list[Condition]) -> list[Condition]:
    """The leading conditions that are worth most on other labels."""

    def worth(k: int) -> float:
        got = _holds(x, rule[:k])
        return (bad[got].sum() + 1) / (got.sum() + 2)

    return rule[: max(range(len(rule), 0, -1), key=worth)] if rule else rule


def learn(x: np.ndarray, bad: np.ndarray, prune_row: np.ndarray) -> list[list[Condition]]:
    """An ordered list of rules for the rows in ``bad``."""
    rules: list[list[Condition]] = []
    cuts = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 1), method="lower")) if len(column) else column
        # between two values, so that no cut stands on an observed one
        values = np.unique(np.concatenate([values, np.unique(column)[: CUTS]]))
        cuts.append(((values[1:] + values[:-1]) / 2, np.diff(values) / (column.std() + 1e-12)))
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES:
        grow, check = left & ~prune_row, left & prune_row
        rule = _prune(x[check], bad[check], _grow(x[grow], bad[grow], cuts))
        got = _holds(x[check], rule) if rule else np.zeros(0, bool)
        if got.sum() < LEAST or bad[check][got].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~_holds(x, rule)
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """False for the first rule that holds, true if none does."""
    named = list(shares().values())
    out = F.lit(True)
    for rule in reversed(rules):
        conditions = [named[column] >= cut if above else named[column] < cut for column, above, cut in rule]
        out = F.when(reduce(Column.__and__, conditions), F.lit(False)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Rules from at most LABELS labelled documents that pass the base. The sample's ids are few
    by that bound, so they are broadcast."""
    sure = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter("quality = most")
        .select(F.col("doc_id").alias("labelled"), (F.col("quality") == 0).alias("bad"))
        .orderBy(F.xxhash64(F.col("labelled").cast("string")), "labelled")
        .limit(LABELS)
    )
    few = docs.select("doc_id", "text").join(F.broadcast(sure.select("labelled")), F.col("doc_id") == F.col("labelled"), "left_semi")
    found = with_counts(few).filter("not __base_failed").dropDuplicates(["doc_id"])
    found = found.join(F.broadcast(sure), F.col("doc_id") == F.col("labelled"))
    rows = found.select("bad", (F.pmod(F.xxhash64("labelled"), F.lit(3)) == 0).alias("prune"), *(v.alias(k) for k, v in shares().items())).toPandas()
    if not len(rows):
        return []
    rows = rows.sort_values(list(rows.columns))  # the order of arrival decides nothing
    return learn(rows.iloc[:, 2:].to_numpy(float), rows["bad"].to_numpy(bool), rows["prune"].to_numpy(bool))


def judged(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``with_counts`` and the verdict ``__kept``, for every row of ``docs``."""
    rules = fit(docs, labels)
    return with_counts(docs, keep).withColumn("__kept", ~F.col("__base_failed") & verdict(rules))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(
        "doc_id", *(f"__counts.{c}" for c in base), F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept")
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that the base and the learned list keep."""
    return judged(docs, table(spark, sf_dir, "labels"), docs.columns).filter("__kept").select(*docs.columns)
