from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratiform.llm.language_id import DEPTH, Trees, _drawn, _fold, _gathered, _letters, codes, keep_known, predicted, train
from stratiform.llm.tables import in_arrow, table
from stratiform.llm.texts import flat

from .conftest import prose

FRENCH = "le la des une que dans pour avec être très école forêt près où même années garçon".split()


def _trees(texts_by_language):
    names = sorted(texts_by_language)
    grams, counts = {}, []
    for k, name in enumerate(names):
        code = codes(_letters(flat(pa.array(texts_by_language[name]))[0]), flat(pa.array(texts_by_language[name]))[1])
        for c in code.tolist():
            grams.setdefault(c, [0] * len(names))[k] += 1
    keys = sorted(grams)
    return Trees(names, np.array(keys, np.uint64), np.array([grams[k] for k in keys], float))


def _brute(texts, text):
    """Code length in nats by walking the contexts of one language."""
    seen = {}
    for t in texts:
        line = b"\0" * DEPTH + _letters(np.frombuffer(t.encode(), np.uint8)).tobytes()
        for p in range(DEPTH, len(line)):
            for k in range(DEPTH + 1):
                context = seen.setdefault((k, line[p - k : p]), {})
                context[line[p]] = context.get(line[p], 0) + 1
    line = b"\0" * DEPTH + _letters(np.frombuffer(text.encode(), np.uint8)).tobytes()
    total = 0.0
    for p in range(DEPTH, len(line)):
        for k in range(DEPTH, -1, -1):
            context = seen.get((k, line[p - k : p]))
            if context:
                whole = sum(context.values()) + len(context)
                if line[p] in context:
                    total -= math.log(context[line[p]] / whole)
                    break
                total -= math.log(len(context) / whole)
        else:
            total += math.log(256)
    return total


def test_code_lengths_equal_a_walk_through_the_trees():
    texts = {"en": [prose(1, 40), prose(2, 30)], "fr": [prose(3, 50, FRENCH)]}
    trees = _trees(texts)
    for probe in ("the stone", "forêt Où", "zzz!? 9 xylo ж", "a", prose(9, 20, FRENCH)):
        found = trees.code_lengths(*(lambda d, b: (_letters(d), b))(*flat(pa.array([probe]))))[0]
        np.testing.assert_allclose(found, [_brute(texts[name], probe) for name in ("en", "fr")], rtol=1e-5)


def test_held_out_accuracy_and_awkward_rows(spark, make_docs, awkward):
    known = make_docs([(k, prose(k, 30), "en") for k in range(40)] + [(100 + k, prose(k, 30, FRENCH), "fr") for k in range(40)])
    trees = train(known)
    found = predicted(known, trees, ["doc_id", "lang"]).collect()
    assert all(x["__lang"] == x["lang"] and 0.5 < x["__score"] <= 1 for x in found)
    rows = predicted(awkward, trees).collect()
    assert len(rows) == awkward.count()
    by_id = {x["doc_id"]: x for x in rows if x["doc_id"] is not None}
    for k in (3, 4, 5):
        assert (by_id[k]["__lang"], by_id[k]["__score"]) == ("und", 0.0)
    assert by_id[8]["__lang"] == "en" and by_id[10]["__lang"] in ("en", "fr")
    assert all(0 <= x["__score"] <= 1 for x in rows)
    digits = predicted(make_docs([(1, "123 !? 456"), (2, "日本語")]), trees).collect()
    assert {x["doc_id"]: x["__lang"] == "und" for x in digits} == {1: True, 2: False}


def test_without_training_and_empty(spark, make_docs):
    nothing = make_docs([(1, "some words", None)])
    assert train(nothing) is None
    assert predicted(nothing, None).first()["__lang"] == "und"
    assert train(make_docs([])) is None
    assert keep_known(spark, make_docs([]), "").columns == nothing.columns


def test_few_long_documents_are_drawn_in_pieces(spark, make_docs):
    long = [(k, prose(k, 40_000, FRENCH), "fr") for k in range(8)]
    docs = make_docs(long + [(100 + k, prose(k, 300), "en") for k in range(400)])
    share = 60_000
    trees = train(docs, 2 * share)
    bounds = np.array([0, 50, 50, 20_000])
    assert _drawn(np.arange(3), np.ones(3), bounds).tolist() == [True] * 20_000
    found = predicted(docs, trees, ["lang"]).collect()
    assert all(x["__lang"] == x["lang"] for x in found)
    known = docs.filter((_fold() != 0) & F.col("lang").isNotNull())
    given = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    rows = known.join(given, "lang").select("text", "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("__place"), (share / F.col("bytes")).alias("__share"))
    drawn = {x["lang"]: x["n"] for x in in_arrow(rows, _gathered, "lang string, gram long, n long").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    assert set(drawn) == {"en", "fr"} and all(share / 2 < n < 2 * share for n in drawn.values())


FOREIGN_TEXTS = [
    "Это простой русский текст о погоде и о том, как люди живут у реки в старом городе. " * 8,
    "これは日本語の文章です。川のそばの古い町に住む人々について書かれています。" * 8,
    " ".join("xkqz wrtpl vbnm dfghj qwrt zxcv kjhg plmk".split() * 12),
    "Αυτό είναι ένα απλό κείμενο για τον καιρό και τους ανθρώπους. " * 8,
    "123 456 --- 789 !!! " * 20,
]


def test_stage_drops_foreign_texts_and_keeps_short_clean_ones(spark, make_docs):
    known = [(k, prose(k, 60), "en") for k in range(150)] + [(200 + k, prose(k, 60, FRENCH), "fr") for k in range(150)]
    short = [(500 + k, prose(900 + k, 12), None) for k in range(20)] + [(600 + k, prose(900 + k, 12, FRENCH), None) for k in range(20)]
    foreign = [(800 + k, text, None) for k, text in enumerate(FOREIGN_TEXTS)]
    kept = {x["doc_id"] for x in keep_known(spark, make_docs(known + short + foreign), "").collect()}
    assert kept == {i for i, _, _ in known + short}


def test_given_documents_read_like_their_language(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = predicted(docs, train(docs), ["doc_id", "lang"]).collect()
    ratio = sorted(x["__bits_per_byte"] / x["__usual_bits"] for x in rows if x["__lang"] != "und")
    assert ratio[-1] < 2.4 and len(ratio) > 0.95 * len(rows)
