"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

import pytest

WORDS = "the of and to in was for that river stone market early light people found several years between".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns of clashing names."""

    def make(rows):
        rows = [(*r, None)[:3] for r in rows]
        extra = [(i, t, g, "src0", 0, "x", 1.5, True, [7]) for i, t, g in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "n_words string, score double, kept boolean, ids array<int>"
        )
        return spark.createDataFrame(extra, schema)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Nulls, empties, ties, repeats and a very long text."""
    long_text = prose(5, 60_000)
    return make_docs([
        (1, prose(1, 80), "en"),
        (1, prose(1, 80), "en"),
        (2, prose(1, 80), "en"),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \t\n ", None),
        (6, "word", "en"),
        (7, "one two three", None),
        (None, prose(2, 70), "en"),
        (None, None, None),
        (8, long_text, "en"),
        (9, "a" * 50_000, None),
        (10, "é ß ñ 日本語 🙂 \x00   x", "fr"),
    ])
