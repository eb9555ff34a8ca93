from __future__ import annotations

import textwrap

from pyspark.sql import functions as F

from stratiform.llm.license_scan import _digest, _line_digests, licences, scan
from stratiform.llm.license_texts import TEXTS, every, known, long_texts


def test_whole_texts_and_notices(spark, make_docs):
    mit, isc = TEXTS["MIT"], TEXTS["ISC"]
    docs = make_docs([
        (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper()),
        (2, "  (C) 1999 X.\n" + " ".join(isc.replace("license", "licence").split()).replace("'", '"') + "\nAll rights reserved."),
        (3, mit + " And more."),
        (4, "Some words.\nReleased under the MIT Licence\nand Licensed under CC BY-NC 4.0."),
        (4, "Some words.\nReleased under the MIT Licence\nand Licensed under CC BY-NC 4.0."),
        (5, "some words\n  * This work is licensed under the GNU General Public License, Version 3!\n# released under the MIT license"),
        (6, None),
        (7, "  \n "),
        (None, "Licensed under the Apache License, Version 2.0."),
        (8, "Released under the MIT License. " * 2),
    ])
    found = [tuple(x) for x in scan(docs, licences(spark)).select("doc_id", "licence", "notices").collect()]
    assert sorted(found, key=repr) == sorted([
        (1, "MIT", ""), (2, "ISC", "ISC"), (3, None, ""), (4, None, "MIT"), (4, None, "MIT"), (5, None, "GPL-3.0,MIT"),
        (6, None, ""), (7, None, ""), (None, "Apache-2.0", "Apache-2.0"), (8, None, ""),
    ], key=repr)


def test_empty_and_awkward(spark, make_docs, awkward):
    registry = licences(spark)
    assert scan(make_docs([]), registry).count() == 0
    assert scan(awkward, registry).count() == awkward.count()
    assert scan(awkward, registry.limit(0)).filter("licence is not null or notices <> ''").count() == 0


def test_every_known_text_is_found(spark, make_docs):
    rows = list(enumerate(text for _, text in known()))
    found = {x["doc_id"]: x["licence"] for x in scan(make_docs(rows), licences(spark)).collect()}
    assert [found[k] for k, _ in rows] == [licence for licence, _ in known()]


def wrappings(text: str) -> list[str]:
    """As stored, in 80 columns, in 60 columns, and on one line."""
    paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
    return [text, *("\n\n".join(textwrap.fill(p, n) for p in paragraphs) for n in (80, 60)), " ".join(paragraphs)]


def test_wrapping_title_and_copyright_do_not_matter(spark, make_docs):
    heads = ["", "Copyright (c) 2020 J. Smith, Foo Inc.\n\n", "Copyright 2019-2021 Some Body\nCopyright (c) Other. All rights reserved.\n\n"]
    titles = {"MIT": "The MIT License (MIT)\n\n", "ISC": "ISC License\n\n", "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License\n\n'}
    rows, expected = [], []
    for name, title in titles.items():
        for head in heads:
            for text in wrappings(TEXTS[name]):
                for whole in (head + text, title + head + text, " ".join((title + head + text).split())):
                    rows.append((len(rows), whole))
                    expected.append(name)
    found = {x["doc_id"]: x["licence"] for x in scan(make_docs(rows), licences(spark)).collect()}
    assert [found[k] for k, _ in rows] == expected


def test_only_copyright_statements_go(spark, make_docs):
    mit = TEXTS["MIT"]
    rows = [
        (1, mit.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR\n", "")),
        (2, "Copyright (c) 2020 Smith. Another condition holds. " + " ".join(mit.split())),
        (3, "Copyright law is old.\nThe rest."),
        (4, "The rest."),
        (5, "Copyright (c) 2020 Smith. One story."),
        (6, "Copyright (c) 2020 Smith. Another story."),
        (7, "ISC License\nThe rest."),
    ]
    found = {x["doc_id"]: x for x in scan(make_docs(rows), licences(spark)).collect()}
    assert {k: x["licence"] for k, x in found.items()} == dict.fromkeys(range(1, 8))
    assert len({x["text_digest"] for x in found.values()} - {None}) == 7


def test_long_texts_in_any_wrapping(spark, make_docs):
    rows, expected = [], []
    for name, text in long_texts():
        for whole in wrappings(text):
            rows.append((len(rows), whole))
            expected.append(name)
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"} <= set(expected)
    apache = dict(reversed(long_texts()))["Apache-2.0"]
    rows.append((len(rows), apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Foo Inc.")))
    expected.append("Apache-2.0")
    rows += [(len(rows) + k, text) for k, (_, text) in enumerate(every())]
    expected += [licence for licence, _ in every()]
    found = {x["doc_id"]: x["licence"] for x in scan(make_docs(rows), licences(spark)).collect()}
    assert [found[k] for k, _ in rows] == expected


def test_registry_from_a_table(spark, make_docs):
    texts = spark.createDataFrame([("Own", "Do what\nyou like."), ("Other", None)], "licence string, text string")
    docs = make_docs([(1, "Copyright (c) 2020 X\nDo what you\nlike."), (2, TEXTS["MIT"])])
    assert sorted((x["doc_id"], x["licence"]) for x in scan(docs, licences(spark, texts)).collect()) == [(1, "Own"), (2, None)]


def test_lines_at_once_equal_lines_alone(spark, make_docs, awkward):
    odd = "The MIT License\n(c) 2020 X\ncopyright\n(c) 1999 Y. Z\nversion\n2 & version 3\r\nGNU\nGPL, gnu  gpl\rISC License © Q\n\nCopyright [yyyy]\n[name] 51 Franklin St\nUSA all rights\nreserved"
    texts = [odd, odd.replace("\n", " "), *(w for _, text in every() for w in wrappings(text))]
    docs = make_docs(list(enumerate(texts, 100))).unionAll(awkward)
    alone = F.expr(f"transform(split(text, '\\\\n'), line -> {_digest('line')})")
    assert docs.filter(~alone.eqNullSafe(F.expr(_line_digests("text")))).count() == 0
