import textwrap

import pytest

from cashtide.llm.licence_scan import licence_texts, scan

TEXTS = dict(licence_texts())


def altered(text):
    text = text.replace("Copyright (c) <year> <copyright holders>", "Copyright (c) 1999-2024 Somebody\n(C) 2001 Another, Inc.\nAll rights reserved.")
    return text.replace('"', "``").replace(". ", ".\n   ").upper().replace("SUBLICENSE", "SUB-LICENCE")


@pytest.fixture
def found(documents):
    return lambda rows, **options: {r["doc_id"]: r for r in scan(documents([(i, t, None, None) for i, t in rows]), **options).collect()}


def test_whole_texts(found):
    rows = list(enumerate(TEXTS.values())) + [(50, altered(TEXTS["MIT"])), (51, TEXTS["MIT"] + " More."), (52, "About:\n" + TEXTS["ISC"])]
    got = found(rows)
    assert [got[i]["license"] for i in range(len(TEXTS))] == list(TEXTS)
    assert got[50]["license"] == "MIT" and got[51]["license"] is None and got[52]["license"] is None
    assert len({r["digest"] for r in got.values()}) == len(rows) - 1


def test_notices_are_whole_lines(found):
    got = found([(1, "Some text.\n// Released under the MIT licence\nmore\n  licensed under CC BY-NC 4.0."), (2, "It was Released under the MIT License. Then"),
                 (3, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT")])
    assert [got[i]["notices"] for i in (1, 2, 3)] == ["CC-BY-NC-4.0,MIT", "", "MIT"]


def test_null_empty_long_and_repeated(found, documents):
    got = found([(1, None), (2, ""), (3, "Copyright 2020 X"), (4, "word " * 100_000), (None, TEXTS["0BSD"])])
    assert got[1]["digest"] == got[2]["digest"] == got[3]["digest"] != got[4]["digest"]
    assert all(got[i]["license"] is None and got[i]["notices"] == "" for i in (1, 2, 3, 4)) and got[None]["license"] == "0BSD"
    assert scan(documents([(1, TEXTS["MIT"], None, None)] * 2)).count() == 2


def test_own_table_of_licences(spark, found):
    known = spark.createDataFrame([("own", "Do what you like"), ("other", "do WHAT you, like!"), ("void", " "), (None, "x")], "license string, text string")
    got = found([(1, "Do what\nyou like."), (2, ""), (3, "x")], known=known, notices=())
    assert [got[i]["license"] for i in (1, 2, 3)] == ["other", None, None]


def test_empty_table(documents):
    assert scan(documents([])).count() == 0


@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n * "])
def test_wrapped_texts(found, gap):
    """Every text, its paragraphs wrapped at any usual width and with other line ends, is found."""
    rows, names = [], []
    for width in range(50, 101, 2):
        for name, text in TEXTS.items():
            rows.append((len(rows), gap.join(line for part in text.splitlines() for line in (textwrap.wrap(part, width) or [""]))))
            names.append(name)
    got = found(rows)
    assert [got[i]["license"] for i in range(len(rows))] == names


def test_copyright_lines(found):
    body = TEXTS["MIT"].split("<copyright holders>")[1]
    heads = ["Copyright (c) 2001 A", "Copyright 2001-2004, A", "Copyright The A Authors", "\u00a9 2020 A", "(C) A\n  All Rights Reserved.", "Copyright [yyyy] A", "COPYRIGHT: 1999 A", ""]
    got = found([(i, "MIT License\n\n" + head + body) for i, head in enumerate(heads)])
    assert [got[i]["license"] for i in range(len(heads))] == ["MIT"] * len(heads)


def test_spellings_across_line_ends(found, spark):
    known = spark.createDataFrame([("own", "You may sublicense this and that to copyright holders for ten percent, fulfill and go")], "license string, text string")
    text = "You may sub-\nlicense this &\nthat to copyright\nowners for ten per\ncent, fulfil\nand go"
    assert found([(1, text)], known=known)[1]["license"] == "own"
