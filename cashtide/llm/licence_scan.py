"""Licence scans by canonical digests.

A text is brought to a canonical form (letters A to Z in lower case, lines that only state a copyright removed, one
spelling for words that are written differently, punctuation and blanks as single blanks) and hashed as a
whole; the digest is looked up among those of known licence texts by a hash join. A licence file is found
whatever its line breaks, quotes, years and holders, and a text that only mentions a licence is not.

Within other texts licences are declared by notices of one line. Whole lines are looked up the same way, by their own
digests; only lines as long as some known notice are hashed, which drops no match.

All of it is column expressions; texts stay where they are read, and the result is one row a document.

Defined cases: a null text is empty; an empty text, or one that is empty in canonical form, matches nothing and has
the digest of the empty text. If two known licences have one canonical form, the first name stands. Repeated rows each have a row, null ids are kept. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Equivalent spellings of the usual matching guidelines for licence texts, as they look in lower case. Fixed values.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("non commercial", "noncommercial"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("fulfil ", "fulfill "),
    ("favour", "favor"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    (" & ", " and "),
    (" &\n", " and\n"),
    ("\n& ", "\nand "),
)
#: Those of several words, which may also be on two lines.
JOINED_SPELLINGS = tuple((other, usual) for other, usual in SPELLINGS if " " in other and other.replace(" ", "").isalpha())
#: Lines that only state a copyright: a paragraph's first line that begins with the word; lines that begin with a sign, or with the
#: word and then a sign, a year or a placeholder; "all rights reserved" alone. Other lines that begin with "copyright" go on with a sentence.
COPYRIGHT_PARAGRAPH = r"(^|\n[\x20\t\r]*\n)[^a-z0-9\n]*copyright[^\n]*"
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*((copyright[\x20\t]*)?(\(c\)|\x{a9})|copyright[\x20\t:]*([0-9]{4}|[<\[{])|all rights reserved[^a-z0-9\n]*$)[^\n]*$"
BETWEEN = r"[^a-z0-9\x{80}-\x{10FFFF}\n]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices of one line and what they declare.
NOTICES = (
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("Released under the MIT License.", "MIT"),
    ("Licensed under the MIT License.", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: ISC", "ISC"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC0 1.0.", "CC0-1.0"),
)


@cache
def licence_texts() -> tuple[tuple[str, str], ...]:
    """Name and text of the licences that come with the package."""
    return tuple((p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licences").glob("*.txt")))


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, lines kept apart."""
    text = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    text = F.regexp_replace(F.regexp_replace(text, COPYRIGHT_PARAGRAPH, "\n\n"), COPYRIGHT_LINE, "")
    for other, usual in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(usual))
    return F.regexp_replace(text, BETWEEN, " ")


def joined_lines(lines: Column) -> Column:
    """Lines in canonical form as one; spellings of several words are looked for again, across the line ends."""
    text = F.regexp_replace(lines, r"[ \n]+", " ")
    for other, usual in JOINED_SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(usual))
    return F.trim(text)


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_digests(known: DataFrame) -> DataFrame:
    """``digest, license`` of the rows ``license, text``."""
    text = joined_lines(canonical_lines(F.col("text")))
    rows = known.filter(F.col("license").isNotNull()).select(digest(text).alias("digest"), "license", text.alias("canonical"))
    return rows.filter(F.col("canonical") != "").groupBy("digest").agg(F.min("license").alias("license"))


def known_notices(spark: SparkSession, notices: tuple[tuple[str, str], ...]) -> tuple[list[int], dict[str, str]]:
    """Lengths and digests of the notices' canonical forms. A fixed list, hashed by the same expressions as the texts."""
    text = joined_lines(canonical_lines(F.col("text")))
    rows = spark.createDataFrame(list(notices), "text string, license string").select(F.length(text).alias("n"), digest(text).alias("d"), "license")
    found = rows.collect()
    return sorted({r["n"] for r in found}), {r["d"]: r["license"] for r in reversed(found)}


def scan(
    docs: DataFrame,
    known: DataFrame | None = None,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, digest, license, notices`` of every document.

    ``license`` is that of the whole text, if it is known; ``notices`` the licences its lines declare, in order and
    separated by commas, empty if there are none. ``known`` (``license, text``) replaces the built-in texts; it may be of any size.
    """
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(list(licence_texts()), "license string, text string")
    lengths, by_digest = known_notices(spark, notices)
    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), canonical_lines(F.col(text_column)).alias("lines"))
    lines = F.transform(F.split("lines", "\n"), lambda line: F.trim(line))
    likely = F.filter(lines, lambda line: F.length(line).isin(lengths)) if lengths else F.array().cast("array<string>")
    table = F.create_map(*(F.lit(x) for pair in by_digest.items() for x in pair)) if by_digest else F.create_map().cast("map<string,string>")
    declared = F.array_sort(F.array_distinct(F.filter(F.transform(likely, lambda line: F.try_element_at(table, digest(line))), lambda x: x.isNotNull())))
    marked = wanted.select("doc_id", digest(joined_lines(F.col("lines"))).alias("digest"), F.array_join(declared, ",").alias("notices"))
    return marked.join(known_digests(known), "digest", "left").select("doc_id", "digest", "license", "notices")
