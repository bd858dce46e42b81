"""Licence scans: canonical texts, hashed and joined to the digests of known licences and notices."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.tables import ascii_lower, row_key, whole_text

# Spellings that mean the same in a licence, other spelling first.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("merchantibility", "merchantability"), ("favour", "favor"), ("behaviour", "behavior"), ("fulfil", "fulfill"),
    ("organisation", "organization"), ("owner", "holder"), ("owners", "holders"), ("noncommercial", "non commercial"),
    ("whilst", "while"), ("wilful", "willful"), ("programme", "program"), ("per cent", "percent"), ("v3", "version 3"),
)

# Known licences, read where the query is planned: texts/<id>[.variant].txt, SPDX ids, and names and headers as id|wording.
DATA = Path(__file__).parent / "licence_data"
# How a notice line goes on to the name of a licence.
NOTICE_BEGINS = (
    "Released under the", "Licensed under the", "Licensed under", "Distributed under the", "Available under the",
    "This work is licensed under the", "This work is licensed under a", "This project is licensed under the",
    "This software is licensed under the", "This file is licensed under the", "This program is licensed under the",
)


def _pairs(name: str) -> list[tuple[str, str]]:
    return [tuple(line.split("|", 1)) for line in (DATA / name).read_text(encoding="utf-8").splitlines()]


NOTICES = tuple(dict.fromkeys(
    [(i, f"{begin} {name}.") for i, name in _pairs("names.txt") for begin in NOTICE_BEGINS]
    + [(i, f"SPDX-License-Identifier: {i}") for i in (DATA / "spdx_ids.txt").read_text(encoding="utf-8").split()]
    + _pairs("headers.txt")
))


def _texts() -> list[tuple[str, str]]:
    """The texts of the data folder; one with an appendix after its terms also without it."""
    found = []
    for path in sorted((DATA / "texts").iterdir()):
        text, end = path.read_text(encoding="utf-8"), "END OF TERMS AND CONDITIONS"
        name = path.name.removesuffix(".txt")
        for variant in ("numbers", "bullets"):
            name = name.removesuffix("-titled").removesuffix(f".{variant}")
        found += [(name, text)] + ([(name, text[:text.rindex(end) + len(end)])] if end in text else [])
    return found


_SHORT = (
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
)

# The short ones also without their title line.
TEXTS = (*_texts(), *((i, t.split("\n\n", 1)[1]) for i, t in _SHORT if i != "0BSD"), *_SHORT)

COPYRIGHT_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:copyright[^a-z0-9\n]*(?:\(c\)|©|c |[0-9]{4}|by )|\(c\)|©|all rights reserved\W*$)[^\n]*$"
)
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F©«»‘’“”–—]+"


def canonical(text: Column) -> Column:
    """Words of a text, line by line: A-Z in lower case, copyright lines empty, punctuation gone, one spelling.

    Words stand between two spaces each while spellings are replaced, so that neighbours don't share a space.
    """
    low = ascii_lower(text)
    hints = low.contains("copyright") | low.contains("(c)") | low.contains("©") | low.contains("all rights reserved")
    low = F.when(hints, F.regexp_replace(low, COPYRIGHT_LINE, "")).otherwise(low)
    words = F.regexp_replace(low, PUNCTUATION, "  ")
    words = F.concat(F.lit("  "), F.replace(words, F.lit("\n"), F.lit("  \n  ")), F.lit("  "))
    for other, one in EQUIVALENT:
        words = F.replace(words, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {one.replace(' ', '  ')} "))
    return F.regexp_replace(F.regexp_replace(words, " +", " "), " ?\n ?", "\n")


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def known_licences(spark: SparkSession) -> DataFrame:
    """license_id, scope ('text' or 'notice'), text."""
    rows = [(i, "text", t) for i, t in TEXTS] + [(i, "notice", t) for i, t in NOTICES]
    values = ", ".join("(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS known(license_id, scope, text)")


def license_scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """Which of `licences` (license_id, scope, text) each document is, as a whole, and which notices its lines are.

    Columns: doc_id, canonical_sha256 (of the whole canonical text), license_id (of the licence or notice whose
    canonical text the whole document is, the first by name; else null), notices (license ids of the lines that are
    a notice, distinct, sorted, comma-joined; empty without any), n_notice_lines. One row per row of `docs`.

    Texts are compared by the SHA-256 of their canonical form, in one hash join with all whole texts and one with
    all lines; a notice that most documents hold is looked up where it is read, as the few digests come to the rows.

    Null text is the empty text, which is no licence, nor is an empty line or a licence without words. Null ids
    and repeated rows are scanned like any other, a row each. Empty tables: no rows, or rows without licences.
    Licences that repeat a text under one id count once. Other columns are not read.
    """
    named = licences.select("license_id", "scope", one_line(canonical(whole_text())).alias("words")).filter("words <> ''")
    known = named.select("license_id", "scope", F.sha2("words", 256).alias("digest")).distinct()
    whole = known.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    notices = known.filter("scope = 'notice'").select("digest", F.col("license_id").alias("notice")).distinct()

    texts = docs.select("doc_id", *row_key(), canonical(whole_text()).alias("lines"))
    lines = texts.select("id", "mark", F.posexplode(F.split("lines", "\n")).alias("line", "words"))
    lines = lines.withColumn("words", F.trim("words")).filter("words <> ''")
    found = lines.select("id", "mark", "line", F.sha2("words", 256).alias("digest")).join(notices, "digest")
    found = found.groupBy("id", "mark").agg(
        F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"),
        F.count_distinct("line").alias("n_notice_lines"),
    )
    digests = texts.select("doc_id", "id", "mark", F.sha2(one_line(F.col("lines")), 256).alias("canonical_sha256"))
    return (
        digests.join(whole.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left")
        .join(found, ["id", "mark"], "left")
        .select(
            "doc_id", "canonical_sha256", "license_id", F.coalesce("notices", F.lit("")).alias("notices"),
            F.coalesce("n_notice_lines", F.lit(0)).alias("n_notice_lines"),
        )
    )
