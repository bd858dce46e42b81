from pyspark.sql import functions as F

from ebbline.llm.licences import TEXTS, known_licences, license_scan

MIT = dict(TEXTS)["MIT"]


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("lines", "digest", "line", "words", "notice", "license_id")}
    )
    rows = license_scan(docs, known_licences(spark)).collect()
    return [(r.license_id, r.notices, r.n_notice_lines) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_whole_texts_in_other_clothes(spark):
    dressed = "Copyright (c) 2024 Some Body\n  © 2021-2023 Others\nAll rights reserved.\n" + MIT
    texts = [
        MIT, MIT.upper(), MIT.replace(" ", "\n\t "), dressed, MIT.replace("sublicense", "sub­licence".replace("­", "")),
        MIT.replace("HOLDERS", "OWNERS"), MIT.replace(",", " --"), MIT + " and more", MIT.replace("NOT", ""),
    ]
    assert [x[0] for x in scan(spark, texts)] == ["MIT"] * 7 + [None, None]


def test_notices_and_edges(spark):
    texts = [
        None, "", "\n\n", "prose\nReleased under the MIT Licence!\nmore", "licensed under cc by-nc 4.0",
        "Licensed under the Apache License, Version 2.0.\n" * 3 + "Released under the MIT License.", "see the MIT License",
        "Licensed under the Apache License, Version 2.0. " * 2, "w " * 100_000 + "\nSPDX-License-Identifier: MIT",
    ]
    assert scan(spark, texts) == [
        (None, "", 0), (None, "", 0), (None, "", 0), (None, "MIT", 1), ("CC-BY-NC-4.0", "CC-BY-NC-4.0", 1),
        (None, "Apache-2.0,MIT", 4), (None, "", 0), (None, "", 0), (None, "MIT", 1),
    ]
    docs = spark.createDataFrame([(None, "x"), (None, "x"), (1, "x"), (1, MIT)], "doc_id long, text string")
    assert license_scan(docs, known_licences(spark)).count() == 4
    assert license_scan(docs.limit(0), known_licences(spark)).count() == 0
    assert license_scan(docs, known_licences(spark).limit(0)).filter("license_id is not null").count() == 0


def test_licences_beyond_those_of_the_supplied_documents(spark):
    known = {}
    for name, text in TEXTS:
        known.setdefault(name, text)
    whole = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"]
    found = scan(spark, ["Copyright 2020 Some Body\n\n" + known[i].upper().replace("\n", "\n   ") for i in whole])
    assert [x[0] for x in found] == whole
    lines = {
        "// SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", "# SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0-or-later",
        "Licensed under the Apache License 2.0": "Apache-2.0", "Licensed under the BSD 3-Clause Licence.": "BSD-3-Clause",
        "Released under the GNU GPL v3.": "GPL-3.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    }
    assert [x[1] for x in scan(spark, [f"code\n{line}\ncode" for line in lines])] == list(lines.values())
    rows = scan(spark, [f"SPDX-License-Identifier: {i}" for i in ("ISC", "Zlib", "EPL-2.0", "NoSuchLicense-1.0")])
    assert rows == [("ISC", "ISC", 1), ("Zlib", "Zlib", 1), ("EPL-2.0", "EPL-2.0", 1), (None, "", 0)]
