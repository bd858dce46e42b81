import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ebbline.llm.components import components
from ebbline.llm.queries import QUERIES
from ebbline.llm.simhash import close_marks, simhash_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_mark(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [words[i:i + width] for i in range(len(words) - width + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, max_bits=3):
    """marks: [(id, mark)]; the smallest id reachable, by comparing all pairs."""
    names = sorted({m for _, m in marks})
    parent = {m: m for m in names}

    def root(m):
        while parent[m] != m:
            m = parent[m]
        return m

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    least = {}
    for i, m in marks:
        if i is not None:
            least[root(m)] = min(i, least.get(root(m), i))
    return [(i, f"{m:016x}", least.get(root(m))) for i, m in marks]


def key(row):
    return tuple((x is None, x) for x in row)


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    ours = [tuple(r)[:3] for r in QUERIES["op7_simhash"](spark, sf_dir).collect()]
    assert sorted(ours) == sorted(plain_components([(r.doc_id, plain_mark(r.text)) for r in docs]))


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE TWO three"), (8, "É é x y"),
        (None, "one"), (None, "nobody else says this"), (7, "ONE TWO three"), (9, "a\x1cb c d " * 90_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("mark", "fingerprint", "a", "node")}
    )
    ours = [tuple(r)[:3] for r in simhash_groups(docs).collect()]
    assert sorted(ours, key=key) == sorted(plain_components([(i, plain_mark(t)) for i, t in rows]), key=key)
    assert simhash_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5])
def test_every_close_pair_is_found(spark, max_bits):
    draw = np.random.default_rng(3)
    marks = draw.integers(0, 1 << 63, 40).tolist()
    for m in list(marks):
        for flips in (1, 2, 3, 4, 5, 6):
            marks.append(m ^ sum(1 << int(b) for b in draw.choice(64, flips, replace=False)))
    marks = sorted({m - (1 << 64) if m >> 63 else m for m in marks})
    table = spark.createDataFrame([(m,) for m in marks], "mark long")
    full = (1 << 64) - 1
    wanted = {
        (a, b) for i, b in enumerate(marks) for a in marks[:i] if ((a ^ b) & full).bit_count() <= max_bits
    }
    assert {tuple(r) for r in close_marks(table, max_bits).collect()} == wanted


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1001 + i) for i in range(200)]
    links = spark.createDataFrame(chain + star + [(5000, 5000)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1201)}
