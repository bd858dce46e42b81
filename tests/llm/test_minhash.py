import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import minhash
from ebbline.llm.minhash import ERRORS, SYMBOLS, chunks, minhash_groups, shingle_set, signature

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def plain(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(
        [(doc, len(s), least.get(root(i)), doc == least.get(root(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))], key=str
    )


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("node", "name", "signature", "n_shingles", "row", "hub", "component", "key", "id", "mark")}
    )
    return sorted([tuple(r) for r in minhash_groups(docs.repartition(3), **options).collect()], key=str)


def altered(words, share, draw):
    """The words with about `share` of their five-word shingles changed."""
    out = list(words)
    for at in draw.choice(len(words), max(1, round(share * len(words) / 5)), replace=False):
        out[at] = f"new{draw.integers(1 << 40)}"
    return " ".join(out)


def copies(count, seed, most=0.3):
    draw = np.random.default_rng(seed)
    base = [f"w{i}" for i in draw.integers(0, 10_000, 150)]
    return [altered(base, draw.uniform(0, most), draw) for _ in range(count)]


def test_whole_table_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == plain(rows)


def test_chains_of_near_copies(spark):
    """Each text is linked to its neighbours only: one component all the same."""
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(25):
        rows.append((100 - i, " ".join(words)))
        for at in draw.choice(300, 4, replace=False):
            words[at] = f"c{i}-{at}"
    assert found(spark, rows) == plain(rows) and len({r[2] for r in plain(rows)}) < 5


def test_a_large_group_in_small_blocks(spark, monkeypatch):
    """Near copies around the threshold, in many blocks of one unit, with guests from other units."""
    rows = list(enumerate(copies(120, 1) + copies(60, 2, 0.15) + copies(30, 3)))
    for size in (8, 512):
        monkeypatch.setattr(minhash, "BLOCK_SETS", size)
        assert found(spark, rows) == plain(rows)


def test_long_sets_split_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    rows = list(enumerate(copies(40, 7, 0.2)))
    assert found(spark, rows) == plain(rows)


def test_edges(spark):
    long = "a\x1cb C d e\x85f " * 60_000 + " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b"), (4, "One two"), (5, "one  TWO"), (6, "one two three four five"),
        (7, "ONE two three four five"), (None, "one two"), (None, "nobody else says these words"), (None, None),
        (8, long), (9, long + " tail"), (8, long), (10, "É é x y z"), (11, "é é x y z"),
        (None, "all of these ids are null here"), (None, "all OF these ids are null here"),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_percent_and_width(spark):
    rows = list(enumerate(copies(40, 9, 0.5)))
    for percent in (90, 100):
        assert found(spark, rows, percent=percent) == plain(rows, percent)


def test_chunks_hold_every_pair_within_the_errors():
    """Whatever ERRORS symbols differ, some chunk has one error at most."""
    parts = chunks()
    assert parts[0][0] == 0 and parts[-1][1] == SYMBOLS and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert 2 * len(parts) > ERRORS


@pytest.mark.parametrize("share", [0.1, 0.15])
def test_signatures_estimate_similarity(share):
    draw = np.random.default_rng(int(100 * share))
    differing = []
    for _ in range(60):
        both = draw.integers(0, 1 << 62, 400, dtype=np.uint64)
        cut = round(400 * share / (2 - 2 * share) * 2 / 2)
        a, b = np.append(both, draw.integers(0, 1 << 62, cut, dtype=np.uint64)), both
        similarity = len(both) / len(a)
        differing.append((signature(np.sort(a)) != signature(np.sort(b))).sum() - SYMBOLS * (1 - similarity))
    assert abs(np.mean(differing)) < 1.5


def test_shingles_of_the_contract():
    text = "A b\x1fc D  e\tf\n"
    assert len(shingle_set(text, 5)) == len(plain_set(text)) == 1
    assert len(shingle_set("a b c d e a b c d e", 5)) == 5
