import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import repeats
from ebbline.llm.queries import QUERIES
from ebbline.llm.repeats import phrases, remove_repeats


def plain(texts, length):
    """Every string of the length in a table of places."""
    places = defaultdict(list)
    data = [(t or "").encode() for t in texts]
    for d, b in enumerate(data):
        for x in range(len(b) - length + 1):
            places[b[x:x + length]].append((d, x))
    gone = [bytearray(len(b)) for b in data]
    for found in places.values():
        if len(found) > 1:
            for d, x in found:
                gone[d][x:x + length] = b"\x01" * length
    out = []
    for b, g in zip(data, gone):
        kept = bytes(c for c, x in zip(b, g) if not x)
        spans = sum(1 for i, x in enumerate(g) if x and not (i and g[i - 1]))
        out.append((len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, length, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("id", "mark", "bytes", "first")}
    )
    rows = [tuple(r) for r in remove_repeats(docs, length).collect()]
    wanted = [(i, *w) for i, w in zip(ids, plain(texts, length))]
    order = lambda row: tuple((x is None, x) for x in row)
    assert sorted(rows, key=order) == sorted(wanted, key=order)
    return sum(w[2] for w in wanted)


def edited(draw, text, edits):
    chars = list(text)
    for _ in range(edits):
        chars[int(draw.integers(len(chars)))] = str(draw.choice(list("xyzäß ")))
    return "".join(chars)


def test_edges(spark):
    draw = np.random.default_rng(1)
    base = "".join(draw.choice(list("abcdeé "), 900))
    texts = [
        None, "", "short", "a" * 41, "a" * 40, "ab" * 300, "abc" * 200, base, base, base[100:139], base[100:140],
        base[200:245] + "#" + base[300:341], "x" + base[850:], base[:30] + "!" + base[30:], base[:400] + base[:400],
    ]
    assert check(spark, texts, 40) > 0
    ids = [None, None, 3, 3, 3, 0, 6, 7, 7, 9, 10, 11, 12, 13, 14]
    check(spark, texts, 40, ids)
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 40).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_edited_copies_and_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 700)  # texts are parsed in several blocks
    draw = np.random.default_rng(seed)
    word = lambda: "".join(draw.choice(list("aeinrst"), int(draw.integers(1, 6))))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(4)]
    texts = []
    for i in range(30):
        texts.append(prose(60) + "\n" + passages[i % 4][int(draw.integers(30)):] + prose(30) + passages[(i * 7) % 4])
    texts += [edited(draw, texts[int(draw.integers(30))], int(draw.integers(1, 12))) for _ in range(40)]
    texts += ["zz" * 400 + prose(5), "q" * 1_500, (prose(12) + "|") * 30]
    assert check(spark, texts, 64) > 0


@pytest.mark.parametrize("unit", ["a", "ab", "abc", "a line of text that is repeated, like this\n"])
def test_text_with_a_period_has_few_phrases(unit):
    data = np.frombuffer((unit * 70_000)[:1 << 16].encode(), dtype=np.uint8)
    found = phrases(data, [(0, 30_000), (30_000, len(data))], 400)
    assert len(found["first"]) < 20
    assert (found["until"] - found["first"] + 1).sum() == len(data) - 2 * 399  # every start is in one of them
    assert found["times"].sum() > len(found["times"])


def test_texts_with_periods(spark):
    draw = np.random.default_rng(3)
    noise = lambda n: "".join(draw.choice(list("abc"), n))
    line = noise(42) + "\n"
    texts = ["a" * 500, noise(50) + "a" * 41 + noise(50), "ab" * 90 + "c" + "ab" * 70, "b" + "ab" * 21, line * 9 + noise(70)]
    texts += [noise(30) + line * 2, line[:39], "a" * 40, (noise(100) + "#") * 3 + noise(100), noise(60) + "ac" * 45]
    assert check(spark, texts, 40) > 0


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ours = sorted(tuple(r) for r in QUERIES["op3_suffix_dedup"](spark, sf_dir).collect())
    assert ours == [(r.doc_id, *w) for r, w in zip(rows, plain([r.text for r in rows], 400))]
    assert sum(r[2] for r in ours) > 0
