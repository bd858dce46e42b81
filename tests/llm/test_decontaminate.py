import re

import numpy as np
from pyspark.sql import functions as F

from ebbline.llm import decontaminate
from ebbline.llm.decontaminate import contamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(doc, items, window=10):
    have, hit, names = words(doc), set(), set()
    for name, text in items:
        w = words(text)
        width = min(window, len(w))
        for a in range(len(w) - width + 1 if w else 0):
            for at in range(len(have) - width + 1):
                if have[at:at + width] == w[a:a + width]:
                    hit.update(range(at, at + width))
                    names.add("null" if name is None else str(name))
    return len(have), len(hit), sorted(names)


def test_edges_equal_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(5)
    noise = [" ".join(draw.choice(["a", "B", "c3", "É", "e"], 40)) for _ in range(12)]
    texts = [
        None, "", "?!", "Stop", "stop words", "x", *noise, "... ".join(noise[0].split()), noise[0] + "," + noise[1],
        "one\x7ftwo_three", "a " * 5_000, noise[0], noise[0],
    ]
    items = [
        (1, noise[0]), (1, "stop"), (2, noise[1][6:50]), (None, "words"), (3, None), (4, ""), (5, "a a a"), (5, "a a a"),
        (11, "one two three"), (6, "B c3"), (7, "never there"), (8, "a " * 30),
    ]
    docs = spark.createDataFrame(
        [(None if i == 5 else i, t) for i, t in enumerate(texts)], "doc_id long, text string"
    ).withColumns({c: F.lit(1) for c in ("spans", "items", "n_words", "longest")})
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    wanted = sorted(
        ((-1 if i == 5 else i, *plain(t, items)) for i, t in enumerate(texts))
    )

    def result(**settings):
        rows = contamination(docs, tests, **settings).collect()
        return sorted(
            (-1 if r.doc_id is None else r.doc_id, r.n_words, sum(r.spans[1::2]) - sum(r.spans[0::2]), r["items"]) for r in rows
        )

    assert result() == wanted
    assert result(block_bytes=200) == wanted  # several blocks, hits of all united
    assert contamination(docs.limit(0), tests).count() == 0
    none = contamination(docs, tests.limit(0)).collect()
    assert sorted(r.n_words for r in none) == sorted(w[1] for w in wanted) and not any(r["items"] for r in none)


def plain_longest(doc, items, window=10):
    """(words, item, at) of the longest common run that holds a whole window; ties by name, then place."""
    have, found = words(doc), []
    for name, text in items:
        w = words(text)
        for a in range(len(w)):
            for at in range(len(have)):
                n = 0
                while a + n < len(w) and at + n < len(have) and w[a + n] == have[at + n]:
                    n += 1
                if n and n >= min(window, len(w)):
                    found.append((-n, "null" if name is None else str(name), at))
    n, name, at = min(found, default=(None, None, None))
    return found and (-n, name, at) or None


def longest(spark, texts, items, **settings):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id int, text string")
    rows = contamination(docs, tests, **settings).collect()
    return {r.doc_id: r.longest and tuple(r.longest) for r in rows}


def test_longest_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    copied = ["a"] * 30 + list(draw.choice(["a", "b"], 40)) + ["c"] * 20
    texts = ["a " * n for n in (5, 12, 40)] + [" ".join(copied[i:j]) + " x" for i, j in ((0, 50), (10, 90), (60, 90), (85, 90))]
    texts += [None, "", texts[4] + "," + texts[3], "b c", "x b c x b c"]
    items = [(1, " ".join(copied)), (20, "a " * 35), (3, "b c"), (None, " ".join(copied[20:60])), (5, None), (1, "b c")]
    wanted = {i: plain_longest(t, items) for i, t in enumerate(texts)}
    assert longest(spark, texts, items) == wanted
    assert longest(spark, texts, items, block_bytes=100) == wanted


def test_longest_of_many_places_that_share_their_first_words(spark, monkeypatch):
    """Whatever the shards and the order of their rows, the longest passage is found where it lies."""
    passage = [f"w{i}" for i in range(200)]
    texts = [" ".join(passage[:20]), "no " + " ".join(passage[:40]) + " no", " ".join(passage), " ".join(passage[5:100])]
    texts.append(" x ".join(texts))
    items = [(2, " ".join(passage)), (1, " ".join(passage))]
    wanted = {0: (20, "1", 0), 1: (40, "1", 1), 2: (200, "1", 0), 3: (95, "1", 0), 4: (200, "1", 64)}
    for size in (1_000_000, 30):
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", size)
        assert longest(spark, texts, items) == wanted


def test_small_shards_change_nothing(spark, sf_dir, monkeypatch):
    docs, tests = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, contamination(docs, tests).collect()), key=lambda r: r[0])
    items = [tuple(r) for r in tests.select("item_id", "text").collect()]
    block = decontaminate.Tests([(str(i), t) for i, t in items], 10)
    marked = 0
    for row in docs.select("doc_id", "text").collect():
        code = [block.vocabulary.get(w, 0) for w in decontaminate.words_of(row.text)]
        shard = decontaminate.Shard(block, [np.array(code, dtype=np.uint32)])
        window, at = shard.find(block)
        marked += len({p for w, a in zip(window, at) for p in range(a, a + block.window_width[w])})
    assert marked == sum(sum(s[1::2]) - sum(s[0::2]) for _, _, s, *_ in whole) > 0
