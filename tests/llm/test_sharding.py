import zlib
from collections import Counter

from pyspark.sql import functions as F

from ebbline.llm import sharding
from ebbline.llm.sharding import stratified_shards


def test_counts_slots_and_mixture(spark, monkeypatch):
    rows = [(i, f"text {i}" * (i % 7), "big" if i % 3 else f"s{i % 2}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = stratified_shards(docs, shards=16).collect()
    per_shard = Counter(r.shard for r in found)
    assert set(per_shard) == set(range(16)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert sorted((r.shard, r.slot) for r in found) == sorted((s, k) for s, n in per_shard.items() for k in range(n))
    for source, n in Counter(s for *_, s in rows).items():
        for shard in range(16):
            assert abs(sum(r.shard == shard and r.source == source for r in found) - n / 16) <= 2
    monkeypatch.setattr(sharding, "LEAST_BUCKETS", 3)
    assert sorted(map(tuple, stratified_shards(docs, shards=16).collect()), key=str) == sorted(map(tuple, found), key=str)


def test_edges(spark):
    rows = [(1, None, None), (None, "É", "a"), (None, "É", "a"), (3, "", ""), (3, "", ""), (4, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit(1) for c in ("bucket", "rank", "key", "size", "shard", "stratum")}
    )
    found = stratified_shards(docs, shards=4).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32, r.source or "-") for r in found) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), s or "-") for i, t, s in rows
    )
    assert sorted(Counter(r.shard for r in found).values()) == [1, 1, 2, 2]
    assert stratified_shards(docs.limit(0)).count() == 0
