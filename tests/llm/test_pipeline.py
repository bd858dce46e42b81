import hashlib

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import TABLES, compare
from ebbline.llm import queries, stages
from ebbline.llm.toxicity import fit_toxicity
from test_decontaminate import plain as plain_hits
from test_simhash import LOWER, plain_components, plain_mark


def kept_by_hand(spark, sf_dir):
    """The five stages over Python lists."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fit_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).scorer()
    docs = {i: t for i, t in docs.items() if score(t) < 0.5}
    last = {}
    for i, t in docs.items():
        last[t.translate(LOWER)] = max(i, last.get(t.translate(LOWER), i))
    docs = {i: docs[i] for i in last.values()}
    groups = plain_components([(i, plain_mark(t)) for i, t in docs.items()])
    docs = {i: docs[i] for i, _, component in groups if i == component}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    return {i: t for i, t in docs.items() if not plain_hits(t, items)[1]}


def test_run_equals_brute_force(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    wanted = kept_by_hand(spark, sf_dir)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(wanted)
    for r in rows:
        text = wanted[r.doc_id]
        assert r.ids == library.encode(text) and r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls, empty texts, repeated rows and clashing columns: each stage keeps whole rows, of copies one."""
    long = "word%d " * 5_000 % tuple(range(5_000))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "Same Text here", None), (4, "same text HERE", "de"), (None, long, "fr"),
        (5, long, "fr"), (6, "another thing entirely", "en"), (6, "another thing entirely", "en"), (None, "no id", None),
        (None, "no id either", None), (7, "same id one", "a"), (7, "but other words altogether", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(7) for c in ("mark", "score", "kept", "keep_id", "text_sha256", "spans", "items", "component", "document")}
    )
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert step(spark, docs.limit(0), sf_dir).count() == 0
        kept = [(r.doc_id, r.text) for r in out.collect()]
        if name == "exact_dedup":
            assert sorted(kept, key=str) == sorted([
                (2, ""), (4, "same text HERE"), (5, long), (6, "another thing entirely"), (None, "no id"),
                (None, "no id either"), (7, "same id one"), (7, "but other words altogether"),
            ], key=str)
        elif name == "simhash_dedup":
            assert sorted(kept, key=str) == sorted([
                (1, None), (3, "Same Text here"), (5, long), (6, "another thing entirely"), (None, "no id"),
                (None, "no id either"), (7, "same id one"), (7, "but other words altogether"),
            ], key=str)
        else:
            assert len(kept) == len(rows)
    last = stages.sentencepiece(spark, docs, sf_dir)
    assert last.count() == len(rows) and stages.sentencepiece(spark, docs.limit(0), sf_dir).count() == 0


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op") and n.split("_")[0][2:].isdigit()]
    assert sorted(int(n.split("_")[0][2:]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    verdict = compare(spark, db, name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert verdict.endswith("ok"), verdict
