import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ebbline.llm import toxicity
from ebbline.llm.queries import QUERIES
from ebbline.llm.quality import FEATURES, Buckets, quality_scores, train_network
from ebbline.llm.tables import held_out_remainder
from ebbline.llm.toxicity import (
    _examples, _only, fit_toxicity, hashed_features, swap_terms, text_words, toxicity_scores, word_features,
)


def area(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def held_out(spark, name, label, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    rows = QUERIES[name](spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    return np.array([r.score for r in rows]), np.array([r.label for r in rows]), np.array([r.predicted for r in rows])


def test_quality_on_held_out_rows(spark):
    scores, labels, predicted = held_out(spark, "op2_quality", "quality", "/root/testdata/sf0.01")
    assert area(scores, labels) > 0.97 and (predicted == labels).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    scores, labels, predicted = held_out(spark, "op5_toxicity", "toxic", "/root/testdata/sf0.01")
    assert area(scores, labels) > 0.85 and (predicted == labels).mean() > 0.95


def test_temperature_mends_overconfidence():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(600, FEATURES))
    y = ((x[:, 0] + draw.normal(0, 1.5, 600)) > 0).astype(int)
    net = train_network(x, y, np.arange(600) % 4 == 0)
    rest, truth = x[np.arange(600) % 4 == 0], y[np.arange(600) % 4 == 0]
    loss = lambda t: np.mean(np.logaddexp(0, net.logits(rest) / t) - truth * net.logits(rest) / t)
    assert net.temperature > 1 and loss(net.temperature) < loss(1.0)


def group_docs(spark):
    """Insults come with one group far more often than chance, so a plain classifier learns the group."""
    draw = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        body = list(draw.choice(words, 12))
        toxic = i % 3 == 0
        if toxic:
            body += [str(draw.choice(["idiot", "scum"]))]
        if draw.random() < (0.8 if toxic else 0.05):
            body += ["muslims"]
        rows.append((i, " ".join(draw.permutation(body)), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return table.select("doc_id", "text"), table.select("doc_id", "toxic")


def test_penalty_takes_the_group_out_of_the_score(spark):
    docs, labels = group_docs(spark)
    plain, fair = (fit_toxicity(docs, labels, penalty=p).scorer() for p in (0.0, 10.0))
    neutral = "w1 w2 muslims w3"
    assert fair(neutral) < plain(neutral) and fair(neutral) < 0.2
    assert fair("w1 you idiot w3") > 0.5 and fair("w5 muslims scum") > 0.5


def test_swaps_stay_in_their_line():
    assert swap_terms({"a", "women"}, 5) == {"a", "men"}
    assert swap_terms({"a", "b"}, 5) is None
    assert all("jews" not in swap_terms({"jews"}, k) for k in range(20))


def test_examples_in_small_batches():
    texts = ["you women", "", "a b a " * 50, "x" * 5000, "women and men"] * 40
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(200), pa.int64()), pa.array([0] * 200, pa.int32()), pa.array(texts)], ["doc_id", "label", "text"]
    )
    made = pa.Table.from_batches(_examples((("women", "men"),))(iter([batch]))).to_pylist()
    assert [r["doc_id"] for r in made] == list(range(200))
    for row, text in zip(made, texts):
        assert row["plain"] == sorted({f for w in text_words(text) for f in word_features(w)})
        assert (row["swapped"] is None) == ("women" not in text)


def test_only_wanted_features():
    lists = pa.array([[1, 2, 3], None, [], [3, 9], None, [4]], pa.list_(pa.int32()))
    kept = lambda a, w: _only(a, np.array(w, dtype=np.int32)).to_pylist()
    assert kept(lists, [3, 4]) == [[3], None, [], [3], None, [4]]
    assert kept(lists, []) == [[], None, [], [], None, []]
    assert kept(lists.slice(3, 2), [9]) == [[9], None]
    assert kept(lists.slice(0, 0), [9]) == []


def test_edges(spark):
    docs, labels = group_docs(spark)
    odd = spark.createDataFrame(
        [(None, None), (None, "idiot"), (1, ""), (1, ""), (2, "x " * 300_000), (3, "퟿\x00 ½ ٣")], "doc_id long, text string"
    )
    odd = odd.withColumns({c: F.lit(1) for c in ("label", "score", "toxic", "quality", "words")})
    quality = labels.select("doc_id", F.col("toxic").alias("quality"))
    strange = labels.union(spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 0)], "doc_id long, toxic int"))
    for scores, known in ((toxicity_scores, strange), (quality_scores, quality)):
        everything = docs.unionByName(odd.select("doc_id", "text"))
        rows = scores(everything, known).collect()
        assert len(rows) == 606 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) <= 2  # the two empty rows agree
        assert {r.score for r in scores(odd, known.limit(0)).collect()} == {0.5}
        assert scores(odd.limit(0), known).count() == 0
    assert odd.filter(held_out_remainder().isNull()).count() == 2
    assert len(Buckets()("a a, 12 34 a%%")) == 7


def test_runs_hashed_together_are_the_features_of_the_words():
    words = ["a", "", "word", "naïve", "日本語の言葉", "a😀b😀cdé", "x" * 100, "word"]
    features, of = hashed_features(words)
    for number, word in enumerate(words):
        assert set(features[of == number].tolist()) == set(word_features(word))
    assert [len(part) for part in hashed_features([])] == [0, 0]


def test_scores_do_not_depend_on_what_is_remembered(monkeypatch):
    texts = [" ".join(f"{stem}{i % 37}" for i in range(n)) for n, stem in ((5, "wort"), (90, "école"), (60, "wort"), (0, ""))]
    weights = {f: 0.01 * (f % 19 - 9) for w in ("wort3", "école8", "wort30") for f in word_features(w)}
    plain = [sum(weights[f] for f in sorted({f for w in text_words(t) for f in word_features(w)} & weights.keys())) for t in texts]
    wanted = [float(1 / (1 + np.exp(-(x - 0.5)))) for x in plain]
    for most in (50_000, 3):
        monkeypatch.setattr(toxicity, "_MEMO_WORDS", most)
        monkeypatch.setattr(toxicity, "_WORDS_AT_ONCE", most)
        score = toxicity.Classifier(weights, -0.5).scorer()
        assert np.allclose([score(t) for t in texts + texts], wanted + wanted, atol=1e-12)
