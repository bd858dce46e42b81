"""Quality classifier: random-indexing word vectors, pooled per document, and a calibrated two-layer network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.tables import held_out_remainder, whole_text


BUCKETS = 1 << 13  # words share a vector by hash, so that the vectors have a fixed size
DIMS = 32
NONZERO = 2  # of a word's index vector
REACH = 2  # words to either side that are context
SAMPLE_ROWS = 20_000  # most labelled rows a network is trained on
HIDDEN = 32
_TOKENS_AT_ONCE = 1 << 18
_MEMO_WORDS = 400_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_DIGITS = re.compile(r"\d")


class Buckets:
    """Hash buckets of tokens: words in lower case with digits as 0, and runs of other signs; whole texts."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        memo, found = self.memo, []
        for token in _TOKEN.findall(text):
            bucket = memo.get(token)
            if bucket is None:
                if len(memo) >= _MEMO_WORDS:
                    memo.clear()
                plain = _DIGITS.sub("0", token.lower())
                bucket = memo[token] = zlib.crc32(plain.encode("utf-8", "surrogatepass")) % BUCKETS
            found.append(bucket)
        return np.array(found, dtype=np.int64)


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's few nonzero entries; the last row, for gaps between texts, is zero."""
    draw = np.random.default_rng(seed)
    places = np.argsort(draw.random((BUCKETS + 1, DIMS)), axis=1)[:, :NONZERO]
    signs = draw.choice([-1.0, 1.0], (BUCKETS + 1, NONZERO))
    signs[BUCKETS] = 0
    return places, signs


def context_sums(docs: DataFrame) -> DataFrame:
    """bucket, uses, d0, d1, ...: for each bucket the sum of the index vectors of all its neighbours in the corpus.

    A task sums its documents in an array of fixed size; the tasks' sums meet in an ordinary aggregation.
    """
    names = [f"d{i}" for i in range(DIMS)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, (places, signs) = Buckets(), index_vectors()
        total, uses = np.zeros((BUCKETS + 1) * DIMS), np.zeros(BUCKETS + 1, dtype=np.int64)
        gap = np.full(REACH, BUCKETS, dtype=np.int64)
        held, size = [gap], 0

        def add(words: np.ndarray) -> None:
            nonlocal total, uses
            uses += np.bincount(words, minlength=BUCKETS + 1)
            for apart in range(1, REACH + 1):
                for here, there in ((words[:-apart], words[apart:]), (words[apart:], words[:-apart])):
                    for j in range(NONZERO):
                        cells = here * DIMS + places[there, j]
                        total += np.bincount(cells, signs[there, j], (BUCKETS + 1) * DIMS)

        for batch in batches:
            for text in batch.column(0):
                held += [buckets(text.as_py()), gap]
                size += len(held[-2])
                if size >= _TOKENS_AT_ONCE:
                    add(np.concatenate(held))
                    held, size = [gap], 0
        add(np.concatenate(held))
        used = np.flatnonzero(uses[:BUCKETS])
        columns = total.reshape(-1, DIMS)[used].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(uses[used]), *(pa.array(columns[:, i]) for i in range(DIMS))],
            names=["bucket", "uses", *names],
        )

    schema = "bucket long, uses long, " + ", ".join(f"{n} long" for n in names)
    parts = docs.select(whole_text().alias("text")).mapInArrow(sums, schema)
    return parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ["uses", *names]))


@dataclass
class WordVectors:
    vectors: np.ndarray
    rarity: np.ndarray


def word_vectors(docs: DataFrame) -> WordVectors:
    """Unit context vectors and rarity weights of all buckets; BUCKETS rows at most come to the driver."""
    vectors, uses = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS)
    for row in context_sums(docs).collect():
        uses[row.bucket] = row.uses
        vectors[row.bucket] = row[2:]
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMS))
    np.put_along_axis(own, places[:BUCKETS], signs[:BUCKETS], axis=1)
    # What all words have around them says nothing of a word, so the corpus mean is taken off.
    mean = vectors.sum(axis=0) / max(uses.sum(), 1)
    vectors = vectors / np.maximum(uses, 1)[:, None] - mean + 0.5 * own
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    share = uses / max(uses.sum(), 1)
    return WordVectors(vectors.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32))


STRETCH = 32  # words that are pooled on their own before the extremes over a document are taken
FEATURES = 3 * DIMS + 10


def pooled(words: np.ndarray, model: WordVectors) -> np.ndarray:
    """A document's poolings: mean, spread and rarity-weighted mean of its word vectors, how alike words
    one and two apart are (on average and over single stretches), the share of distinct words, the length."""
    out = np.zeros(FEATURES, dtype=np.float64)
    n = len(words)
    if not n:
        return out
    sums, squares, rare, weight = np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS), 0.0
    near, far = [], []
    for at in range(0, n, _TOKENS_AT_ONCE):
        part = words[at:at + _TOKENS_AT_ONCE + 2]
        vectors, rarity = model.vectors[part], model.rarity[part]
        mine = slice(0, _TOKENS_AT_ONCE)
        sums += vectors[mine].sum(axis=0)
        squares += (vectors[mine] ** 2).sum(axis=0)
        rare += rarity[mine] @ vectors[mine]
        weight += float(rarity[mine].sum())
        near.append((vectors[:-1] * vectors[1:]).sum(axis=1)[mine])
        far.append((vectors[:-2] * vectors[2:]).sum(axis=1)[mine])
    mean = sums / n
    out[:DIMS], out[DIMS:2 * DIMS] = mean, np.sqrt(np.maximum(squares / n - mean**2, 0))
    out[2 * DIMS:3 * DIMS] = rare / max(weight, 1e-9)
    rest = [np.log1p(n), len(np.unique(words)) / n ** 0.8, weight / n]
    for alike in (np.concatenate(near), np.concatenate(far)):
        if len(alike):
            cuts = np.arange(0, max(len(alike) - STRETCH // 2, 1), STRETCH)
            stretches = np.add.reduceat(alike, cuts) / np.diff(np.append(cuts, len(alike)))
            rest += [alike.mean(), stretches.max(), stretches.min()]
        else:
            rest += [0.0, 0.0, 0.0]
    out[3 * DIMS:3 * DIMS + len(rest)] = rest
    return out


@dataclass
class Network:
    """Two layers on standardised poolings; the temperature divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        inputs = (features - self.mean) / self.scale
        return np.maximum(inputs @ self.first + self.first_bias, 0) @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -40, 40)))


def train_network(features: np.ndarray, labels: np.ndarray, calibrate: np.ndarray, seed: int = 11) -> Network:
    """Adam on cross-entropy with weight decay, over the rows not in `calibrate`; the temperature is the one with the
    least cross-entropy on the rows in `calibrate`. Without rows of both labels the score is the label share."""
    fit = ~calibrate
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    net = Network(
        np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
        float(np.log(share / (1 - share))), 1.0,
    )
    if len(np.unique(labels[fit])) < 2:
        return net
    draw = np.random.default_rng(seed)
    net.mean, net.scale = features[fit].mean(axis=0), features[fit].std(axis=0) + 1e-6
    net.first = draw.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN))
    net.second = draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN)
    inputs, wanted = (features[fit] - net.mean) / net.scale, labels[fit].astype(float)
    state = [net.first, net.first_bias, net.second, np.array([net.second_bias])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in state]
    rows, steps = len(inputs), 0
    batch = min(256, rows)
    for _ in range(max(20, min(200, 400_000 // rows))):
        order = draw.permutation(rows)
        for at in range(0, rows - batch + 1, batch):
            x, y = inputs[order[at:at + batch]], wanted[order[at:at + batch]]
            hidden = np.maximum(x @ state[0] + state[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ state[2] + state[3], -40, 40))) - y) / batch
            back = np.outer(error, state[2]) * (hidden > 0)
            slopes = [
                x.T @ back + 1e-4 * state[0], back.sum(axis=0), hidden.T @ error + 1e-4 * state[2], np.array([error.sum()])
            ]
            steps += 1
            for p, (m, v), g in zip(state, moments, slopes):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= 2e-3 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    net.second_bias = float(state[3][0])
    if len(np.unique(labels[calibrate])) == 2:
        logits, truth = net.logits(features[calibrate]), labels[calibrate]
        grid = np.geomspace(0.25, 8, 61)
        losses = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, label, remainder: at most `rows` labelled ids (those of the smallest hashes), none of them held out.

    Rows without id or label are no examples; of an id with several labels the larger counts.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (held_out_remainder() != 0))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _pooler(model):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, words = Buckets(), WordVectors(*model.value)
        for batch in batches:
            rows = [pooled(buckets(t.as_py()), words).tolist() for t in batch.column("text")]
            kept = [batch.column(c) for c in ("doc_id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    return pool


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score: the probability that a text would be labelled 1 in labels.quality; one row per row of `docs`.

    Word vectors and word counts cover all documents; the network sees `sample_rows` labelled rows at most, none of
    which has crc32(doc_id) mod 5 = 0, and nothing but their texts.
    Null text is the empty text, whose poolings are zero and which is scored like any other; null ids are scored,
    too. Without labels of both kinds every score is the label share (0.5 without any). An empty table gives no
    rows. Texts are pooled whole, in parts of bounded memory. Other columns are not read.
    """
    spark = docs.sparkSession
    words = word_vectors(docs)
    model = spark.sparkContext.broadcast((words.vectors, words.rarity))  # BUCKETS x DIMS floats
    sample = labelled_sample(labels, "quality", sample_rows)
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    known = texts.mapInArrow(_pooler(model), "doc_id long, label int, x array<double>").orderBy("doc_id").collect()
    features = np.array([r.x for r in known]).reshape(-1, FEATURES)
    answers = np.array([r.label for r in known], dtype=np.int64)
    calibrate = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in known], dtype=bool)
    net = spark.sparkContext.broadcast(vars(train_network(features, answers, calibrate)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, words, network = Buckets(), WordVectors(*model.value), Network(**net.value)
        for batch in batches:
            rows = [pooled(buckets(t.as_py()), words) for t in batch.column("text")]
            scores = network.probabilities(np.array(rows).reshape(-1, FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(score, "doc_id long, score double")
