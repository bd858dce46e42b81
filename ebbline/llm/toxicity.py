"""Toxicity classifier whose scores may not change when the group that a text mentions is swapped for another."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.quality import labelled_sample
from ebbline.llm.tables import give_back_memory, whole_text
from ebbline.workspace import stage

# Terms for groups of people; the terms of one line can stand for each other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)

SAMPLE_ROWS = 20_000  # most labelled rows the classifier is trained on
FEATURES = 4_096  # most features it uses
PENALTY = 1.0  # weight of the squared score change under a swap
LEAST_ROWS = 3  # labelled rows that a feature must occur in
LEAST_Z = 4.0  # how far from chance a feature's share of toxic rows must be
_HASH_BITS = 30
_MEMO_WORDS = 50_000
_MEMO_LETTERS = 40  # longer words are not remembered
_ROWS_AT_ONCE = 64
_WORDS_AT_ONCE = 4_096  # words whose runs are hashed together
_SHORT, _LONG = 4, 6
_WORD = re.compile(r"\w+")


def _hashed(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << _HASH_BITS) - 1)


def word_features(word: str) -> list[int]:
    """The word itself and its character runs; the ends of the word are signs of their own."""
    marked = f"<{word}>"
    runs = {marked[i:i + n] for n in range(_SHORT, _LONG + 1) for i in range(len(marked) - n + 1)}
    return [_hashed(f) for f in runs | {marked}]


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


_CRC_STEPS = _crc_steps()


def hashed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, number of its word) of the `word_features` of all words, repeats included; the runs that begin at
    all characters are hashed together, each one character longer than the one before."""
    marked = [f"<{word}>" for word in words]
    data = np.frombuffer("".join(marked).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    begin = np.flatnonzero((data & 0xC0) != 0x80)  # of every character
    size = np.diff(np.append(begin, len(data)))
    widest = int(size.max(initial=0))
    lengths = np.array([len(m) for m in marked], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    at, end = np.arange(len(begin)), np.repeat(np.cumsum(lengths), lengths)
    state = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
    found = [np.array([_hashed(m) for m in marked], dtype=np.int32)]
    of = [np.arange(len(words))]
    for n in range(1, _LONG + 1):
        inside = at + n <= end
        at, end, state = at[inside], end[inside], state[inside]
        char = at + (n - 1)
        first = begin[char]
        state = _CRC_STEPS[(state ^ data[first]) & 255] ^ (state >> 8)
        for byte in range(1, widest):
            more = np.flatnonzero(size[char] > byte)
            state[more] = _CRC_STEPS[(state[more] ^ data[first[more] + byte]) & 255] ^ (state[more] >> 8)
        if n >= _SHORT:
            found.append((~state & np.uint32((1 << _HASH_BITS) - 1)).astype(np.int32))
            of.append(owner[at])
    return np.concatenate(found), np.concatenate(of)


def text_words(text: str) -> set[str]:
    """The distinct words: a text is as toxic as what occurs in it, however long it is."""
    return set(_WORD.findall(text.lower()))


def swap_terms(words: set[str], shift: int, terms=IDENTITY_TERMS) -> set[str] | None:
    """The words with every identity term replaced by another of its line; None where there is none."""
    swaps = {}
    for line in terms:
        for place, term in enumerate(line):
            if term in words:
                swaps[term] = line[(place + 1 + shift % (len(line) - 1)) % len(line)]
    return {swaps.get(w, w) for w in words} if swaps else None


@dataclass
class Classifier:
    weights: dict[int, float]
    bias: float

    def scorer(self):
        """A function from text to score; it remembers which weighted features a word has."""
        memo: dict[str, tuple[int, ...]] = {}
        weights = self.weights
        known = np.array(sorted(weights) or [-1], dtype=np.int32)
        likely = np.zeros(1 << 16, dtype=bool)  # by the last bits; rules out most features at once
        likely[known & 0xFFFF] = True

        def look_up(words: list[str], found: set[int]) -> None:
            features, of = hashed_features(words)
            few = np.flatnonzero(likely[features & 0xFFFF])
            features, of = features[few], of[few]
            held = known[np.minimum(np.searchsorted(known, features), len(known) - 1)] == features
            features, of = features[held].tolist(), of[held].tolist()
            found.update(features)
            if len(memo) + len(words) > _MEMO_WORDS:
                memo.clear()
            lists: dict[int, list[int]] = {}
            for feature, number in zip(features, of):
                lists.setdefault(number, []).append(feature)
            for number, word in enumerate(words):
                if len(word) <= _MEMO_LETTERS:
                    memo[word] = tuple(lists[number]) if number in lists else ()

        def score(text: str) -> float:
            found: set[int] = set()
            unknown = []
            for word in text_words(text):
                features = memo.get(word)
                if features is None:
                    unknown.append(word)
                elif features:
                    found.update(features)
            for begin in range(0, len(unknown), _WORDS_AT_ONCE):
                look_up(unknown[begin:begin + _WORDS_AT_ONCE], found)
            total = self.bias + sum(weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))

        return score


def _examples(terms):
    names = ["doc_id", "label", "plain", "swapped"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_words(words: set[str]) -> np.ndarray:
            listed = list(words)
            parts = [
                np.unique(hashed_features(listed[begin:begin + _WORDS_AT_ONCE])[0])
                for begin in range(0, len(listed), _WORDS_AT_ONCE)
            ]
            return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int32)

        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(begin, _ROWS_AT_ONCE)
                plain, swapped = [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    words = text_words(text)
                    other = swap_terms(words, zlib.crc32(str(doc_id).encode()), terms)
                    plain.append(of_words(words))
                    swapped.append(None if other is None else of_words(other))
                lists = [pa.array(x, pa.list_(pa.int32())) for x in (plain, swapped)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *lists], names)
        give_back_memory()

    return make


def _only(lists: pa.Array, wanted: np.ndarray) -> pa.Array:
    """The lists without the numbers that are not in `wanted`, in their order; null stays null."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    keep = np.isin(values, wanted)
    before = np.concatenate(([0], np.cumsum(keep)))
    offsets = before[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values[keep], pa.int32()), mask=lists.is_null() if lists.null_count else None
    )


def _telling_features(examples: DataFrame, most: int) -> list[int]:
    """Features whose share of toxic rows is far from that of all rows; counted over the whole sample in Spark."""
    totals = examples.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).head()
    if not totals.n or totals.toxic in (0, totals.n):
        return []
    base = totals.toxic / totals.n
    counts = examples.select("label", F.explode("plain").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n"), F.sum("label").alias("toxic")
    )
    z = (F.col("toxic") - base * F.col("n")) / F.sqrt(F.lit(base * (1 - base)) * F.col("n"))
    told = counts.filter(F.col("n") >= LEAST_ROWS).withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z)
    return [r.feature for r in told.orderBy(F.desc("z"), "feature").limit(most).collect()]


def train(
    rows: list[tuple[int, list[int], list[int] | None]], features: list[int], penalty: float = PENALTY
) -> Classifier:
    """Logistic regression by Adam on all rows: cross-entropy + penalty * mean squared score change under a swap,
    with a small weight decay. `rows`: label, features, features after the swap (None: the text names no group)."""
    place = {f: i for i, f in enumerate(features)}
    n = len(rows)
    share = float(np.clip(sum(label for label, _, _ in rows) / n if n else 0.5, 1e-3, 1 - 1e-3))
    if not n or not features or len({label for label, _, _ in rows}) < 2:
        return Classifier({}, float(np.log(share / (1 - share))))
    labels = np.array([label for label, _, _ in rows], dtype=float)
    changed = [i for i, (_, _, other) in enumerate(rows) if other is not None]

    def cells(lists, signs):
        at = [(r, place[f], s) for r, (fs, s) in enumerate(zip(lists, signs)) for f in fs if f in place]
        table = np.array(at or [(0, 0, 0)], dtype=float)
        return table[:, 0].astype(int), table[:, 1].astype(int), table[:, 2]

    plain = cells([fs for _, fs, _ in rows], [1.0] * n)
    moves = cells(
        [fs for i in changed for fs in (rows[i][1], rows[i][2])], [s for _ in changed for s in (1.0, -1.0)]
    )
    moves = (moves[0] // 2, moves[1], moves[2])  # row i of the swap table: features before minus features after
    weights, bias = np.zeros(len(features)), float(np.log(share / (1 - share)))
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, 401):
        logits = bias + np.bincount(plain[0], weights[plain[1]], n)
        error = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels) / n
        slope = np.bincount(plain[1], error[plain[0]], len(features)) + 1e-4 * weights
        if changed:
            gap = np.bincount(moves[0], weights[moves[1]] * moves[2], len(changed))
            slope += 2 * penalty / len(changed) * np.bincount(moves[1], gap[moves[0]] * moves[2], len(features))
        slope = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Classifier(dict(zip(features, weights.tolist())), float(bias))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, terms=IDENTITY_TERMS, penalty: float = PENALTY
) -> Classifier:
    """Train on `sample_rows` labelled texts at most, none of which has crc32(doc_id) mod 5 = 0."""
    sample = labelled_sample(labels, "toxic", sample_rows)
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")  # bounded by sample_rows
    examples = stage(
        texts.mapInArrow(_examples(terms), "doc_id long, label int, plain array<int>, swapped array<int>"), "toxicity-examples"
    )
    features = _telling_features(examples, FEATURES)
    wanted = docs.sparkSession.sparkContext.broadcast(np.array(sorted(features), dtype=np.int32))

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [_only(batch.column(c), wanted.value) for c in ("plain", "swapped")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], batch.schema.names)

    used = examples.mapInArrow(used, examples.schema)
    rows = [(r.label, r.plain, r.swapped) for r in used.orderBy("doc_id").collect()]
    return train(rows, features, penalty)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, terms=IDENTITY_TERMS, penalty: float = PENALTY
) -> DataFrame:
    """doc_id, score: the probability that a text would be labelled 1 in labels.toxic; one row per row of `docs`.

    A text is the set of its words' hashed forms and character runs. Labelled texts that name a group are also
    seen with the group swapped, and score changes are penalised, so that the mention alone moves no score.
    Null text is the empty text: its score is the bias. Null ids are scored, too; repeated rows have equal scores.
    Without labels of both kinds every score is the label share (0.5 without any label). An empty table gives no
    rows. Whole texts are scored; other columns are not read.
    """
    score = score_column(docs.sparkSession, fit_toxicity(docs, labels, sample_rows, terms, penalty))
    return docs.select("doc_id", score(whole_text()).alias("score"))


def score_column(spark: SparkSession, classifier: Classifier):
    """A function from a text column to its score."""
    model = spark.sparkContext.broadcast((classifier.weights, classifier.bias))  # FEATURES weights at most

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Classifier(*model.value).scorer()
        for batch in texts:
            yield pd.Series([scorer(t) for t in batch], dtype="float64")
        give_back_memory()

    return score
