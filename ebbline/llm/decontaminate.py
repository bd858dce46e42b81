"""Benchmark decontamination: suffix arrays of training shards, searched for every suffix of the test items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.tables import whole_text
from ebbline.workspace import stage

WINDOW = 10
DEPTH = 16  # words of a suffix that its sort key holds
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 16_000_000

# Word bytes are 0-9, a-z (A-Z in lower case) and everything beyond ASCII; all others part words.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


_LONGEST = pa.struct([("words", pa.int64()), ("item", pa.string()), ("at", pa.int64())])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _keys(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The DEPTH words from each position as one byte string each that sorts in suffix order.

    `words` holds numbers from 1, zero between texts; what follows a zero is blanked, as a suffix ends there.
    """
    rows = np.empty((len(at), DEPTH), dtype=">u4")
    going = np.ones(len(at), dtype=bool)
    for k in range(DEPTH):
        word = words[np.minimum(at + k, len(words) - 1)] * going
        going &= word > 0
        rows[:, k] = word
    return rows.view(f"S{4 * DEPTH}").ravel()


def _joined(coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a zero after each; and where each begins."""
    lengths = np.array([len(c) for c in coded], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(lengths + 1)))
    words = np.zeros(int(first[-1]) + 1, dtype=np.uint32)
    for begin, c in zip(first, coded):
        words[begin:begin + len(c)] = c
    return words, first[:-1]


class Tests:
    """A block of test items: their vocabulary, their suffixes and the distinct windows these begin with."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        if not 0 < window <= DEPTH:
            raise ValueError(f"a window has 1 to {DEPTH} words")
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        code = self.vocabulary
        coded = [np.array([code.setdefault(w, len(code) + 1) for w in words_of(t)], dtype=np.uint32) for _, t in items]
        self.words, self.first = _joined(coded)
        widths = [min(window, len(c)) for c in coded]
        counts = [len(c) - w + 1 if len(c) else 0 for c, w in zip(coded, widths)]
        self.item = np.repeat(np.arange(len(coded)), counts)
        self.offset = np.concatenate([np.arange(n) for n in counts] or [[]]).astype(np.int64)
        self.width = np.repeat(np.array(widths, dtype=np.int64), counts)
        self.at = self.first[self.item] + self.offset
        self.suffixes = _keys(self.words, self.at)
        low, high = (k.view(">u4").reshape(-1, DEPTH).copy() for k in (self.suffixes, self.suffixes))
        beyond = np.arange(DEPTH) >= self.width[:, None]
        low[beyond], high[beyond] = 0, 0xFFFFFFFF
        # The width is part of a window's name: a short item and the beginning of a longer one are two windows.
        bounds = np.concatenate((low, high), axis=1).view(f"S{8 * DEPTH}").ravel()
        distinct, one, self.window = np.unique(bounds, return_index=True, return_inverse=True)
        self.low, self.high = (k[one].view(f"S{4 * DEPTH}").ravel() for k in (low, high))
        self.window_width = self.width[one]
        first, second = low[:, 0].astype(np.int64), low[:, 1].astype(np.int64)
        self.begins = np.unique((first << 32) | second)
        self.by_window = np.argsort(self.window, kind="stable")  # test suffixes by the window that they begin with
        self.by_window_from = np.searchsorted(self.window[self.by_window], np.arange(len(one) + 1))
        self.name_rank = np.empty(len(self.names), dtype=np.int64)
        self.name_rank[np.array(sorted(range(len(self.names)), key=self.names.__getitem__), dtype=np.int64)] = np.arange(len(self.names))
        pairs = np.unique(np.stack([self.window, self.item], axis=1), axis=0) if len(one) else np.empty((0, 2), np.int64)
        self.window_items = pairs[:, 1]
        self.window_from = np.searchsorted(pairs[:, 0], np.arange(len(one) + 1))


class Shard:
    """Some documents and the sorted suffixes that begin where a test window could begin."""

    def __init__(self, tests: Tests, coded: list[np.ndarray]):
        self.words, self.first = _joined(coded)
        single = self.words[:-1].astype(np.int64) << 32
        pairs = single | self.words[1:]
        single_word = tests.begins[(tests.begins & 0xFFFFFFFF) == 0]
        at = np.flatnonzero((np.isin(pairs, tests.begins) | np.isin(single, single_word)) & (single > 0))
        keys = _keys(self.words, at)
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = at[order], keys[order]

    def find(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence: the suffixes between the two ends of a binary search."""
        start = np.searchsorted(self.keys, tests.low, "left")
        count = np.searchsorted(self.keys, tests.high, "right") - start
        window = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return window, self.suffixes[np.repeat(start, count) + within]

    def longest(self, tests: Tests, window: np.ndarray, at: np.ndarray) -> dict[int, tuple[int, str, int]]:
        """Per document with a hit its longest verbatim match: (words, item name, word where it begins).

        Of equally long ones that of the first name, then the first place. `window` and `at` as `find` gives them; each
        is carried on, word by word, along every test suffix that begins with the window.
        """
        count = np.diff(tests.by_window_from)[window]
        begin = np.repeat(at, count)
        within = np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
        suffix = tests.by_window[np.repeat(tests.by_window_from[window], count) + within]
        there = tests.at[suffix]
        # A match that a word before it lengthens is part of another one.
        before = np.where(begin > 0, self.words[begin - 1], 0)
        first = np.flatnonzero((before == 0) | (there == 0) | (tests.words[there - 1] != before))
        begin, suffix, there = begin[first], suffix[first], there[first]
        length = tests.width[suffix]
        going = np.arange(len(begin))
        while len(going):
            word = self.words[begin[going] + length[going]]
            going = going[(word > 0) & (word == tests.words[there[going] + length[going]])]
            length[going] += 1
        doc = np.searchsorted(self.first, begin, "right") - 1
        order = np.lexsort((begin, tests.name_rank[tests.item[suffix]], -length, doc))
        best = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        return {
            int(doc[i]): (int(length[i]), tests.names[tests.item[suffix[i]]], int(begin[i] - self.first[doc[i]])) for i in best
        }


def _shards(batches: Iterator[pa.RecordBatch], tests: Tests) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """Documents of about SHARD_WORDS words at a time, with their coded words (zero: in no test item)."""
    held: list[pa.RecordBatch] = []
    coded: list[np.ndarray] = []
    size = 0
    for batch in batches:
        begin = 0
        for i, text in enumerate(batch.column("text")):
            words = words_of(text.as_py())
            coded.append(np.fromiter((tests.vocabulary.get(w, 0) for w in words), dtype=np.uint32, count=len(words)))
            size += len(words)
            if size >= SHARD_WORDS:
                yield pa.Table.from_batches([*held, batch.slice(begin, i + 1 - begin)]), coded
                held, coded, size, begin = [], [], 0, i + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held), coded


def _mark(tests: Tests, rows: pa.Table, coded: list[np.ndarray]) -> pa.Table:
    """`rows` with n_words, and with the block's hits added to the columns spans and items."""
    old_spans, old_items = (rows.column(c).to_pylist() for c in ("spans", "items"))
    shard = Shard(tests, coded)
    window, at = shard.find(tests)
    edges = np.zeros(len(shard.words) + 1, dtype=np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + tests.window_width[window], -1)
    doc = np.searchsorted(shard.first, at, "right") - 1
    pairs = np.unique(np.stack([doc, window], axis=1), axis=0) if len(at) else np.empty((0, 2), dtype=np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for d, w in pairs.tolist():
        items[d].update(tests.names[i] for i in tests.window_items[tests.window_from[w]:tests.window_from[w + 1]])
    for d, old in enumerate(old_spans):
        if len(old):
            np.add.at(edges, shard.first[d] + np.asarray(old[0::2]), 1)
            np.add.at(edges, shard.first[d] + np.asarray(old[1::2]), -1)
    hit = (np.cumsum(edges) > 0).astype(np.int8)
    turns = np.flatnonzero(np.diff(hit, prepend=0))  # where runs of hit words begin and end, in turn
    owner = np.searchsorted(shard.first, turns[0::2], "right") - 1
    spans = [[] for _ in coded]
    for d, a, b in zip(owner.tolist(), turns[0::2].tolist(), turns[1::2].tolist()):
        spans[d] += [a - int(shard.first[d]), b - int(shard.first[d])]
    best = shard.longest(tests, window, at)
    longest = [
        min(filter(None, (old and (old["words"], old["item"], old["at"]), best.get(d))), key=lambda m: (-m[0], m[1], m[2]), default=None)
        for d, old in enumerate(rows.column("longest").to_pylist())
    ]
    new = {
        "longest": pa.array([m and dict(zip(("words", "item", "at"), m)) for m in longest], _LONGEST),
        "n_words": pa.array([len(c) for c in coded], pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.int64())),
        "items": pa.array(
            [sorted({*old, *items[d]}) if d in items else old for d, old in enumerate(old_items)], pa.list_(pa.string())
        ),
    }
    return pa.table({c: new.get(c, rows.column(c)) for c in rows.column_names})


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The test items in blocks of about `block_bytes`, each with whether it is the last; one is held at a time.
    An empty benchmark is one empty block."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), whole_text().alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text") + 64)).head()[0] or 0
    count = max(1, -(-total // block_bytes))
    for block in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else items
        yield [tuple(r) for r in part.collect()], block == count - 1


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, carry: bool = False
) -> DataFrame:
    """What of `benchmark` (item_id, text) occurs word for word in each document.

    Columns: doc_id, n_words, spans (word positions from, to, from, to, ... of the hit runs), items (names of the
    items with an occurring window, sorted as strings), longest (struct: words, item, at, of the longest verbatim
    match of a window or more; of equals the first name, then the first place; null without hits). One row per row of
    `docs`; nothing is shuffled.
    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. A window is `window` words of an
    item that follow each other; an item with fewer words, but not none, is one window.

    Tasks hold about SHARD_WORDS words of documents at a time, sort the suffixes that begin with two words (or the
    one word) of a test window, and look every test suffix up by binary search. A benchmark of more than
    `block_bytes` is searched block by block, the documents with their hits so far being written between.

    Null texts have no words; null item ids are named 'null'; items that repeat an id are one item in `items`; an
    empty benchmark hits nothing; an empty document table gives no rows. Other columns are not read, or, with
    `carry`, come back with the row as the struct `document`.
    """
    spark = docs.sparkSession
    found = docs.select(
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")] if carry else []), "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        F.lit(None).cast("struct<words:bigint,item:string,at:bigint>").alias("longest"),
    )
    first = True
    for items, last in _blocks(benchmark, block_bytes):
        found = _searched(spark, found if first else stage(found, "decontaminate-block"), items, window, last)
        first = False
    return found


def _searched(spark, rows: DataFrame, items: list[tuple[str, str]], window: int, last: bool) -> DataFrame:
    shared = spark.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Tests(shared.value, window)
        for part, coded in _shards(batches, tests):
            marked = _mark(tests, part, coded)
            yield from (marked.drop_columns("text") if last else marked).to_batches()

    return rows.mapInArrow(search, (rows.drop("text") if last else rows).schema)
