"""Ranked lexical search: impact lists of blocks of documents, searched by the Best Position Algorithm."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.decontaminate import words_of
from ebbline.llm.tables import whole_text
from ebbline.workspace import stage

TOP = 10
BLOCK_DOCS = 8_192  # documents whose impact lists are held together,
BLOCK_POSTINGS = 4_000_000  # or fewer, if they hold more postings than this
BLOCK_BYTES = 16_000_000  # of items that are searched for together
FIRST_STEP = 16  # positions that are read before the first look at the threshold

_DOCUMENTS, _LENGTH = -1, -2  # codes under which the counts of all documents and terms travel


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """Distinct (item_id, text) in blocks of about `block_bytes`; one block is held at a time."""
    rows = items.select("item_id", whole_text().alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 64)).head()[0] or 0
    count = max(1, -(-total // block_bytes))
    for block in range(count):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else rows
        yield [(r.item_id, r.text) for r in part.collect()]


def _counter(shared):
    """Per document its number of terms, and the codes and frequencies of those terms that any item holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {term: i for i, term in enumerate(shared.value)}
        for batch in batches:
            lengths, codes, times = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found = sorted((code[w], n) for w, n in Counter(words).items() if w in code)
                lengths.append(len(words))
                codes.append(np.array([c for c, _ in found], dtype=np.int32).tobytes())
                times.append(np.array([n for _, n in found], dtype=np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(codes, pa.binary()), pa.array(times, pa.binary())],
                ["doc_id", "n", "codes", "times"],
            )

    return count


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task hold each code, how many have any term, and how many terms they have."""
    counts: Counter[int] = Counter()
    for batch in batches:
        held = np.frombuffer(b"".join(c.as_py() for c in batch.column("codes")), dtype=np.int32)
        codes, times = np.unique(held, return_counts=True)
        counts.update(dict(zip(codes.tolist(), times.tolist())))
        lengths = batch.column("n").to_numpy(zero_copy_only=False)
        counts[_DOCUMENTS] += int((lengths > 0).sum())
        counts[_LENGTH] += int(lengths.sum())
    yield pa.RecordBatch.from_pydict(
        {"code": pa.array(counts.keys(), pa.int64()), "held": pa.array(counts.values(), pa.int64())}
    )


class ImpactLists:
    """Impact lists of some documents: per term its postings, highest impact first; and the same postings by
    document and term for direct access."""

    def __init__(self, ids: list[int | None], lengths: np.ndarray, codes: list[bytes], times: list[bytes],
                 weights: np.ndarray, documents: int, length: int):
        sizes = np.array([len(c) // 4 for c in codes], dtype=np.int64)
        self.size = len(ids)
        # Ties go to the smaller id, and a null id comes last.
        by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in by_id]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by_id] = np.arange(len(ids))
        doc = np.repeat(rank, sizes)
        code = np.frombuffer(b"".join(codes), dtype=np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(times), dtype=np.int32).astype(np.int64)
        spread = np.repeat(10 + (90 * lengths * documents) // max(length, 1), sizes)
        impact = weights[code] * ((1_000_000_000 * tf) // (1000 * tf + 8 * spread))
        good = np.flatnonzero(impact > 0)  # a term without weight adds nothing to any score
        doc, code, impact = doc[good], code[good], impact[good]
        self.terms = len(weights)
        by_list = np.lexsort((doc, -impact, code))
        self.doc, self.impact = doc[by_list], impact[by_list]
        self.begin = np.searchsorted(code[by_list], np.arange(self.terms + 1))
        keys = self.doc * self.terms + code[by_list]
        self.place = np.argsort(keys, kind="stable")  # where in the lists the posting of a (document, term) stands
        self.keys = keys[self.place]

    def direct(self, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, there): the places of the postings of `docs` x `terms`, and which of them exist."""
        wanted = docs[:, None] * self.terms + terms[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.place[at], self.keys[at] == wanted

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[list[tuple[int, int]], int]:
        """The `k` best (score, document number) that score `least` or more, and how many documents were scored.

        Best Position Algorithm: all lists are read from the top at the same pace; a document met is scored at once
        by direct access to all its postings, which marks their positions as seen, too. A list's best position is
        the end of its unbroken run of seen positions: whatever has not been met stands behind it in every list, so
        it scores no more than the sum of the impacts there. The search ends when that sum is below the k-th score,
        not when it equals it, as an equal score may still win by its id.
        """
        terms = terms[self.begin[terms] < self.begin[terms + 1]]
        best: list[tuple[int, int]] = []
        if not len(terms):
            return best, 0
        begin, end = self.begin[terms], self.begin[terms + 1]
        flat = np.concatenate(([0], np.cumsum(end - begin)))
        seen = np.zeros(int(flat[-1]), dtype=bool)
        met = np.zeros(self.size, dtype=bool)
        reach = np.zeros(len(terms), dtype=np.int64)  # best position: so many from the top are seen
        depth, step, kth, scored = 0, FIRST_STEP, least, 0
        while True:
            last = begin + np.maximum(reach, 1) - 1
            bound = int(np.where(begin + reach < end, self.impact[last], 0).sum())
            if bound < kth or bound == 0:
                return best, scored
            fresh = np.concatenate([self.doc[b + depth:min(b + depth + step, e)] for b, e in zip(begin, end)])
            fresh = np.unique(fresh[~met[fresh]])
            depth, step = depth + step, 2 * step
            if len(fresh):
                met[fresh] = True
                place, there = self.direct(fresh, terms)
                scores = np.where(there, self.impact[place], 0).sum(axis=1)
                row, column = np.nonzero(there)
                seen[flat[column] + place[row, column] - begin[column]] = True
                scored += len(fresh)
                good = np.flatnonzero(scores >= max(kth, 1))
                if len(good) > k:
                    good = good[np.lexsort((fresh[good], -scores[good]))[:k]]
                best = sorted(best + list(zip(scores[good].tolist(), fresh[good].tolist())), key=lambda x: (-x[0], x[1]))[:k]
                if len(best) == k:
                    kth = max(kth, best[-1][0])
            for i in range(len(terms)):
                behind = seen[flat[i] + reach[i]:flat[i + 1]]
                gap = int(behind.argmin()) if len(behind) else 0
                reach[i] += len(behind) if len(behind) and behind[gap] else gap


def _searcher(shared, k: int):
    """The k best documents of each item among those of a task; what earlier blocks found bounds the later ones."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, documents, length = shared.value
        found: list[list[tuple[int, int | None]]] = [[] for _ in items]
        held: list[tuple] = []
        postings = 0

        def flush() -> None:
            ids, lengths, codes, times = zip(*held)
            lists = ImpactLists(list(ids), np.array(lengths, dtype=np.int64), codes, times, weights, documents, length)
            for i, terms in enumerate(items):
                least = found[i][-1][0] if len(found[i]) == k else 0
                more, _ = lists.search(terms, k, least)
                if more:
                    merged = found[i] + [(score, lists.ids[doc]) for score, doc in more]
                    found[i] = sorted(merged, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "codes", "times"))):
                if row[2]:
                    held.append(row)
                    postings += len(row[2]) // 4
                if len(held) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    flush()
                    held, postings = [], 0
        if held:
            flush()
        rows = [(i, doc, score) for i, best in enumerate(found) for score, doc in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], ["item", "doc_id", "score"]
        )

    return search


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The `k` documents of `docs` (doc_id, text) that score highest for each of `items` (item_id, text).

    Columns: item_id, rank (from 1), doc_id, score. Scores above 0 only; equal scores go by the smaller doc_id. Terms
    are runs of digits, letters (A-Z in lower case) and characters beyond ASCII of the whole text. The weight of
    a term held by df of N documents is floor(1000 * ln((2N + 2) / (2df + 1))); its impact in a document with n terms is
    weight * ((1000000000 * tf) div (1000 * tf + 8 * (10 + (90 * n * N) div L))), L being the terms of all documents.

    Documents go through once for their terms; of these, those that an item holds are written, as numbers. Counts
    cover all documents. Then each task builds the impact lists of a block of documents and searches them for every
    item; no list spans blocks and none is shuffled, only k rows per item and task are. Items are searched for in
    blocks of about `block_bytes`, one pass over the documents each.

    Null and empty texts have no terms: such a document is never found, such an item finds nothing. Rows of `items`
    that repeat id and text are one item; those that repeat the id only are ranked apart, each from 1. A null
    doc_id comes behind all others of the same score; rows that repeat a document are rows of their own. Either table
    empty: no rows. Very long texts are counted whole. Other columns are not read.
    """
    spark = docs.sparkSession
    results = []
    for block in _item_blocks(items, block_bytes):
        terms: dict[bytes, int] = {}
        coded = [sorted({terms.setdefault(w, len(terms)) for w in words_of(text)}) for _, text in block]
        vocabulary = spark.sparkContext.broadcast(list(terms))
        postings = stage(
            docs.select("doc_id", "text").mapInArrow(
                _counter(vocabulary), _typed(docs, "doc_id", "doc_id") + ", n long, codes binary, times binary"
            ),
            "lexical-postings",
        )
        counts = postings.select("n", "codes").mapInArrow(_holders, "code long, held long")
        # As many rows as the block of items has terms, and two more.
        held = {r.code: r.held for r in counts.groupBy("code").agg(F.sum("held").alias("held")).collect()}
        documents, length = held.get(_DOCUMENTS, 0), held.get(_LENGTH, 0)
        weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(c, 0) + 1))) for c in range(len(terms))],
            dtype=np.int64,
        )
        wanted = [np.array([c for c in codes if weights[c] > 0], dtype=np.int64) for codes in coded]
        shared = spark.sparkContext.broadcast((wanted, weights, documents, length))
        best = postings.mapInArrow(_searcher(shared, k), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item long, item_id long")
        results.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _typed(df: DataFrame, column: str, name: str) -> str:
    return f"{name} {df.schema[column].dataType.simpleString()}"
