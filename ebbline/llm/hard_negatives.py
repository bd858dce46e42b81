"""Hard negatives: the best rows of other labels in a window of scores under each positive, by slots of scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.workspace import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of the positive's score
ANCHORS_AT_ONCE = 32_768  # anchors that travel together,
SCORES_AT_ONCE = 4_000_000  # and scores that a task holds at a time
HELD_SCORES = 9 * 10**16  # scores stay within this, so that a hundredfold is still a long


def _finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _rows(df: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    rows = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _finite(F.col("vector")))


def _matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; shorter vectors are filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-numbered matrices, as long: exact also where doubles are not."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * width < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], dtype=object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -HELD_SCORES, HELD_SCORES).astype(np.int64)


def _best(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first `k` of their group: highest score first, then the smaller id."""
    order = np.lexsort((vec_id, -score, group))
    ordered = group[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]


class _Kept:
    """The first k of each group among all that a task has seen."""

    def __init__(self, k: int):
        self.k = k
        self.columns = [np.empty(0, dtype=np.int64) for _ in range(3)]  # group, score, vec_id

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if len(group):
            joined = [np.concatenate(c) for c in zip(self.columns, (group, score, vec_id))]
            chosen = _best(*joined, self.k)
            self.columns = [c[chosen] for c in joined]


def _chunks(batches: Iterator[pa.RecordBatch], anchors: int, scale: int):
    """(ids, labels, matrix) of few enough rows that their scores with all anchors stay within SCORES_AT_ONCE."""
    size = max(1, SCORES_AT_ONCE // max(1, anchors))
    for batch in batches:
        for begin in range(0, batch.num_rows, size):
            part = batch.slice(begin, size)
            labels = np.array(part.column("label").to_pylist(), dtype=object)
            yield part.column("vec_id").to_numpy(), labels, _matrix(part.column("vector"), scale)


def _positive_finder(shared, k: int, scale: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix = shared.value
        kept = _Kept(k)
        for row_ids, row_labels, rows in _chunks(batches, len(ids), scale):
            for label in set(row_labels.tolist()):
                ours, theirs = np.flatnonzero(labels == label), np.flatnonzero(row_labels == label)
                if not len(ours):
                    continue
                met = scores(matrix[ours], rows[theirs])
                other = ids[ours][:, None] != row_ids[theirs][None, :]
                if len(theirs) > k + 1:  # the anchor itself may be among the best, so one more
                    other &= met >= np.partition(met, len(theirs) - k - 1, axis=1)[:, [len(theirs) - k - 1]]
                a, b = np.nonzero(other)
                kept.add(ours[a], met[a, b], row_ids[theirs[b]])
        group, score, vec_id = kept.columns
        yield pa.RecordBatch.from_pydict({"anchor_id": ids[group], "score": score, "vec_id": vec_id})

    return find


def _negative_finder(shared, k: int, scale: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix, least, uppers = shared.value
        slots = uppers.shape[1] + 1
        kept = _Kept(k)
        for row_ids, row_labels, rows in _chunks(batches, len(ids), scale):
            met = scores(matrix, rows)
            inside = (met >= least[:, None]) & (met <= uppers[:, [0]]) & (labels[:, None] != row_labels[None, :])
            a, b = np.nonzero(inside)
            score = met[a, b]
            slot = (uppers[a] >= score[:, None]).sum(axis=1)  # the limits that it does not exceed
            kept.add(a * slots + slot, score, row_ids[b])
        group, score, vec_id = kept.columns
        yield pa.RecordBatch.from_pydict(
            {"anchor_id": ids[group // slots], "slot": group % slots, "score": score, "vec_id": vec_id}
        )

    return find


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its `positives` nearest rows of the same label, the best `negatives` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `rows` has vec_id, label,
    embedding; anchors are the rows for which `is_anchor` (over vec_id) holds. A score is the inner product of
    floor(scale * component); higher ones come first, ties by the smaller vec_id. A pair without rows in its window
    has no rows.

    The upper limits of an anchor's positives cut the scores into slots that do not overlap. Tasks score blocks of rows
    against a block of anchors and keep the `negatives` best of each slot. The window of a positive is its own
    slot and all below: their best, merged from the lowest slot upwards, answer all windows; what lies below
    the lower limit goes. So each pair of anchor and row is scored once for all windows, and a task sends
    positives x negatives rows an anchor at most. Anchors go out ANCHORS_AT_ONCE at a time, two passes each.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. A shorter
    vector counts as filled up with zeros, an empty one scores 0. Rows that repeat a vec_id are rows of their own,
    but never partners of the anchor of that id, and of such anchors the least by label and vector asks. Scores beyond
    HELD_SCORES count as that. An empty table gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    valid = _rows(rows)
    asking = valid.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("one"))
    asking = stage(asking.select("vec_id", "one.*"), "negatives-anchors")
    groups = max(1, -(-asking.count() // ANCHORS_AT_ONCE))
    found = []
    for group in range(groups):
        part = asking.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == group).orderBy("vec_id").toArrow()
        ids = part.column("vec_id").to_numpy()
        labels = np.array(part.column("label").to_pylist(), dtype=object)
        matrix = _matrix(part.column("vector").combine_chunks(), scale) if len(ids) else np.empty((0, 0))
        shared = spark.sparkContext.broadcast((ids, labels, matrix))
        near = valid.mapInArrow(_positive_finder(shared, positives, scale), "anchor_id long, score long, vec_id long")
        near = stage(_first(near, ["anchor_id"], positives), "negatives-positives")

        # positives x ANCHORS_AT_ONCE rows at most
        uppers = np.full((len(ids), positives), -HELD_SCORES - 1, dtype=np.int64)
        least = np.full(len(ids), HELD_SCORES + 1, dtype=np.int64)
        for r in near.select("anchor_id", "score", "nth").filter("score >= 0").collect():
            at = int(np.searchsorted(ids, r.anchor_id))
            uppers[at, r.nth - 1] = high * r.score // 100
            least[at] = min(least[at], -(-low * r.score // 100))
        shared = spark.sparkContext.broadcast((ids, labels, matrix, least, uppers))
        slots = valid.mapInArrow(
            _negative_finder(shared, negatives, scale), "anchor_id long, slot long, score long, vec_id long"
        )
        found.append(_answered(near, _first(slots, ["anchor_id", "slot"], negatives), positives, negatives, low))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _answered(near: DataFrame, slots: DataFrame, positives: int, negatives: int, low: int) -> DataFrame:
    """Each positive with the best of its slot and all lower ones that reach its lower limit."""
    entry = F.struct((-F.col("score")).alias("below"), "vec_id")
    held = slots.groupBy("anchor_id", "slot").agg(F.array_sort(F.collect_list(entry)).alias("best"))
    held = held.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("by_slot"))
    kind = "array<struct<below:bigint,vec_id:bigint>>"
    # From the lowest slot up: all its scores are above those merged before, so they go in front.
    merged = F.aggregate(
        F.sequence(F.lit(positives), F.lit(1), F.lit(-1)),
        F.array().cast(f"array<{kind}>"),
        lambda done, slot: F.concat(
            F.array(F.slice(
                F.concat(
                    F.coalesce(F.try_element_at("by_slot", slot.cast("long")), F.array().cast(kind)),
                    F.coalesce(F.try_element_at(done, F.lit(1)), F.array().cast(kind)),
                ), 1, negatives,
            )),
            done,
        ),
    )
    asked = near.filter("score >= 0").select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "nth"
    )
    windows = asked.join(held.select("anchor_id", merged.alias("merged")), "anchor_id")
    chosen = F.filter(F.element_at("merged", F.col("nth")), lambda x: -100 * x["below"] >= low * F.col("positive_score"))
    return windows.select("anchor_id", "positive_id", "positive_score", F.posexplode(chosen).alias("at", "one")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("negative_id"),
        "positive_score", (-F.col("one.below")).alias("negative_score"),
    )
