"""Repeated byte strings of a fixed length, found over a prefix-free parse of the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.tables import row_key, whole_text
from ebbline.workspace import stage

LENGTH = 400
CELL = 16  # starts that are judged together before single ones are
BLOCK = 1 << 16  # starts that are hashed together
PLACE_BITS = 20
FILTER_BITS = 1 << 24  # of the document filter, which is 2 MB at most

_SEED = np.random.default_rng(2024)
_ODD = [np.uint64(int(x) | 1) for x in _SEED.integers(1 << 62, 1 << 63, 64)]


def _mixed(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """A hash of two hashes, in which their order counts."""
    out = left * _ODD[step]
    out += right
    out ^= out >> np.uint64(31)
    return out


class Hashes:
    """64-bit hashes of the strings of any length at any place of `data`, from those of lengths 1, 2, 4, ..."""

    def __init__(self, data: np.ndarray, longest: int):
        first = data.astype(np.uint64) * _ODD[62] + _ODD[63]
        first ^= first >> np.uint64(29)
        self.levels = [first]
        while 2 << (len(self.levels) - 1) <= longest:
            last, size = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_mixed(last[:-size], last[size:], len(self.levels)) if len(last) > size else last[:0])

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        out, done = None, 0
        for level in range(length.bit_length() - 1, -1, -1):
            if length >> level & 1:
                part = self.levels[level][places + done]
                out = part if out is None else _mixed(out, part, 20 + level)
                done += 1 << level
        return out


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` keys that follow each other."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def window_of(length: int) -> int:
    """Places among which the trigger of a start is sought; the trigger's common string is what remains."""
    return 3 * length // 5 + 1


_PHRASE = ("first", "last", "trigger", "common", "whole", "until", "times")


def phrases(data: np.ndarray, pieces: list[tuple[int, int]], length: int) -> dict[str, np.ndarray]:
    """The parse of the pieces (begin, end) of `data`: one row per phrase, that is per run of starts with one trigger.

    The trigger of a start is the place with the least rolling hash among the window_of(length) places from it, the
    first of equal ones. It depends on the next `length` bytes only, so equal strings have equal triggers, at
    equal distances. `common`: hash of the bytes that all strings through the trigger share; `whole`: hash of the
    extended phrase, from the first start of the run to the end of the string at its last start. Equal phrases that
    follow each other, as in text with a period, are one row: `times` of them, the last of which ends at start `until`.
    """
    width = window_of(length)
    shared = length - width + 1
    gram = 1 << (min(16, shared).bit_length() - 1)
    hashes = Hashes(data, length)
    starts = [np.arange(a, b - length + 1) for a, b in pieces if b - a >= length]
    if not starts:
        return {c: np.empty(0, np.int64) for c in _PHRASE}
    starts = np.concatenate(starts)
    rolling = hashes.levels[gram.bit_length() - 1]
    low = np.uint64(PLACE_BITS)
    keys = (rolling >> low << low) | np.arange(len(rolling), dtype=np.uint64)
    trigger = (_least(keys, width)[starts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    begins = np.concatenate(([0], np.flatnonzero(np.diff(trigger)) + 1))
    first, last = starts[begins], starts[np.append(begins[1:], len(starts)) - 1]
    trigger = trigger[begins]
    ends = _mixed(hashes.at(first, length), hashes.at(last, length), 40)
    shape = ((last - first).astype(np.uint64) << low) + (trigger - first).astype(np.uint64)
    common, whole = hashes.at(trigger, shared), _mixed(ends, shape, 41)
    piece = np.searchsorted([a for a, _ in pieces], first, "right")
    again = (whole[1:] == whole[:-1]) & (common[1:] == common[:-1]) & (piece[1:] == piece[:-1])
    heads = np.concatenate(([0], np.flatnonzero(~again) + 1))
    nexts = np.append(heads[1:], len(first))
    return {
        "first": first[heads], "last": last[heads], "trigger": trigger[heads],
        "common": common[heads].view(np.int64), "whole": whole[heads].view(np.int64),
        "until": last[nexts - 1], "times": nexts - heads,
    }


def _parse(length: int):
    names = ["id", "mark", *_PHRASE]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(p for _, _, p, _ in held), dtype=np.uint8)
            ends = np.cumsum([len(p) for _, _, p, _ in held])
            begins = ends - [len(p) for _, _, p, _ in held]
            found = phrases(data, list(zip(begins.tolist(), ends.tolist())), length)
            owner = np.searchsorted(begins, found["first"], "right") - 1
            move = np.array([offset for *_, offset in held], dtype=np.int64)[owner] - begins[owner]
            columns = [np.array([x[i] for x in held], dtype=np.int64)[owner] for i in (0, 1)]
            columns += [found[c] + move if c in ("first", "last", "trigger", "until") else found[c] for c in _PHRASE]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        held: list[tuple[int, int, bytes, int]] = []
        size = 0
        for batch in batches:
            for row_id, mark, text in zip(*(batch.column(i) for i in range(3))):
                whole = text.as_py()
                for offset in range(0, len(whole) - length + 1, BLOCK):
                    # A cut begins a new phrase; phrases that differ by a cut only are told equal start by start.
                    held.append((row_id.as_py(), mark.as_py(), whole[offset:offset + BLOCK + length - 1], offset))
                    size += len(held[-1][2])
                    if size >= BLOCK:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return parse


def _cells(length: int):
    """For each wanted phrase its cells: the starts at distances 16c to 16c + 15 before the trigger."""
    core_bytes = length - CELL + 1

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[] for _ in range(9)]
            for row in batch.to_pylist():
                text = row["bytes"]
                for phrase in row["wanted"]:
                    first, last, trigger = phrase["first"], phrase["last"], phrase["trigger"]
                    for c in range((trigger - last) // CELL, (trigger - first) // CELL + 1):
                        base = trigger - CELL * c
                        near, far = max(0, base - last), min(CELL - 1, base - first)
                        core = xxhash.xxh64_intdigest(text[base:base + core_bytes]) - (1 << 63)
                        cell = (
                            row["id"], row["mark"], base, near, far, phrase["single"], core,
                            text[base - far:base], text[base + core_bytes:base + length - near],
                        )
                        for column, value in zip(rows, cell):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, t in zip(rows, _CELL_TYPES)],
                ["id", "mark", "base", "near", "far", "single", "core", "before", "after"],
            )

    return cells


_CELL_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
_CELL_SCHEMA = (
    "id long, mark long, base long, near long, far long, single boolean, core long, before binary, after binary"
)


def _kept(length: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests = [], [], []
            for text, first, last in zip(*(batch.column(c) for c in ("bytes", "firsts", "lasts"))):
                data = text.as_py()
                a, b = (np.array(x.as_py(), dtype=np.int64) for x in (first, last))
                edges = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edges, a, 1)
                np.add.at(edges, b + length, -1)
                gone = np.cumsum(edges[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                digests.append(hashlib.sha256(np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digests, pa.string())],
                ["id", "mark", "removed", "spans", "digest"],
            )

    return kept


def _filter_place() -> Column:
    return F.pmod(F.xxhash64("id", "mark"), F.lit(FILTER_BITS)) + 1


def _likely(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `texts` whose (id, mark) may be in `keys`; a few others pass as well, none of `keys` is lost.

    The bits fill FILTER_BITS / 8 bytes at most, whatever the number of keys, so they can be broadcast; beyond
    some millions of keys the filter lets more rows pass, and the join that follows does the same work without it.
    """
    place = keys.select(_filter_place().alias("place"))
    bits = place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    placed = texts.withColumn("place", _filter_place()).withColumn("bucket", F.bitmap_bucket_number("place"))
    found = placed.join(F.broadcast(bits), "bucket").filter(
        F.expr("shiftright(cast(conv(hex(substring(bits, shiftright(cast(bitmap_bit_position(place) as int), 3) + 1, 1)), "
               "16, 10) as int), cast(bitmap_bit_position(place) as int) & 7) & 1 = 1")
    )
    return found.select(*texts.columns)


def _classes(rows: DataFrame, common: str, whole: str, times: str | None = None) -> DataFrame:
    """Of each value of `common` that occurs more than once: whether it has more than one `whole`."""
    n = F.sum(times) if times else F.count("*")
    counts = rows.groupBy(common).agg(n.alias("n"), F.min(whole).alias("a"), F.max(whole).alias("b"))
    return counts.filter("n > 1").select(common, (F.col("a") != F.col("b")).alias("mixed"))


def repeated_starts(texts: DataFrame, length: int) -> DataFrame:
    """id, mark, first, last: runs of starts whose string of `length` bytes starts elsewhere, too.

    Three rounds of the same question on ever smaller runs: what must be shared (`common`) and what the run is
    (`whole`). A run whose common part is unique has no repeated start; if all runs with that common part are the
    same, all their starts are repeated; only the others, one of each kind, go on: phrases to cells of 16 starts, cells
    to single starts. All rounds count with map-side sums and join on the shared part, so a passage that a third of
    all documents hold is one row per task and its joins can be split.
    """
    parsed = stage(
        texts.mapInArrow(
            _parse(length), ", ".join(f"{c} long" for c in ("id", "mark", *_PHRASE))
        ),
        "repeats-phrases",
    )
    shared = stage(_classes(parsed, "common", "whole", "times"), "repeats-common")
    several = stage(parsed.join(shared, "common"), "repeats-several")
    run = ["id", "mark", "first", F.col("until").alias("last")]
    runs = [several.filter("not mixed").select(*run)]

    unlike = several.filter("mixed")
    place = F.struct("id", "mark", "first", "last", "trigger")
    kinds = unlike.groupBy("common", "whole").agg(F.sum("times").alias("n"), F.min(place).alias("one"))
    kinds = stage(kinds, "repeats-dictionary")
    alike = kinds.filter("n > 1").select("common", "whole")
    runs.append(unlike.join(alike, ["common", "whole"]).select(*run))
    wanted = kinds.select("one.*", (F.col("n") == 1).alias("single")).groupBy("id", "mark").agg(
        F.collect_list(F.struct("first", "last", "trigger", "single")).alias("wanted")
    )
    wanted = stage(wanted, "repeats-wanted")
    held = _likely(texts, wanted).join(wanted, ["id", "mark"])
    # Rows that repeat id and text hold the same phrases; one of them speaks for all.
    cells = held.mapInArrow(_cells(length), _CELL_SCHEMA).withColumn("whole", F.xxhash64("near", "far", "before", "after"))
    cells = stage(cells.distinct(), "repeats-cells")
    cells = stage(cells.join(_classes(cells, "core", "whole"), "core"), "repeats-shared-cells")
    own = [F.col("base") - F.col("far"), F.col("base") - F.col("near")]
    ends = [own[0].alias("first"), own[1].alias("last")]
    runs.append(cells.filter("single and not mixed").select("id", "mark", *ends))

    unlike = cells.filter("mixed")
    kinds = stage(unlike.groupBy("core", "whole").agg(F.count("*").alias("n")), "repeats-cell-kinds")
    unlike = unlike.join(kinds, ["core", "whole"])
    runs.append(unlike.filter("single and n > 1").select("id", "mark", *ends))
    steps = unlike.dropDuplicates(["core", "whole"]).withColumn("step", F.explode(F.sequence("near", "far"))).select(
        "id", "mark", (F.col("base") - F.col("step")).alias("first"), (F.col("single") & (F.col("n") == 1)).alias("asks"),
        F.xxhash64(
            "core", "step",
            F.expr("substring(before, cast(far - step as int) + 1, cast(step as int))"),
            F.expr(f"substring(after, 1, cast({CELL - 1} - step as int))"),
        ).alias("string"),
    )
    steps = stage(steps, "repeats-starts")
    twice = stage(steps.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string"), "repeats-strings")
    runs.append(steps.filter("asks").join(twice, "string").select("id", "mark", "first", F.col("first").alias("last")))
    found = runs[0]
    for more in runs[1:]:
        found = found.unionByName(more)
    return stage(found, "repeats-runs")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte that a string of `length` bytes covers which also starts anywhere else in the corpus.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the remaining bytes); one
    row per row of `docs`. Strings are judged on the input, overlap, and never cross documents; places of the
    same document count.

    Null text is no bytes; texts shorter than `length` stay whole. A null doc_id is an id of its own. A row that
    repeats id and text is another place, so all its strings repeat; such rows have equal results. An empty
    table gives no rows. Texts of any length are parsed in blocks. Other columns are not read.
    """
    if length < 2 * CELL:
        raise ValueError(f"strings have {2 * CELL} bytes at least")
    texts = docs.select(
        *row_key(),
        whole_text().cast("binary").alias("bytes"),
    )
    runs = repeated_starts(texts.filter(F.octet_length("bytes") >= length), length)
    places = runs.groupBy("id", "mark").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    places = stage(
        places.select("id", "mark", F.col("runs.first").alias("firsts"), F.col("runs.last").alias("lasts")), "repeats-places"
    )
    cut = _likely(texts, places).join(places, ["id", "mark"]).mapInArrow(
        _kept(length), "id long, mark long, removed long, spans long, digest string"
    )
    cut = stage(cut.dropDuplicates(["id", "mark"]), "repeats-cut")
    whole = docs.select(
        "doc_id",
        *row_key(),
        F.octet_length(whole_text()).cast("long").alias("n_bytes"),
        F.sha2(whole_text().cast("binary"), 256).alias("all_bytes"),
    )
    return whole.join(cut, ["id", "mark"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.lit(0)).alias("n_spans"),
        F.coalesce("digest", "all_bytes").alias("kept_sha256"),
    )
