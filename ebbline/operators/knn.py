"""Exact k-nearest-neighbour join of vectors, pruned by pivots, boxes and the triangle inequality.

Donors belong to the cell of their nearest pivot; neighbouring cells form packs of bounded size. A query first
searches the pack it lies in, which bounds its radius, and then the packs with a cell that can hold one of its
k nearest. Inside a pack it meets only such cells. Blocks are bounded on both sides, and only the k best per query
leave a task. No pair of rows is ever emitted as such, and no group is unbounded.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.workspace import stage

# Workers get these functions with the task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096  # of a pack of few rows; four times as many at most
MAX_PIVOTS = 2048  # a bound on what comes to the driver; it changes work, not results
CELL_ROWS = 256  # donors for which there is one more pivot, up to the most
_CHUNK = 64
_ASKED_AT_ONCE = 1024  # queries that a task measures together
_SLACK = 1e-9  # widens the bounds, so rounding never prunes a true neighbour


def distances(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two small blocks of vectors, `_CHUNK` rows of `left` at a time."""
    out = np.empty((len(left), len(right)))
    for start in range(0, len(left), _CHUNK):
        apart = left[start : start + _CHUNK, None, :] - right[None, :, :]
        if metric == "manhattan":
            out[start : start + _CHUNK] = np.abs(apart).sum(axis=2)
        else:
            out[start : start + _CHUNK] = np.sqrt((apart * apart).sum(axis=2))
    return out


def _rough(left: np.ndarray, right: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """All distances within a rounding error, and what that may be."""
    if metric == "manhattan":
        out, slack = np.zeros((len(left), len(right))), 0.0
        for start in range(0, len(left), _CHUNK):  # a chunk stays in the processor's cache
            part, apart = out[start : start + _CHUNK], np.empty((len(left[start : start + _CHUNK]), len(right)))
            for x, y in zip(left[start : start + _CHUNK].T, right.T):
                np.subtract(x[:, None], y[None, :], out=apart)
                np.abs(apart, out=apart)
                part += apart
        return out, 1e-12 * out.max(initial=0.0)
    squares = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :]
    slack = 1e-6 * np.sqrt(squares.max(initial=0.0))
    squares -= 2 * (left @ right.T)
    return np.sqrt(np.maximum(squares, 0, out=squares), out=squares), slack


def _nearest_pivot(vectors: np.ndarray, pivots: np.ndarray, metric: str) -> np.ndarray:
    parts = range(0, len(vectors), _ASKED_AT_ONCE)
    found = [_rough(vectors[i : i + _ASKED_AT_ONCE], pivots, metric)[0].argmin(axis=1) for i in parts]
    return np.concatenate(found) if found else np.empty(0, dtype=int)


def _from_box(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every vector to every box; nothing inside a box is nearer."""
    out = np.zeros((len(vectors), len(low)))
    for x, least, most in zip(vectors.T, low.T, high.T):
        gap = np.maximum(least[None, :] - x[:, None], x[:, None] - most[None, :])
        np.maximum(gap, 0.0, out=gap)
        out += gap if metric == "manhattan" else gap * gap
    return out if metric == "manhattan" else np.sqrt(out)


def _packs(pivots: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """The pack of each cell: cells are halved along the widest side until a part has `limit` rows at most."""
    pack, number, parts = np.zeros(len(rows), dtype=int), 0, [np.flatnonzero(rows > 0)]
    while parts:
        cells = parts.pop()
        if len(cells) <= 1 or rows[cells].sum() <= limit:
            pack[cells] = number
            number += len(cells) > 0
            continue
        at = pivots[cells]
        cells = cells[np.argsort(at[:, np.ptp(at, axis=0).argmax()], kind="stable")]
        upto = np.cumsum(rows[cells])
        half = min(max(1, int(np.searchsorted(upto, upto[-1] / 2))), len(cells) - 1)
        parts += [cells[half:], cells[:half]]
    return pack


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.to_list(), dtype=float)


@dataclass(frozen=True)
class Cells:
    """Bounded statistics of the cells: pivots, rows, radius, the m smallest distances to the pivot, boxes and packs."""

    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    inner: list[list[float]]
    metric: str
    low: np.ndarray | None = None  # least and greatest value of each coordinate
    high: np.ndarray | None = None
    limit: int = BLOCK_ROWS  # rows of a pack, unless it is one cell; that is cut into blocks of so many

    @property
    def pack(self) -> np.ndarray:
        return _packs(self.pivots, self.rows, self.limit)

    def blocks(self) -> np.ndarray:
        """Blocks of each pack; more than one only where a single cell has more rows than fit."""
        rows = np.bincount(self.pack, self.rows)
        return np.maximum(1, -(-rows.astype(int) // self.limit))

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The cell with donors whose pivot is nearest."""
        used = np.flatnonzero(self.rows > 0)
        return used[_nearest_pivot(vectors, self.pivots[used], self.metric)] if len(used) else np.zeros(len(vectors), dtype=int)

    def within(self, vectors: np.ndarray, limit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """vectors x cells: whether a cell may hold donors no farther than `limit`."""
        reach = limit[:, None] * (1 + _SLACK) + _SLACK
        return _from_box(vectors, self.low[cells], self.high[cells], self.metric) <= reach

    def visited(self, vectors: np.ndarray, wanted: int) -> list[list[int]]:
        """Per query the cells that may hold one of its `wanted` nearest donors."""
        inner = np.array([d[wanted - 1] if len(d) >= wanted else np.inf for d in self.inner])
        used = self.rows > 0
        to_pivot = distances(vectors, self.pivots, self.metric)
        reach = np.where(used, to_pivot + self.radius, np.inf)
        order = np.argsort(reach, axis=1)
        filled = np.cumsum(self.rows[order], axis=1) >= wanted
        nth = np.take_along_axis(np.take_along_axis(reach, order, axis=1), filled.argmax(axis=1)[:, None], axis=1)[:, 0]
        bound = np.minimum(np.where(filled.any(axis=1), nth, np.inf), np.min(to_pivot + inner, axis=1))[:, None]
        least = np.maximum(to_pivot - self.radius, (to_pivot - to_pivot.min(axis=1, keepdims=True)) / 2)
        keep = used & (least <= bound * (1 + _SLACK) + _SLACK)
        return [np.flatnonzero(cells).tolist() for cells in keep]

    def packs_within(self, vectors: np.ndarray, limit: np.ndarray, home: np.ndarray) -> list[list[int]]:
        """Per query the packs with a cell that may hold donors no farther than `limit`; that of `home` only if it is
        cut into blocks, as the query has met but one of them."""
        used, pack, blocks = np.flatnonzero(self.rows > 0), self.pack, self.blocks()
        used = used[np.argsort(pack[used], kind="stable")]
        first = np.flatnonzero(np.diff(pack[used], prepend=-1))
        out = []
        for i in range(0, len(vectors), _CHUNK):
            part = slice(i, i + _CHUNK)
            met = np.maximum.reduceat(self.within(vectors[part], limit[part], used), first, axis=1)
            own = pack[home[part]]
            met[np.arange(len(met)), own] &= blocks[own] > 1
            out += [np.flatnonzero(row).tolist() for row in met]
        return out


def nearest_in_block(
    asking: np.ndarray, giving: np.ndarray, names: np.ndarray, k: int, metric: str, same: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of `asking`, row of `giving`, distance) of the `k` nearest, ties by name; `same` marks pairs to leave out.

    A matrix product gives distances within rounding; only pairs that can be among the nearest are then
    measured exactly.
    """
    rough, slack = _rough(asking, giving, metric)
    if same is not None:
        rough[same] = np.inf
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if k < rough.shape[1] else np.full(len(rough), np.inf)
    i, j = np.nonzero((rough <= limit[:, None] + 2 * slack) & np.isfinite(rough))
    apart = asking[i] - giving[j]
    away = np.abs(apart).sum(axis=1) if metric == "manhattan" else np.sqrt((apart * apart).sum(axis=1))
    order = np.lexsort((names[j], away, i))
    i, j, away = i[order], j[order], away[order]
    first = np.searchsorted(i, i)  # where the row of `asking` begins
    best = np.arange(len(i)) - first < k
    return i[best], j[best], away[best]


def nearest_in_pack(
    asking: np.ndarray, asked: np.ndarray, home: np.ndarray | None, limit: np.ndarray, giving: np.ndarray,
    names: np.ndarray, cell: np.ndarray, cells: Cells, k: int, others: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `nearest_in_block`, of the donors of a pack no farther than `limit`; only cells that can hold such are met.

    With `home`, a query's own cell is met first and may lower its limit. `others` leaves out pairs of equal names.
    """
    order = np.argsort(cell, kind="stable")
    here, first = np.unique(cell[order], return_index=True)
    members = np.split(order, first[1:])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def meet(rows: np.ndarray, donors: np.ndarray) -> None:
        for begin in range(0, len(rows), _ASKED_AT_ONCE):
            part = rows[begin : begin + _ASKED_AT_ONCE]
            same = asked[part][:, None] == names[donors][None, :] if others else None
            i, j, away = nearest_in_block(asking[part], giving[donors], names[donors], k, cells.metric, same)
            found.append((part[i], donors[j], away))

    at_home = np.zeros((len(asking), len(here)), dtype=bool)
    if home is not None and len(here) > 1:
        at_home = home[:, None] == here[None, :]
        for nth, donors in enumerate(members):
            meet(np.flatnonzero(at_home[:, nth]), donors)
        if found:
            i, away = (np.concatenate([f[n] for f in found]) for n in (0, 2))
            farthest = np.zeros(len(asking))
            np.maximum.at(farthest, i, away)
            limit = np.where(np.bincount(i, minlength=len(asking)) >= k, np.minimum(limit, farthest), limit)
    wanted = cells.within(asking, limit, here)
    if (wanted @ np.array([len(m) for m in members])).sum() > 0.5 * len(asking) * len(giving):
        found.clear()  # little is pruned: one product over the whole pack is quicker
        meet(np.arange(len(asking)), np.arange(len(giving)))
    else:
        for nth, donors in enumerate(members):
            meet(np.flatnonzero(wanted[:, nth] & ~at_home[:, nth]), donors)
    if not found:
        return np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0)
    i, j, away = (np.concatenate([f[n] for f in found]) for n in range(3))
    order = np.lexsort((names[j], away, i))
    i, j, away = i[order], j[order], away[order]
    best = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[best], j[best], away[best]


def _measurable(vector: str) -> Column:
    """A vector that is there and holds numbers only."""
    numbers = F.col(vector).cast("array<double>")
    return numbers.isNotNull() & ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x))


@dataclass(frozen=True)
class KnnIndex:
    """Donors (`_cell`, `_pack`, `_block`, `neighbour`, `vector`, payload) with their cell statistics."""

    donors: DataFrame
    cells: Cells
    payload: list[str]

    @classmethod
    def fit(
        cls, df: DataFrame, key: str, vector: str, payload: list[str] = (), metric: str = "euclidean",
        most: int = 16,
    ) -> KnnIndex:
        """`df` has unique keys; up to `most` neighbours can be asked for with sharp bounds."""
        rows = df.where(_measurable(vector)).select(
            F.col(key).alias("neighbour"), F.col(vector).cast("array<double>").alias("vector"), *payload
        )
        count = rows.count()
        pivots_wanted = max(4, min(MAX_PIVOTS, max(round(math.sqrt(count) / 2), count // CELL_ROWS)))
        sample = rows.orderBy(F.xxhash64("neighbour"), "neighbour").limit(pivots_wanted).select("vector")
        pivots = np.array([r["vector"] for r in sample.collect()], dtype=float)

        @F.pandas_udf("struct<cell int, away double>")
        def nearest_pivot(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for vectors in batches:
                matrix = _matrix(vectors)
                cell = _nearest_pivot(matrix, pivots, metric)
                apart = matrix - pivots[cell]
                away = np.abs(apart).sum(axis=1) if metric == "manhattan" else np.sqrt((apart * apart).sum(axis=1))
                yield pd.DataFrame({"cell": cell.astype("int32"), "away": away})

        def boxes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            low, high = np.full(pivots.shape, np.inf), np.full(pivots.shape, -np.inf)
            for batch in batches:
                if len(batch):
                    cell, matrix = batch["_cell"].to_numpy(), _matrix(batch["vector"])
                    order = np.argsort(cell, kind="stable")
                    held, first = np.unique(cell[order], return_index=True)
                    low[held] = np.minimum(low[held], np.minimum.reduceat(matrix[order], first, axis=0))
                    high[held] = np.maximum(high[held], np.maximum.reduceat(matrix[order], first, axis=0))
            held = np.flatnonzero((low <= high).any(axis=1)) if pivots.size else np.empty(0, dtype=int)
            if len(held):
                yield pd.DataFrame({"_cell": held.astype("int32"), "low": list(low[held]), "high": list(high[held])})

        assigned = rows.withColumn("_at", nearest_pivot("vector"))
        assigned = stage(
            assigned.select("neighbour", "vector", *payload, F.col("_at.cell").alias("_cell"), F.col("_at.away").alias("_away")),
            "knn-donors",
        )
        sizes = assigned.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_away").alias("radius"))
        closest = Window.partitionBy("_cell").orderBy("_away", "neighbour")
        inner = (
            assigned.select("_cell", "_away", "neighbour")
            .withColumn("_nth", F.row_number().over(closest))
            .where(F.col("_nth") <= most + 1)
            .groupBy("_cell")
            .agg(F.array_sort(F.collect_list("_away")).alias("inner"))
        )
        found = {r["_cell"]: r for r in sizes.join(inner, "_cell").collect()}  # one row per pivot
        sides = (
            assigned.select("_cell", "vector").mapInPandas(boxes, "_cell int, low array<double>, high array<double>")
            .select("_cell", F.posexplode(F.arrays_zip("low", "high")).alias("nth", "side"))
            .groupBy("_cell", "nth").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
        )
        low, high = np.zeros(pivots.shape), np.zeros(pivots.shape)
        listed = sides.toPandas()  # one row per pivot and coordinate
        low[listed["_cell"], listed["nth"]], high[listed["_cell"], listed["nth"]] = listed["low"], listed["high"]
        cells = Cells(
            pivots,
            np.array([found[i]["n"] if i in found else 0 for i in range(len(pivots))]),
            np.array([found[i]["radius"] if i in found else 0.0 for i in range(len(pivots))]),
            [list(found[i]["inner"]) if i in found else [] for i in range(len(pivots))],
            metric, low, high, min(4 * BLOCK_ROWS, max(BLOCK_ROWS, count // 32)),
        )
        pack, blocks = cells.pack, cells.blocks()
        numbers = F.array(*[F.lit(int(p)) for p in pack])
        cut = F.array(*[F.lit(int(n)) for n in (blocks[pack] if len(blocks) else pack + 1)])
        donors = assigned.withColumn("_pack", F.get(numbers, F.col("_cell"))).withColumn(
            "_block", F.pmod(F.xxhash64("neighbour"), F.get(cut, F.col("_cell"))).cast("int")
        ).drop("_away")
        return cls(donors, cells, list(payload))

    def save(self, path: str) -> None:
        spark, cells = self.donors.sparkSession, self.cells
        self.donors.write.mode("overwrite").parquet(f"{path}/donors")
        rows = [
            (i, [float(x) for x in cells.pivots[i]], int(cells.rows[i]), float(cells.radius[i]), [float(x) for x in cells.inner[i]],
             [float(x) for x in cells.low[i]], [float(x) for x in cells.high[i]])
            for i in range(len(cells.pivots))
        ]
        kinds = "number int, pivot array<double>, rows long, radius double, inner array<double>, low array<double>, high array<double>"
        spark.createDataFrame(rows, kinds).write.mode("overwrite").parquet(f"{path}/cells")
        named = spark.createDataFrame([(cells.metric, self.payload, cells.limit)], "metric string, payload array<string>, most int")
        named.write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KnnIndex:
        found = spark.read.parquet(f"{path}/cells").orderBy("number").collect()  # one row per pivot, MAX_PIVOTS at most
        settings = spark.read.parquet(f"{path}/settings").head()
        cells = Cells(
            np.array([r["pivot"] for r in found], dtype=float), np.array([r["rows"] for r in found]),
            np.array([r["radius"] for r in found]), [list(r["inner"]) for r in found], settings["metric"],
            np.array([r["low"] for r in found], dtype=float), np.array([r["high"] for r in found], dtype=float), settings["most"],
        )
        return cls(spark.read.parquet(f"{path}/donors"), cells, list(settings["payload"]))

    def neighbours(self, queries: DataFrame, key: str, vector: str, k: int, other_than_self: bool = False) -> DataFrame:
        """(key, rank, neighbour, distance, payload): the `k` nearest donors per query; ties by donor key.

        Vectors that are NULL or hold NULL or NaN are no donors, and as queries have no neighbours.
        """
        cells, payload = self.cells, self.payload
        pack, blocks, limit = cells.pack, cells.blocks(), cells.limit

        @F.pandas_udf("struct<_home int, _pack int, _cut int>")
        def home(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for vectors in batches:
                own = cells.home(_matrix(vectors))
                yield pd.DataFrame({"_home": own, "_pack": pack[own], "_cut": blocks[pack[own]]}, dtype="int32")

        @F.pandas_udf("array<int>")
        def further(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for vectors, bounds, own in batches:
                reach = bounds.fillna(np.inf).to_numpy(dtype=float)
                yield pd.Series(cells.packs_within(_matrix(vectors), reach, own.to_numpy()), index=vectors.index, dtype=object)

        key_type, name_type = queries.select(key).dtypes[0][1], dict(self.donors.dtypes)["neighbour"]
        kinds = dict(self.donors.dtypes)
        fields = [f"_key {key_type}", f"neighbour {name_type}", "distance double"]
        schema = ", ".join(fields + [f"`{c}` {kinds[c]}" for c in payload])

        def best(asking: pd.DataFrame, giving: pd.DataFrame) -> pd.DataFrame:
            if asking.empty or giving.empty:
                return pd.DataFrame({c: [] for c in ["_key", "neighbour", "distance", *payload]})
            names, asked_names = giving["neighbour"].to_numpy(), asking["_key"].to_numpy()
            i, j, away = nearest_in_pack(
                _matrix(asking["_vector"]), asked_names, asking["_home"].to_numpy(),
                asking["_bound"].astype(float).fillna(np.inf).to_numpy(),
                _matrix(giving["vector"]), names, giving["_cell"].to_numpy(), cells, k, other_than_self,
            )
            chosen = giving.iloc[j][["neighbour", *payload]].reset_index(drop=True)
            return chosen.assign(_key=asked_names[i], distance=away)[
                ["_key", "neighbour", "distance", *payload]
            ]

        group = ["_pack", "_block", "_part"]

        def search(visits: DataFrame) -> DataFrame:
            """Every visit (_key, _vector, _home, _bound, _pack, _block) answered by its block."""
            asked_by = {r["_pack"]: r["n"] for r in visits.groupBy("_pack").agg(F.count("*").alias("n")).collect()}
            parts = F.array(*[
                F.lit(max(1, -(-asked_by.get(p, 0) // int(limit * blocks[p])))) for p in range(len(blocks))
            ])
            left = visits.withColumn("_part", F.pmod(F.xxhash64("_key", F.lit(1)), F.get(parts, F.col("_pack"))).cast("int"))
            right = self.donors.withColumn("_part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("_pack")) - 1)))
            return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(best, schema)

        asked = queries.where(_measurable(vector)).select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_vector"))
        if not len(blocks):  # no donors
            found = search(asked.limit(0).withColumns({c: F.lit(0) for c in ("_home", "_pack", "_block")}).withColumn("_bound", F.lit(0.0)))
        else:
            asked = asked.withColumn("_at", home("_vector")).select(
                "_key", "_vector", "_at._home", "_at._pack",
                F.pmod(F.xxhash64("_key"), F.col("_at._cut")).cast("int").alias("_block"),
            )
            asked = stage(asked, "knn-queries")
            found = search(asked.withColumn("_bound", F.lit(None).cast("double")))
            if blocks.sum() > 1:
                near = stage(found, "knn-home")
                bound = near.groupBy(F.col("_key").alias("_named")).agg(
                    F.when(F.count("*") >= k, F.max("distance")).alias("_bound")
                )
                visits = asked.join(bound, F.col("_key").eqNullSafe(F.col("_named")), "left").drop("_named")
                visits = visits.withColumn("_packs", further("_vector", "_bound", "_home"))
                visits = stage(visits.where(F.size("_packs") > 0), "knn-visits")
                cut = F.array(*[F.lit(int(n)) for n in blocks])
                visits = (
                    visits.withColumnsRenamed({"_pack": "_own", "_block": "_met"})
                    .withColumn("_pack", F.explode("_packs"))
                    .withColumn("_block", F.explode(F.sequence(F.lit(0), F.get(cut, F.col("_pack")) - 1)))
                    .where((F.col("_pack") != F.col("_own")) | (F.col("_block") != F.col("_met")))
                )
                found = near.unionByName(search(visits.select("_key", "_vector", "_home", "_bound", "_pack", "_block")))
        nearest = Window.partitionBy("_key").orderBy("distance", "neighbour")
        return (
            found.withColumn("rank", F.row_number().over(nearest))
            .where(F.col("rank") <= k)
            .select(F.col("_key").alias(key), "rank", "neighbour", "distance", *payload)
        )


def vote(neighbours: DataFrame, key: str, label: str, weights: str = "uniform") -> DataFrame:
    """(key, class, share): share of the neighbours' votes per class.

    With distance weights a neighbour counts 1/distance; where some distance is 0 only those count.
    """
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy(key))
        weight = F.when(exact == 1, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
    else:
        weight = F.lit(1.0)
    votes = neighbours.withColumn("_weight", weight).groupBy(key, F.col(label).alias("class")).agg(
        F.sum("_weight").alias("votes")
    )
    return votes.withColumn("share", F.col("votes") / F.sum("votes").over(Window.partitionBy(key))).drop("votes")


def predicted_class(shares: DataFrame, key: str) -> DataFrame:
    """The class with the largest share; ties go to the smallest class."""
    return shares.groupBy(key).agg(
        F.max_by("class", F.struct("share", -F.col("class"))).alias("prediction"), F.max("share").alias("share")
    )
