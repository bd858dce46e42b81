"""MinHash near-duplicates: a multi-index Hamming join of b-bit signatures, links confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.components import components
from ebbline.llm.repeats import _likely
from ebbline.llm.tables import row_key, whole_text
from ebbline.workspace import stage

WIDTH = 5
PERCENT = 85
SYMBOLS = 64  # minima of a signature, of 16 bits each
ERRORS = 23  # signatures that differ in this many symbols or fewer are candidates
BLOCK_SETS = 512  # sets that are compared with each other in one task,
BLOCK_SHINGLES = 400_000  # or fewer, if they hold more shingles than this
_AT_ONCE = 4_096  # shingles that are hashed together

_SEED = np.random.default_rng(13)
_FACTORS = _SEED.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_TERMS = _SEED.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct XXH64 of all runs of `width` words, sorted; fewer words are one run. bytes.lower touches A-Z
    only, bytes.split cuts at the six ASCII white-space bytes only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1).tolist()
    if len(words) <= width:
        starts, ends = [0], ends[-1:]
    else:
        starts, ends = [0, *(e + 1 for e in ends[:-width])], ends[width - 1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b]) for a, b in zip(starts, ends)), dtype=np.uint64, count=len(starts)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS minima over seeded hashes of the set, 16 bits of each."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _AT_ONCE):
        mixed = shingles[at:at + _AT_ONCE, None] * _FACTORS
        mixed += _TERMS
        mixed ^= mixed >> np.uint64(31)
        np.minimum(least, mixed.min(axis=0), out=least)
    return ((least * _FACTORS[0]) >> np.uint64(48)).astype(np.uint16)


def chunks(symbols: int = SYMBOLS, errors: int = ERRORS) -> list[tuple[int, int]]:
    """(begin, end) of so many chunks that one of them at least holds one error at most."""
    count = errors // 2 + 1
    edges = [symbols * i // count for i in range(count + 1)]
    return list(zip(edges, edges[1:]))


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, signatures = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                names.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            kept = [batch.column(c) for c in ("doc_id", "id", "mark")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "id", "mark", "n_shingles", "name", "signature"],
            )

    return sign


def _setter(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())], ["name", "shingles"],
            )

    return sets


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shingle, node: the sets as rows."""
    for batch in batches:
        for node, held in zip(batch.column("node").to_pylist(), batch.column("shingles")):
            shingles = np.frombuffer(held.as_py(), dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"shingle": shingles, "node": np.full(len(shingles), node, dtype=np.int64)})


def _symbol(place: int) -> Column:
    return F.substring("signature", 2 * place + 1, 2)


def _keys(nodes: DataFrame) -> DataFrame:
    """key, node: for each chunk its symbols but one, for every one that may be the error."""
    keys = []
    for number, (begin, end) in enumerate(chunks()):
        for error in range(begin, end):
            rest = [_symbol(p) for p in range(begin, end) if p != error]
            keys.append(F.xxhash64(F.lit(number), F.lit(error), F.concat(*rest)))
    return nodes.select("node", F.explode(F.array(*keys)).alias("key"))


def _buckets(keys: DataFrame) -> DataFrame:
    """key, hub (its least node) for the keys of several nodes."""
    found = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    return stage(found.select("key", "hub"), "minhash-buckets")


def _differing():
    @F.pandas_udf("int")
    def differing(a: pd.Series, b: pd.Series) -> pd.Series:
        """How many symbols of two signatures differ."""
        left, right = (np.frombuffer(b"".join(x), dtype=np.uint16).reshape(-1, SYMBOLS) for x in (a, b))
        return pd.Series((left != right).sum(axis=1).astype("int32"))

    return differing


def _within(pairs: DataFrame, nodes: DataFrame, a: str, b: str, errors: int) -> DataFrame:
    """The rows of `pairs` whose nodes `a` and `b` have signatures that differ in `errors` symbols or fewer."""
    signed = nodes.select("node", "signature")
    for column, name in ((a, "__a"), (b, "__b")):
        pairs = pairs.join(signed.select(F.col("node").alias(column), F.col("signature").alias(name)), column)
    return pairs.filter(_differing()("__a", "__b") <= errors).drop("__a", "__b")


def _sets(docs: DataFrame, nodes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """node, shingles (the whole set, packed) of the nodes that share a bucket with another one."""
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "name", "id", "mark")
    wanted = stage(wanted, "minhash-wanted")
    texts = docs.select(*row_key(), whole_text().alias("text"))
    texts = _likely(texts, wanted).join(wanted.select("id", "mark"), ["id", "mark"], "left_semi").select("text")
    sets = texts.mapInArrow(_setter(width), "name binary, shingles binary").dropDuplicates(["name"])
    return stage(sets.join(wanted, "name").select("node", "shingles"), "minhash-sets")


def _able(sets: DataFrame, percent: int) -> DataFrame:
    """node, shared: those that may have a link at all, with how many of their shingles another candidate holds, too.

    No intersection is larger than `shared`, and no union smaller than the set: what a text has alone keeps it
    from all others, without a comparison. Candidates are compared with candidates only, so counting these is enough.
    """
    held = sets.mapInArrow(_spread, "shingle long, node long")
    alone = held.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1")
    alone = alone.groupBy("node").agg(F.count("*").alias("alone"))
    size = (F.octet_length("shingles") / 8).cast("long")
    counted = sets.select("node", size.alias("n_shingles")).join(alone, "node", "left").select(
        "node", "n_shingles", (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("shared")
    )
    return stage(counted.filter(100 * F.col("shared") >= percent * F.col("n_shingles")).select("node", "shared"), "minhash-able")


def _homes(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """node, home for the nodes of `members`: a node within ERRORS of it, itself if there is no better one.

    Every bucket offers its least node as a hub. Of the hubs within ERRORS a node takes the one that most nodes are
    near to, so that a group of near copies meets at few homes.
    """
    star = members.filter("node <> hub").select("node", "hub").distinct()
    near = stage(_within(star, nodes, "node", "hub", ERRORS), "minhash-near")
    popular = stage(near.groupBy("hub").agg(F.count("*").alias("n")), "minhash-hubs")
    offers = near.join(popular, "hub").select("node", "hub", "n")
    own = members.select("node").distinct().join(popular, F.col("node") == F.col("hub"), "left").select(
        "node", F.col("node").alias("hub"), F.coalesce("n", F.lit(0)).alias("n")
    )
    chosen = offers.unionByName(own).groupBy("node").agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("best"))
    return stage(chosen.select("node", (-F.col("best.hub")).alias("home")), "minhash-homes")


def _units(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """unit, node, guest: groups in which all pairs of signatures within ERRORS meet.

    Let two such signatures share a bucket. Each is within ERRORS of its home, so the one is within 2 * ERRORS of the
    home of the other: it is a guest there, if that home is the smaller one. Distances are a metric, so no pair
    is lost, and a bucket costs its members times the homes among them, not its pairs.
    """
    homes = _homes(nodes, members)
    at_home = stage(members.select("key", "node").join(homes, "node"), "minhash-at-home")
    present = at_home.select("key", F.col("home").alias("unit")).distinct()
    visits = at_home.join(present, "key").filter("unit < home").select("node", "unit").distinct()
    guests = _within(visits, nodes, "node", "unit", 2 * ERRORS)
    units = homes.select(F.col("home").alias("unit"), "node", F.lit(False).alias("guest")).unionByName(
        guests.select("unit", "node", F.lit(True).alias("guest"))
    )
    return stage(units, "minhash-units")


def _linker(percent: int):
    """Links within a pair of blocks of one unit, enough of them to connect what is connected there."""

    def link(rows: pa.Table) -> pa.Table:
        node, guest, block = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("node", "guest", "block"))
        hub, alone = rows.column("is_hub").to_numpy(zero_copy_only=False), rows.column("i")[0] == rows.column("j")[0]
        sets = [np.frombuffer(s.as_py(), dtype=np.uint64) for s in rows.column("shingles")]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        shared = rows.column("shared").to_numpy()
        distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        inside = np.zeros(len(distinct), dtype=np.int8)
        group = np.arange(len(node))
        links: list[tuple[int, int]] = []

        def connect(x: int, others: np.ndarray) -> None:
            mine = codes[begins[x]:begins[x] + sizes[x]]
            inside[mine] = 1
            common = np.add.reduceat(inside[codes], begins, dtype=np.int64)
            inside[mine] = 0
            linked = others & (100 * common >= percent * (sizes + sizes[x] - common))
            for y in np.flatnonzero(linked).tolist():
                if group[y] != group[x]:
                    links.append((int(node[x]), int(node[y])))
                    group[group == group[y]] = group[x]

        everyone = np.ones(len(node), dtype=bool)
        for x in np.flatnonzero(hub).tolist():
            connect(x, everyone)
        # In the order of group sizes, so that those that hang together already are met as others only.
        members = np.bincount(group, minlength=len(node))[group]
        waiting = everyone.copy()
        for x in np.lexsort((node, members)).tolist():
            waiting[x] = False
            most = np.minimum(shared, shared[x])
            others = waiting & (group != group[x]) & (100 * most >= percent * (sizes + sizes[x] - most))
            if not alone:
                others &= block != block[x]
            if guest[x]:
                others &= ~guest
            if others.any():
                connect(x, others)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return link


def _links(nodes: DataFrame, units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between nodes, on whole shingle sets."""
    sizes = units.join(nodes.select("node", "n_shingles"), "node").groupBy("unit").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("shingles")
    )
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    sizes = stage(sizes.filter("members > 1").select("unit", blocks.cast("int").alias("blocks")), "minhash-blocks")
    placed = units.join(sizes, "unit").withColumn(
        "block", F.pmod(F.xxhash64("node", "unit"), F.col("blocks")).cast("int")
    )
    placed = stage(placed, "minhash-placed")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("block", o).alias("i"), F.greatest("block", o).alias("j"), F.lit(False).alias("is_hub")
    ))
    pairs = placed.select("unit", "node", "guest", "block", F.explode(others).alias("pair")).select(
        "unit", "node", "guest", "block", "pair.*"
    )
    # The set of a hub goes into every pair of blocks: what is linked to it hangs together without further pairs.
    lines = F.sequence(F.lit(0), F.col("blocks") - 1)
    hubs = sizes.filter("blocks > 1").select("unit", F.explode(lines).alias("i"), "blocks").select(
        "unit", "i", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)).alias("j")
    ).select(
        "unit", F.col("unit").alias("node"), F.lit(True).alias("guest"), F.lit(-1).alias("block"), "i", "j",
        F.lit(True).alias("is_hub"),
    )
    met = pairs.unionByName(hubs).join(sets, "node")
    return met.groupBy("unit", "i", "j").applyInArrow(_linker(percent), "a long, b long")


def minhash_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Near-duplicate components of `docs`: sets of `width`-word shingles link at a Jaccard similarity of
    `percent` / 100 or more, counted on the whole sets.

    Columns: doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included), kept (doc_id =
    component_id); one row per row of `docs`. Documents with equal sets are one node from the start.

    Candidates come from a multi-index Hamming join. A signature has 64 symbols, 16 bits of a minimum each; at a
    similarity s a symbol differs with probability 1 - s. Signatures within ERRORS = 23 differing symbols are all found:
    of 12 chunks one has one error at most, and each chunk is a key once for every symbol that may be the error.
    (At 0.85 more than 23 of 64 differ in 9 of a million pairs; at 0.9, in 5 of 10^9.) Buckets are not
    expanded into pairs: nodes whose own shingles rule out any link go first (`_able`), the others meet in units around
    hubs, in blocks of bounded size (`_units`), and a pair of blocks sends the links that connect it, not all. The
    work of a unit of g sets that are alike but not linked to its hub is still g^2 comparisons, spread over tasks.

    Null and empty texts have no shingles; such rows stand alone: component_id is their own doc_id and they are
    kept. A null doc_id is passed over when the smallest id is sought; `kept` is then false, unless all ids of the
    component are null: component_id is null and the row is kept. Rows that repeat an id and a text are all kept
    or all dropped together. Very long texts are hashed whole. An empty table gives no rows. Other columns are not
    read.
    """
    rows = docs.select("doc_id", *row_key(), F.col("text")).mapInArrow(
        _signer(width),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, id long, mark long, n_shingles long, name binary, "
        "signature binary",
    )
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "minhash-rows")
    one = F.min(F.struct("row", "id", "mark", "n_shingles", "signature")).alias("one")
    nodes = rows.filter("name IS NOT NULL").groupBy("name").agg(one, F.min("doc_id").alias("first_id"))
    nodes = stage(
        nodes.select("name", F.col("one.row").alias("node"), "one.id", "one.mark", "one.n_shingles", "one.signature", "first_id"),
        "minhash-nodes",
    )
    keys = _keys(nodes)
    met = stage(keys.join(_buckets(keys), "key").select("key", "node"), "minhash-met")
    sets = _sets(docs, nodes, met, width)
    able = _able(sets, percent)
    met = met.join(able.select("node"), "node")
    members = stage(met.join(_buckets(met), "key"), "minhash-members")
    units = _units(nodes, members)
    links = stage(_links(nodes, units, sets.join(able, "node"), percent), "minhash-links")
    found = components(links)
    linked = nodes.join(found, "node").select("name", "component", "first_id")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(linked.join(smallest, "component").select("name", "component_id", "component"), "name", "left")
    named = named.select(
        "name", F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    named = stage(named, "minhash-components").withColumnRenamed("name", "set_name")
    out = rows.join(named, F.col("name") == F.col("set_name"), "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
