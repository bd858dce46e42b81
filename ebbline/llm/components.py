"""Connected components of a link table, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.workspace import stage


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node in `links` (a, b; both long, not null).

    Each round hooks a node, and the parent it has, below the smallest grandparent among its neighbours and then
    halves all paths, so long chains need about log2(length) rounds. Only minima move: a node with very many links
    is combined before the shuffle. Rounds are written out, so a lost executor costs a re-read. No links, no rows.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.filter("a <> b").distinct(), "links-both")
    parents = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent")), "parents"
    )
    total = _total(parents)
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        lifted = stage(parents.join(above, "parent"), "grandparents")
        nearby = both.join(lifted.select(F.col("node").alias("b"), "grand"), "b").groupBy("a").agg(
            F.min("grand").alias("least")
        )
        hooks = lifted.select("node", "parent").join(nearby, F.col("node") == F.col("a")).select("node", "parent", "least")
        offers = (
            lifted.select("node", "grand")
            .union(hooks.select("node", "least"))
            .union(hooks.select("parent", "least"))
        )
        parents = stage(offers.groupBy("node").agg(F.min("grand").alias("parent")), "parents")
        now = _total(parents)
        if now == total:
            return parents.withColumnRenamed("parent", "component")
        total = now


def _total(parents: DataFrame):
    """Parents only ever become smaller, so an equal sum means that none has changed."""
    return parents.agg(F.sum(F.col("parent").cast("decimal(38,0)"))).head()[0]
