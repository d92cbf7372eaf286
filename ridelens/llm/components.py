"""Union-find grouping of links as Spark joins.

Alternates two contractions until nothing changes: every node passes the
smallest id it can see to its larger neighbours, then to itself and its smaller
ones. Each round works on the links alone (never on pairs within a group) and
is written to the shared folder, so a lost executor costs one round at most.
A hub's links are reduced by a partial ``min`` and read back by a join that
Spark can split, so no task holds a whole hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.runtime import settle


def _pull_minimum(links: DataFrame, both_ways: bool) -> DataFrame:
    """One contraction of (big, small) links, with big > small throughout.

    ``both_ways``: a node's neighbourhood is all its links (the larger
    neighbours move to the minimum); else its smaller ones (they and the node
    itself move)."""
    down = links.select(F.col("big").alias("node"), F.col("small").alias("other"))
    near = down.unionByName(links.select(F.col("small").alias("node"), F.col("big").alias("other"))) if both_ways else down
    lowest = near.groupBy("node").agg(F.min("other").alias("low")).withColumn("low", F.least("low", "node"))
    moved = near.join(lowest, "node")
    if both_ways:
        out = moved.where("other > node").select(F.col("other").alias("big"), F.col("low").alias("small"))
    else:
        out = moved.where("other <> low").select(F.col("other").alias("big"), F.col("low").alias("small"))
        out = out.unionByName(lowest.where("node <> low").select(F.col("node").alias("big"), F.col("low").alias("small")))
    return out.where("big <> small").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum(F.pmod(F.xxhash64("big", "small"), F.lit(1 << 40))),
            F.sum(F.pmod(F.xxhash64("small", "big"), F.lit((1 << 40) - 87))),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b), component
    being the smallest node reachable. Nodes without links are absent; links
    with a null end or to the node itself are ignored."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct()
    links = settle(links, "links")
    before = _state(links)
    while before[0]:
        links = settle(_pull_minimum(_pull_minimum(links, True), False), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    star = links.select(F.col("big").alias("node"), F.col("small").alias("component"))
    roots = star.select(F.col("component").alias("node"), "component").distinct()
    return star.unionByName(roots)
