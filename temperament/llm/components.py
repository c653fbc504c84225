"""Connected components of a link table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.llm.scratch import in_pieces
from temperament.session import settle


def _hooked(links: DataFrame, both: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest node among them and itself.

    With `both`, only larger neighbours move (the node's own star); without, only smaller ones and the node.
    """
    near = links
    if both:
        near = links.union(links.select(F.col("two").alias("one"), F.col("one").alias("two")))
    else:
        near = links.select(F.greatest("one", "two").alias("one"), F.least("one", "two").alias("two"))
    least = near.groupBy("one").agg(F.least(F.min("two"), F.col("one")).alias("least"))
    tied = near.join(least, "one")
    if both:
        moved = tied.where(F.col("two") > F.col("one")).select("two", "least")
    else:
        moved = tied.select("two", "least").union(least.select(F.col("one").alias("two"), "least"))
    moved = moved.where(F.col("two") != F.col("least"))
    return moved.select(F.col("two").alias("one"), F.col("least").alias("two")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (one, two); the component is its smallest node.

    Alternates two star operations until nothing changes; their number grows with the logarithm of the
    longest chain. Every round writes its table to the shared folder. Links from a node to itself keep that node.
    """
    alone = links.where(F.col("one") == F.col("two")).select(F.col("one").alias("node"))
    edges = links.where(F.col("one") != F.col("two")).select("one", "two").distinct()
    before, rows = None, links.count()
    while True:
        edges = settle(in_pieces(_hooked(_hooked(edges, True), False), 2 * rows, 64), "components")
        state = tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("one", "two"))).first())
        if state == before:
            break
        before, rows = state, state[0]
    roots = edges.select(F.col("two").alias("node")).union(alone).distinct()
    roots = roots.join(edges.select(F.col("one").alias("node")), "node", "left_anti")
    return edges.select(F.col("one").alias("node"), F.col("two").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
