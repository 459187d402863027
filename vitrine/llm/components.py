"""Connected components as Spark jobs (alternating large-star and small-star).

Both steps replace every link by links to the smallest neighbour, which keeps
the components and shortens the paths; the rounds end when a step of each kind
changes nothing. A step is an aggregate and a join, so a hub's links are
pre-aggregated and split, never gathered in one task. Each round is written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """edges (u, v) with u > v. Large star: every larger neighbour of a node is
    linked to the smallest of the node and its neighbours. Small star: the
    node and its smaller neighbours are linked to the smallest of these. The
    minima are stored, so that both join sides are plain shuffles, which Spark
    can split where a hub is hot."""
    if small:
        low = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")
        linked = edges.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    else:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        # The larger neighbours of a node are the u of the links that have it as v.
        larger = edges.select(F.col("u").alias("x"), F.col("v").alias("u"))
        linked = larger.join(low, "u").select(F.col("x").alias("u"), F.col("m").alias("v"))
    return linked.filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; component is the
    smallest node reachable. ``edges`` (a, b) of any orderable type; links of a
    node to itself and repeated links do no harm."""
    links = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stored(links, "links")
    before = _state(links)
    while True:
        links = stored(_star(links, small=False), "stars")
        links = stored(_star(links, small=True), "stars")
        after = _state(links)
        if after == before:
            break
        before = after
    # Stars now: every node but the centre links to the centre.
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
