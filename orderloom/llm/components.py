"""Connected components of a link table, by alternating large-star and small-star rounds.

Both stars keep connectivity and never make more links than there were. A hub's links are held by the row that names them: each
round groups by one end with a minimum only, so no node's neighbours are ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a long, b long): root is the smallest node that it is connected to.

    A node without links is in no row. Each round is stored in the shared folder; rounds grow with the logarithm of the
    longest chain.
    """
    current = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                     "links")
    while True:
        rows = current.agg(F.count("*"), F.sum(F.hash("a", "b"))).first()
        if not rows[0]:
            break
        following = stored(
            _small_star(_large_star(current)).filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        after = following.agg(F.count("*"), F.sum(F.hash("a", "b"))).first()
        current = following
        if tuple(after) == tuple(rows):
            break
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
