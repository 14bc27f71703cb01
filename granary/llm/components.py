"""Connected components of a table of links, by alternating large-star and small-star steps.

Every round is two groupings over the links; the links of a round are written to the shared
folder, so that no plan grows and a lost executor costs one stage. A vertex with very many
neighbours is not gathered anywhere: the smallest neighbour is an aggregate, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node reachable.

    Null ends are left out; repeated links, links in either direction and links of a node to
    itself make no difference; a table without links gives no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    stars = durable(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    while True:
        larger = _large_star(stars)
        after = durable(_small_star(larger))
        if not after.exceptAll(stars).take(1) and after.count() == stars.count():
            break
        stars = after
    nodes = stars.select(F.col("high").alias("node"), F.col("low").alias("root"))
    alone = stars.select(F.col("low").alias("node"), F.col("low").alias("root"))
    return nodes.where("node <> root").unionByName(alone).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = links.union(links.select("low", "high")).toDF("node", "other").distinct()
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    moved = both.where("other > node").join(least, "node")
    return moved.select(F.col("other").alias("high"), F.col("least").alias("low"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    links = links.where("high <> low").distinct()
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(least, "high").where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    own = least.select("high", F.col("least").alias("low"))
    return moved.union(own).distinct()
