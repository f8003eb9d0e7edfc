"""Connected components of a link table, by alternating large-star and small-star steps.

The smallest neighbour of every node is an aggregate; it is written as a table
before the links are joined with it. The join then has two plain sides, so
adaptive execution may split the links of a node that has very many (the centre
of a large star), which it may not do beside an aggregate on the join's own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.llm.common import written


def _least_of(rows: DataFrame) -> DataFrame:
    """(u, m): the smallest v of every u, as a table."""
    return written(rows.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = _least_of(both).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _least_of(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node that is not the smallest of its component.

    ``links`` has two columns of one orderable type. Every step is written to
    the shared folder; rounds end when the links are stars that no step moves.
    """
    links = written(links.toDF("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        stars = written(_large_star(links).distinct(), "large-stars")
        links = written(_small_star(stars).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == state:
            return links.toDF("node", "root")
        state = tuple(now)
