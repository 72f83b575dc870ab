"""Connected components of a link table, by alternating star contraction.

Each round points every node's larger neighbours, then its smaller ones, at the smallest node known
around it. A round is two grouped minima (reduced before the shuffle) and two joins; the number of
links never grows, and the rounds end when the link table no longer changes: every node then links
to the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import cut


def _smallest(links: DataFrame) -> DataFrame:
    """``u`` with the smallest of itself and its neighbours ``v``."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_smallest(both), "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return moved.union(own).filter("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def components(links: DataFrame) -> DataFrame:
    """(u, v) links, any order, repeats allowed -> (node, root), root = smallest node reachable.

    Nodes without links do not appear. NULL ends are dropped. An empty table gives an empty table.
    The driver sees one count and one checksum per round.
    """
    now = cut(links.select("u", "v").filter("u != v").distinct(), "links")
    before, state = None, _state(now)
    while state != before and state[0]:
        now = cut(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
