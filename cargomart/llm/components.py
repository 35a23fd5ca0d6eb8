"""Connected components of a graph of links, by alternating stars.

Each round links every node's larger neighbours to its smallest one (large
star) and then its smaller neighbours among themselves (small star); a graph
of n nodes is a forest of stars after about log n rounds.  A node's smallest
neighbour is an aggregate that combines before the shuffle, so a node with a
third of all links is no group that one task holds.  Each round is written to
the shared folder; only its number of links and a checksum come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has a row (u, v) with u > v for each link."""
    if large:
        around = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        joined = links.join(least, "u")
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links between long ids, in any direction, repeats and loops
    allowed, to (node, root): each linked node and the smallest of its
    component.  Nulls are no links.  No links: an empty result."""
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    now, before = written(now, "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = written(_star(_star(now, large=True), large=False), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
