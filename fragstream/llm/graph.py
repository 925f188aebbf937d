"""Connected components of an edge list as a few shuffles over the edges; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: A node with more edges than this, and than a HUBS-th of all, is a hub: there are at most 2 * HUBS of them, whose rows (16 bytes each) are broadcast.
EDGES, HUBS = 64, 2000


def nearest(e: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(rows (a, b) with the smallest b of their a as m; the distinct a as n with theirs). No task gets all rows of an a that has more than ``least``."""
    low = e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    hubs = low.where(F.col("degree") > least).select(F.col("n").alias("h"), F.col("m").alias("hm"))
    marked = e.join(F.broadcast(hubs), F.col("a") == F.col("h"), "left")
    rest = marked.where("h is null").select("a", "b").join(low.where(F.col("degree") <= least).select("n", "m"), F.col("a") == F.col("n")).select("a", "b", "m")
    return marked.where("h is not null").select("a", "b", F.col("hm").alias("m")).union(rest), low


def hub(rows: int) -> int:
    """From how many rows on a key is a hub, among so many rows."""
    return max(EDGES, rows // HUBS)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): for each end of an edge the smallest node it is connected with.

    ``edges`` has the long columns a and b. Alternates large-star and small-star
    (Kiveris et al., 2014) until the edges stay the same: every node then hangs
    on the smallest of its component. Both steps are a map-side combinable min by
    node and a join back, in which no task gets all edges of a hub: those stay
    where they are and meet the hubs' own few rows.
    An empty list gives an empty result; loops and null ends are left out.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(e: DataFrame, least: int) -> DataFrame:
        got, _ = nearest(both(e), least)
        return got.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))

    def small(e: DataFrame, least: int) -> DataFrame:
        got, low = nearest(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), least)
        return got.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()

    now = scratch.table(edges.select("a", "b").where("a <> b").distinct(), f"{name}0")
    seen, turn = (now.count(), None), 0
    while seen[0]:
        least = hub(seen[0])
        # small-star reads its input twice: it is written, so that large-star is not done twice
        middle = scratch.table(large(now, least), f"{name}l{turn}")
        now = scratch.table(small(middle, least), f"{name}{turn + 1}")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        scratch.drop(f"{name}{turn}")
        scratch.drop(f"{name}l{turn}")
        if mark == seen:
            break
        seen, turn = mark, turn + 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
