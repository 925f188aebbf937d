"""Order, emission sequences and distinctness of members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import checkpoint


def ordered(members: DataFrame, how: str = "ascending", timestamp: str = "timestamp", member: str = "member_id") -> DataFrame:
    """Members by time, ties by id: a range-partitioned sort."""
    if how not in ("ascending", "descending"):
        raise ValueError(f"an order is ascending or descending, not {how!r}")
    return members.orderBy(F.desc(timestamp) if how == "descending" else F.asc(timestamp), member)


def sequence(rows: DataFrame, *order: Column | str, name: str) -> DataFrame:
    """Adds the place of each row in an order, from 1.

    One range-partitioned sort; each row's number within its partition comes
    with it, and the counts of the partitions before (one number a partition)
    are added. The sorted rows are checkpointed in between: a second evaluation
    might draw other range bounds.
    """
    sorted_ = checkpoint(rows.orderBy(*order).withColumn("__row", F.monotonically_increasing_id()))
    part, row = F.shiftright("__row", 33), F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted_.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    out = sorted_.withColumn("__p", part).join(F.broadcast(starts), F.col("__p") == F.col("__part"))
    return out.withColumn(name, F.col("__start") + row + 1).drop("__row", "__p", "__part", "__start")


def numbered(members: DataFrame, how: str = "ascending", timestamp: str = "timestamp", member: str = "member_id", name: str = "emit_seq") -> DataFrame:
    """Adds the place of each member in the order of emission, from 1."""
    return sequence(members, F.desc(timestamp) if how == "descending" else F.asc(timestamp), member, name=name)


def distinct_members(members: DataFrame, member: str = "member_id") -> DataFrame:
    """One row a member id, whichever page it was on."""
    return members.dropDuplicates([member])


def not_emitted(members: DataFrame, emitted: DataFrame, member: str = "member_id") -> DataFrame:
    """Members whose id is not among those emitted before."""
    return members.join(emitted.select(F.col(member).alias("__m")), F.col(member) == F.col("__m"), "left_anti")


def inside_marker(members: DataFrame, marker: DataFrame | Column, timestamp: str = "timestamp", descending: bool = False) -> DataFrame:
    """Members strictly inside the marker, which no page still to come can hold anything before.

    A DataFrame marker has one row and one column; none, or a null one, means
    that no page is pending and all members may go.
    """
    keep = members.columns
    if isinstance(marker, DataFrame):
        members = members.join(F.broadcast(marker.select(F.col(marker.columns[0]).alias("__marker")).limit(1)), how="left")
        marker = F.col("__marker")
    inside = F.col(timestamp) > marker if descending else F.col(timestamp) < marker
    return members.where(F.coalesce(inside, marker.isNull())).select(*keep)
