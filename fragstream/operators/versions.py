"""Versions of entities: latest only, latest so far, and members renamed to their entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import terms as V


def last_version_only(members: DataFrame, entity: str = "is_version_of", timestamp: str = "timestamp") -> DataFrame:
    """Members no older than the newest of their entity; ties stay, and so does what has no entity or time.

    The newest time by entity is a map-side combined aggregate; the join back
    lets the engine broadcast it or split a hot entity, which a window can't.
    """
    keep = members.columns
    known = F.col(entity).isNotNull() & F.col(timestamp).isNotNull()
    newest = members.where(known).groupBy(F.col(entity).alias("__e")).agg(F.max(timestamp).alias("__t"))
    out = members.join(newest, F.col(entity) == F.col("__e"), "left")
    return out.where(~known | (F.col(timestamp) >= F.col("__t"))).select(*keep)


def not_older(members: DataFrame, newest: DataFrame, entity: str = "is_version_of", timestamp: str = "timestamp") -> DataFrame:
    """Members no older than the newest time (entity, timestamp) remembered for their entity; what has no entity or time stays."""
    keep = members.columns
    out = members.join(newest.select(F.col("entity").alias("__e"), F.col("timestamp").alias("__t")), F.col(entity) == F.col("__e"), "left")
    return out.where(F.coalesce(F.col(timestamp) >= F.col("__t"), F.lit(True))).select(*keep)


def newest(members: DataFrame, entity: str = "is_version_of", timestamp: str = "timestamp") -> DataFrame:
    """(entity, timestamp): the newest time of each entity."""
    known = F.col(entity).isNotNull() & F.col(timestamp).isNotNull()
    return members.where(known).groupBy(F.col(entity).alias("entity")).agg(F.max(timestamp).alias("timestamp"))


def latest_in_arrival_order(members: DataFrame, *arrival: Column | str, entity: str = "is_version_of", timestamp: str = "timestamp") -> DataFrame:
    """What a reader that emits at once lets through: members no older than any of their entity that arrived before.

    Members without an entity all pass, and are dealt to no one task.
    """
    so_far = F.max(timestamp).over(Window.partitionBy(entity).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keep = members.columns
    known = members.where(F.col(entity).isNotNull()).withColumn("__max", so_far).where(F.coalesce(F.col(timestamp) >= F.col("__max"), F.lit(True))).select(*keep)
    return known.unionByName(members.where(F.col(entity).isNull()))


def materialize_ids(members: DataFrame, entity: str = "is_version_of", member: str = "member_id") -> DataFrame:
    """Members named after their entity; those without one keep their name."""
    return members.withColumn(member, F.coalesce(F.col(entity), F.col(member)))


def materialize(members: DataFrame, version_path: str) -> DataFrame:
    """Whole members named after their entity: the version link goes and subjects are rewritten; objects stay."""
    known = F.col("is_version_of").isNotNull()
    mine = lambda t: (t["type"] == V.IRI) & (t["value"] == F.col("member_id"))
    kept = F.filter("quads", lambda q: ~((q["p"] == version_path) & mine(q["s"])))
    renamed = F.transform(kept, lambda q: F.when(mine(q["s"]), q.withField("s", q["s"].withField("value", F.col("is_version_of")))).otherwise(q))
    return members.withColumn("quads", F.when(known, renamed).otherwise(F.col("quads"))).withColumn("member_id", F.coalesce("is_version_of", "member_id"))
