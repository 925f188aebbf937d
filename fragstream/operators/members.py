"""Members: listed on pages, assembled from quads, and given their envelope."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths, scalars
from ..functions import terms as V
from ..shared import checkpoint


def listed(quads: DataFrame, stream: str | None = None) -> DataFrame:
    """(page_url, member_id): objects of tree:member, of one stream or, without one, of any subject."""
    rows = quads.where((F.col("p") == V.TREE + "member") & (F.col("s.value") == stream if stream else F.lit(True)))
    return rows.select("page_url", F.col("o.value").alias("member_id")).distinct()


def statements(rows: DataFrame, columns: Mapping[str, Column], member: str = "member_id") -> DataFrame:
    """(s, p, o): a row for each member and predicate, in one pass over the table."""
    each = F.array(*(F.struct(F.lit(p).alias("p"), c.alias("o")) for p, c in columns.items()))
    return rows.select(F.col(member).alias("s"), F.explode(each).alias("q")).select("s", "q.p", "q.o")


def page_statistics(members: DataFrame, page: str = "page_url", timestamp: str = "timestamp") -> DataFrame:
    """By page: how many members, and their first and last time."""
    return members.groupBy(page).agg(F.count("*").alias("member_count"), F.min(timestamp).alias("first_ts"), F.max(timestamp).alias("last_ts"))


def page_metadata(quads: DataFrame) -> DataFrame:
    """(page_url, created, updated, member_count) from what pages say about themselves."""
    own = (F.col("s.value") == F.col("page_url")) & (F.col("g.type") == V.DEFAULT)
    when = lambda p: F.min(F.when(own & (F.col("p") == V.DCT + p), scalars.instant(F.col("o.value"))))
    n = F.sum((F.col("p") == V.TREE + "member").cast("long"))
    return quads.groupBy("page_url").agg(when("created").alias("created"), when("modified").alias("updated"), n.alias("member_count"))


def described(quads: DataFrame, members: DataFrame, shape_paths: tuple[str, ...] = (), only_default_graph: bool = False, nested: bool = True) -> DataFrame:
    """(page_url, member_id, quads): the quads that belong to each member.

    A member owns the quads of its named graph, those it is the subject of and,
    step by step, those of the blank nodes they lead to and of the objects of
    ``shape_paths``. Other members, and graphs of ingestion metadata, are borders.
    Each hop joins the frontier of owned subjects, by page, with the page's quads;
    it ends with the first that reaches no new subject.
    """
    q = quads.where(F.col("g.value") != V.INGESTION)
    if only_default_graph:
        q = q.where(F.col("g.type") == V.DEFAULT)
    q = q.withColumn("quad", F.struct("s", "p", "o", "g"))
    border = members.select(F.col("page_url").alias("__bp"), F.col("member_id").alias("__b")).distinct()
    owned = members.select("page_url", "member_id", F.lit(V.IRI).alias("t"), F.col("member_id").alias("v")).distinct()
    right = q.select(F.col("page_url").alias("__p"), F.col("s.type").alias("__t"), F.col("s.value").alias("__v"), "quad")
    same = (F.col("page_url") == F.col("__p")) & (F.col("t") == F.col("__t")) & (F.col("v") == F.col("__v"))
    found, frontier = None, owned
    while True:
        got = frontier.join(right, same).select("page_url", "member_id", "quad")
        found = got if found is None else found.unionByName(got)
        if not nested:
            break
        follows = F.col("quad.o.type") == V.BLANK
        if shape_paths:
            follows = follows | ((F.col("quad.o.type") == V.IRI) & F.col("quad.p").isin(list(shape_paths)))
        ahead = got.where(follows).select("page_url", "member_id", F.col("quad.o.type").alias("t"), F.col("quad.o.value").alias("v")).distinct()
        ahead = ahead.join(border, (F.col("page_url") == F.col("__bp")) & (F.col("v") == F.col("__b")), "left_anti")
        known = owned.withColumnsRenamed({"page_url": "__p", "member_id": "__m", "t": "__t", "v": "__v"})
        # most members end after a hop or two: look, instead of planning hops that find nothing
        frontier = checkpoint(ahead.join(known, same & (F.col("member_id") == F.col("__m")), "left_anti"))
        if frontier.isEmpty():
            break
        owned = owned.unionByName(frontier)
    if not only_default_graph:
        graph = q.select(F.col("page_url").alias("__p"), F.col("g.value").alias("__g"), "quad")
        found = found.unionByName(members.select("page_url", "member_id").join(graph, (F.col("page_url") == F.col("__p")) & (F.col("member_id") == F.col("__g"))).select("page_url", "member_id", "quad"))
    return found.groupBy("page_url", "member_id").agg(F.collect_set("quad").alias("quads"))


def enveloped(members: DataFrame, timestamp: paths.Path | None, version_of: paths.Path | None, created: DataFrame | None = None) -> DataFrame:
    """Adds timestamp, is_version_of, type and created to members with their quads: the first value of each path."""
    start = F.struct(F.lit(V.IRI).alias("type"), F.col("member_id").alias("value"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    first = lambda p: F.get(paths.values(p, F.col("quads"), start), F.lit(0))["value"] if p else F.lit(None).cast("string")
    out = members.withColumns({"timestamp": scalars.instant(first(timestamp)), "is_version_of": first(version_of), "type": first(paths.iri(V.TYPE))})
    if created is None:
        return out.withColumn("created", F.lit(None).cast("timestamp_ntz"))
    return out.join(created, ["page_url", "member_id"], "left")


def ingested(quads: DataFrame) -> DataFrame:
    """(page_url, member_id, created) from graphs of ingestion metadata."""
    rows = quads.where((F.col("g.value") == V.INGESTION) & (F.col("p") == V.DCT + "created"))
    return rows.groupBy("page_url", F.col("s.value").alias("member_id")).agg(F.min(scalars.instant(F.col("o.value"))).alias("created"))
