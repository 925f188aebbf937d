"""Where members go: text, envelopes of a pipeline's stream, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rdf
from ..functions import terms as V


def envelope_rows(members: DataFrame, stream: str, graph: str = V.DESCRIPTION_GRAPH) -> DataFrame:
    """(payload, stream, graph): which stream a member belongs to, a row a member."""
    return members.select(F.col("member_id").alias("payload"), F.lit(stream).alias("stream"), F.lit(graph).alias("graph"))


def enveloped(members: DataFrame, stream: str) -> DataFrame:
    """Members with two more quads, in the description graph: a blank node with their stream and their payload."""
    none = F.lit(None).cast("string")
    iri = lambda c: F.struct(F.lit(V.IRI).alias("type"), c.alias("value"), none.alias("datatype"), none.alias("lang"))
    node = F.struct(F.lit(V.BLANK).alias("type"), F.concat(F.lit("sds"), F.md5(F.col("member_id").cast("binary"))).alias("value"), none.alias("datatype"), none.alias("lang"))
    quad = lambda p, o: F.struct(node.alias("s"), F.lit(p).alias("p"), o.alias("o"), iri(F.lit(V.DESCRIPTION_GRAPH)).alias("g"))
    return members.withColumn("quads", F.concat("quads", F.array(quad(V.SDS + "stream", iri(F.lit(stream))), quad(V.SDS + "payload", iri(F.col("member_id"))))))


def text(members: DataFrame) -> DataFrame:
    """One row of N-Quads text a member."""
    return members.select(rdf.nquads(F.col("quads")).alias("value"))


def write_text(members: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Members as text files."""
    text(members).write.mode(mode).text(path)


def write_members(members: DataFrame, path: str, mode: str = "append") -> None:
    """Members as Parquet, nested as they are."""
    members.write.mode(mode).parquet(path)
