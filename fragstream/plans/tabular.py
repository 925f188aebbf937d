"""Tables as streams: which columns are the member, its time, its entity and its type; and the fragments a calendar makes of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..functions import terms as V
from ..operators import relations
from ..operators.conditions import Leaf, over_columns

TIME = paths.iri("urn:time")


@dataclass(frozen=True)
class Table:
    """A table read as members. Columns that the envelope does not name are the payload."""

    name: str
    member: str
    timestamp: str
    entity: str
    type: str | None = None

    def raw(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{self.name}.parquet")

    def members(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The envelope (member_id, timestamp, is_version_of, type) before the payload; the scan reads what is used."""
        df = self.raw(spark, sf_dir)
        names = {self.member: "member_id", self.timestamp: "timestamp", self.entity: "is_version_of"} | ({self.type: "type"} if self.type else {})
        return df.withColumnsRenamed(names)

    def resolve(self, **payload: str):
        """Resolves paths by column name, and the timestamp path."""
        known = {"urn:time": "timestamp", "type": "type"} | payload
        return over_columns(known)


EVENTS = Table("events", "event_id", "ts", "user_id", "event_type")
ORDERS = Table("orders", "o_orderkey", "o_orderdate", "o_custkey")


def leaf(column: str, kind: str, value: object, domain: str = "string", **zone) -> Leaf:
    """A comparison on a column."""
    return Leaf(paths.iri(column), kind, str(value), domain, **zone)


def calendar_links(members: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """The links from a root to a page a day: at or after its midnight, and before the next."""
    days = members.select(F.to_date(timestamp).alias("page")).distinct()
    midnight = lambda d: F.date_format(d, "yyyy-MM-dd'T'00:00:00'Z'")
    sides = F.explode(F.array(F.struct(F.lit(V.GREATER_EQUAL).alias("type"), midnight(F.col("page")).alias("value")), F.struct(F.lit(V.LESS).alias("type"), midnight(F.date_add("page", 1)).alias("value"))))
    links = days.select(F.lit("root").alias("source"), F.col("page").cast("string").alias("node"), F.lit(str(TIME)).alias("path"), sides.alias("side"), F.lit(V.XSD + "dateTime").alias("datatype"))
    return links.select("source", "node", "side.type", "path", "side.value", "datatype")


def calendar_ranges(members: DataFrame) -> DataFrame:
    """The merged range of each day's page."""
    return relations.merged(relations.bounds_of(calendar_links(members)))
