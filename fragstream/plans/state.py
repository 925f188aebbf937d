"""What a replication remembers between runs, as Parquet tables: the condition, pages, emitted members, latest versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import delete_path, file_system


def settled(pages: DataFrame) -> DataFrame:
    """(page_url) of pages that never change: a page once immutable stays so."""
    return pages.where("immutable").select("page_url").distinct()


def changing(pages: DataFrame) -> DataFrame:
    """(page_url) of known pages that may change."""
    return pages.groupBy("page_url").agg(F.bool_or("immutable").alias("i")).where("not i").select("page_url")


class DifferentConditions(ValueError):
    """The saved state belongs to another condition."""


class State:
    """Tables under a path: the condition, pages, members that passed, the newest time of each entity, and the crawl that is under way.

    Members go to the sink first, then to ``emitted`` and ``latest``, then their
    pages to ``pages``, and then the crawl is forgotten. After a crash in between,
    the crawl goes on with the pages it has, and members that are not in
    ``emitted`` are emitted again.
    """

    TABLES = {"condition": "fingerprint string", "pages": "page_url string, immutable boolean", "emitted": "member_id string", "latest": "entity string, timestamp timestamp_ntz"}

    def __init__(self, spark: SparkSession, path: str, fresh: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        if fresh:
            delete_path(spark, self.path)

    def read(self, table: str) -> DataFrame:
        fs, make = file_system(self.spark, self.path)
        where = f"{self.path}/{table}"
        if not fs.exists(make(where)):
            return self.spark.createDataFrame([], self.TABLES[table])
        return self.spark.read.schema(self.TABLES[table]).parquet(where)

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{table}")

    def check(self, fingerprint: str) -> None:
        """Remembers the condition, or raises if a different one is remembered."""
        known = self.read("condition").first()
        if known is None:
            self.append("condition", self.spark.createDataFrame([(fingerprint,)], self.TABLES["condition"]))
        elif known[0] != fingerprint:
            raise DifferentConditions(f"Different conditions: the state was saved for {known[0]}, now it is {fingerprint}")

    def immutable(self) -> DataFrame:
        return settled(self.read("pages"))

    def mutable(self) -> DataFrame:
        return changing(self.read("pages"))

    def emitted(self) -> DataFrame:
        return self.read("emitted")

    def latest(self) -> DataFrame:
        """(entity, timestamp): the newest time of each entity in all polls and runs so far."""
        return self.read("latest").groupBy("entity").agg(F.max("timestamp").alias("timestamp"))

    @property
    def crawl(self) -> str:
        """The folder of the crawl under way."""
        return f"{self.path}/crawl"

    def crawled(self) -> None:
        """Forgets the crawl: its members are emitted and its pages known."""
        delete_path(self.spark, self.crawl)
