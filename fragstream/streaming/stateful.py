"""Operators over streams of members: each once, the latest by entity, in order batch by batch, buffered up to a marker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import ordering, versions
from ..shared import checkpoint, delete_path, file_system
from ..shipping import ship

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once(stream: DataFrame, member: str = "member_id", within: tuple[str, str] | None = None) -> DataFrame:
    """Each member once, across polls and restarts. ``within`` (time column, delay) bounds the state, but may let very late repeats through."""
    if within:
        return stream.withWatermark(*within).dropDuplicatesWithinWatermark([member])
    return stream.dropDuplicates([member])


class _Newest(StatefulProcessor):
    """Keeps the newest time of an entity; lets rows through that are no older."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        known = self.newest.get()
        top = known[0] if known is not None else None
        # the newest of a batch come first, so that older ones of the same batch are dropped
        got = pd.concat(list(rows)).sort_values("at_micros", ascending=False, kind="stable")
        best = max(int(got["at_micros"].iloc[0]), top if top is not None else int(got["at_micros"].iloc[0]))
        self.newest.update((best,))
        yield got[got["at_micros"] >= best]

    def close(self) -> None:
        pass


def latest_versions(stream: DataFrame, entity: str = "is_version_of", timestamp: str = "timestamp") -> DataFrame:
    """Members no older than the newest of their entity so far; ties pass, and so does what has no entity or time.

    One number of state by entity. Needs the RocksDB state store.
    """
    ship(stream.sparkSession)
    at = F.unix_micros(F.col(timestamp).cast("timestamp"))
    known = F.col(entity).isNotNull() & F.col(timestamp).isNotNull()
    keyed = stream.where(known).withColumn("at_micros", at)
    newest = keyed.groupBy(entity).transformWithStateInPandas(_Newest(), keyed.schema, "Append", "None")
    return newest.drop("at_micros").unionByName(stream.where(~known))


def in_order(stream: DataFrame, sink: Callable[[DataFrame, int], None], how: str = "ascending", last_version_only: bool = False):
    """A writer that emits each micro-batch sorted; what arrives late comes with a later batch and is never dropped."""

    def each(batch: DataFrame, number: int) -> None:
        if last_version_only:
            batch = versions.last_version_only(batch)
        sink(ordering.ordered(batch, how), number)

    return stream.writeStream.foreachBatch(each)


class MarkerBuffer:
    """Members that a page still to come may precede, kept as Parquet between batches.

    The marker is the most conservative bound of the links not yet fetched: what
    lies strictly inside is emitted in order, the rest waits. Each batch writes a
    new version of the buffer before the old one is dropped; a batch that is
    repeated after a failure starts from the version it started from.
    """

    def __init__(self, spark: SparkSession, path: str, descending: bool = False, timestamp: str = "timestamp", member: str = "member_id"):
        self.spark, self.path, self.descending, self.timestamp, self.member = spark, path.rstrip("/"), descending, timestamp, member

    def _versions(self) -> list[int]:
        fs, make = file_system(self.spark, self.path)
        if not fs.exists(make(self.path)):
            return []
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(make(self.path)) if fs.exists(make(f"{s.getPath()}/_SUCCESS")))

    def push(self, batch: DataFrame, number: int, marker=None) -> DataFrame:
        """The members to emit now, in order; without a marker all that wait."""
        before = [v for v in self._versions() if v < number]
        held = batch
        if before:
            held = self.spark.read.schema(batch.schema).parquet(f"{self.path}/v{before[-1]}").unionByName(batch)
        held = checkpoint(held)
        limit = F.lit(marker).cast(batch.schema[self.timestamp].dataType)
        out = ordering.inside_marker(held, limit, self.timestamp, self.descending)
        rest = held.join(out.select(F.col(self.member).alias("__m")), F.col(self.member) == F.col("__m"), "left_anti")
        rest.write.mode("overwrite").parquet(f"{self.path}/v{number}")
        for v in before[:-1]:
            delete_path(self.spark, f"{self.path}/v{v}")
        return ordering.ordered(out, "descending" if self.descending else "ascending", self.timestamp, self.member)
