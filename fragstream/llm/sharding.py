"""Sharding by size-tiered compaction: arrivals are small immutable shards, similar ones are merged, a manifest names what is current.

No step shuffles a document: arrivals are written as they are partitioned, in
files well below the target size however large a partition is, and a merge reads
the shards of one group in one task. A shard that is above the target all the
same is cut; only a single row can be larger. Readers see the files of one
manifest version, whole. A bulk load arrives in instalments: it is written once,
its small files become arrivals one after the other, and each is compacted before
the next.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, checkpoint, delete_path, file_system, row_bytes, sent
from .manifest import Manifests

TARGET_BYTES, FLOOR_BYTES, FAN_IN = 32 << 20, 1 << 18, 4
#: Groups merged by one Spark job, each in a task of its own, and made current by one version.
GROUPS_A_JOB = 1024
#: Instalments of a bulk load, each of ``FAN_IN`` files at least.
ARRIVALS = 4
#: Files that no kept version names stay for so long, as a writer may be about to name them.
GRACE_S = 7 * 86400
#: From Spark 4.1 on, a union of single partitions is a single partition where this is true.
UNION = "spark.sql.unionOutputPartitioning"


@dataclass(frozen=True)
class Shard:
    """A file of the store, relative to it, and its size on disk."""

    path: str
    bytes: int


def tier(size: int, floor: int = FLOOR_BYTES, fan_in: int = FAN_IN) -> int:
    """Sizes of one tier are within a factor of ``fan_in``; all up to ``floor`` are of tier 0."""
    return max(0, math.floor(math.log(max(size, 1) / floor, fan_in)) + 1) if size > floor else 0


def plan_merges(shards: list[Shard], target: int = TARGET_BYTES, floor: int = FLOOR_BYTES, fan_in: int = FAN_IN, finish: bool = False) -> list[list[Shard]]:
    """Groups to merge now: runs of one tier, at least ``fan_in`` of them, packed up to the target size.

    Shards of more than half the target are done. ``finish`` also merges what no
    tier has enough of, across tiers.
    """
    open_ = [s for s in shards if s.bytes <= target / 2]
    tiers: dict[int, list[Shard]] = {}
    for s in sorted(open_, key=lambda s: s.bytes):  # of equal ones the older first, so that reruns agree
        tiers.setdefault(-1 if finish else tier(s.bytes, floor, fan_in), []).append(s)
    groups = []
    for _, run in sorted(tiers.items()):
        if len(run) < (2 if finish else fan_in):
            continue
        group: list[Shard] = []
        for s in run:
            if group and sum(x.bytes for x in group) + s.bytes > target:
                groups.append(group)
                group = []
            group.append(s)
        groups.append(group)
    return [g for g in groups if len(g) > 1]


def _file() -> Column:
    """The path of a row's shard, relative to the store."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1)


class ShardStore:
    """A folder of shards under versioned manifests."""

    def __init__(self, spark: SparkSession, path: str, target: int = TARGET_BYTES, floor: int = FLOOR_BYTES, fan_in: int = FAN_IN, private: bool = False):
        self.spark, self.path, self.target, self.floor, self.fan_in = spark, path.rstrip("/"), target, floor, fan_in
        self.log = Manifests(spark, f"{self.path}/manifests", private)

    def shards(self, version: int | None = None) -> list[Shard]:
        now = self.log.latest()[1] if version is None else self.log.read(version)
        return [Shard(p, n) for p, n in now.get("shards", [])]

    def _written(self, df: DataFrame, rows: int = 0) -> list[Shard]:
        """Writes a DataFrame, a file for each of its partitions, or for each ``rows`` rows of one."""
        name = f"data-{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", rows).parquet(f"{self.path}/{name}")
        fs, make = file_system(self.spark, self.path)
        found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(make(f"{self.path}/{name}"))]
        return [Shard(f"{name}/{f}", n) for f, n in sorted(found) if f.startswith("part-")]

    def _commit(self, add: list[Shard], remove: list[Shard], schema: T.StructType) -> int:
        """Adds and removes shards in one version, whatever others commit meanwhile; what replaces shards that another writer has replaced is dropped again."""
        gone = {s.path for s in remove}

        def change(_: int, now: dict) -> dict | None:
            held = now.get("shards", [])
            if not gone <= {x[0] for x in held}:
                return None
            return {"shards": [*(x for x in held if x[0] not in gone), *([s.path, s.bytes] for s in add)], "schema": schema.jsonValue()}

        version, now = self.log.update(change)
        if gone and not {s.path for s in add} <= {x[0] for x in now["shards"]}:
            for folder in {s.path.split("/")[0] for s in add}:
                delete_path(self.spark, f"{self.path}/{folder}")
        return version

    def _arrived(self, docs: DataFrame, least_files: int = 1) -> list[Shard]:
        """Writes documents as small files: of a ``fan_in``-th of the target before compression at most, and ``least_files`` where there are the rows.

        One more scan of ``docs`` measures the bytes of a mean row.
        """
        n, size = docs.agg(F.count("*"), F.sum(row_bytes(docs.schema))).first()
        rows = max(1, min(self.target // self.fan_in * n // max(size, 1), n // least_files)) if n else 0
        return self._written(docs, rows)

    def append(self, docs: DataFrame) -> int:
        """Adds an arrival; the version that has it."""
        return self._commit(self._arrived(docs), [], docs.schema)

    def load(self, docs: DataFrame, arrivals: int = ARRIVALS) -> int:
        """Adds documents in instalments, each a version, and compacts after each; the last version."""
        files = self._arrived(docs, arrivals * self.fan_in)
        for i in range(arrivals):
            if i == 0 or files[i::arrivals]:
                self._commit(files[i::arrivals], [], docs.schema)
                self.compact()
        return self.compact(finish=True)

    def compact(self, finish: bool = False) -> int:
        """Cuts shards above the target and merges until no tier has enough similar shards; the last version."""
        before = math.inf
        while True:
            self._cut()
            shards = self.shards()
            groups = plan_merges(shards, self.target, self.floor, self.fan_in, finish)
            if not groups or len(shards) >= before:  # what takes more bytes when merged was cut again
                return self.log.latest()[0]
            before = len(shards)
            self._merge(groups[:GROUPS_A_JOB])

    def _cut(self) -> None:
        """Rewrites shards above the target, but for single rows, in files of some three quarters of it."""
        while large := {s.path: s for s in self.shards() if s.bytes > self.target}:
            schema = self._schema()
            read = lambda paths: self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in paths))
            classes: dict[int, dict[str, int]] = {}  # of similar rows a file, as one write has one number
            for path, n in read(large).groupBy(_file()).count().collect():
                if n > 1:
                    rows = math.ceil(n / math.ceil(large[path].bytes / (0.75 * self.target)))
                    classes.setdefault(rows.bit_length(), {})[path] = rows
            if not classes:
                return
            made = [s for c in classes.values() for s in self._written(read(c), min(c.values()))]
            self._commit(made, [large[p] for c in classes.values() for p in c], schema)

    def _merge(self, groups: list[list[Shard]]) -> None:
        schema = self._schema()
        parts = [self.spark.read.schema(schema).parquet(*(f"{self.path}/{s.path}" for s in g)).coalesce(1) for g in groups]
        all_ = parts[0]
        for p in parts[1:]:
            all_ = all_.union(p)
        conf, was = self.spark.conf, self.spark.conf.get(UNION, "true")
        conf.set(UNION, "false")  # so that the union keeps the partitions, one a group
        try:
            made = self._written(all_)
        finally:
            conf.set(UNION, was)
        self._commit(made, [s for g in groups for s in g], schema)

    def _schema(self) -> T.StructType:
        return T.StructType.fromJson(self.log.latest()[1]["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """All documents of a version, with ``_metadata`` as Spark's file sources have it."""
        now = self.log.latest()[1] if version is None else self.log.read(version)
        schema = T.StructType.fromJson(now["schema"])
        if not now["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p, _ in now["shards"]))

    def expire(self, versions: int = 1, grace_s: float = GRACE_S) -> None:
        """Forgets all but the newest versions, and deletes files of over ``grace_s`` seconds that none of the kept ones names."""
        kept = self.log.numbers()[-versions:]
        if not kept:
            return
        named = {s.path for v in kept for s in self.shards(v)}
        self.log.forget(kept[0])
        folders = {p.split("/")[0] for p in named}
        fs, make = file_system(self.spark, self.path)
        limit = (time.time() - grace_s) * 1000
        for d in fs.listStatus(make(self.path)):
            name = d.getPath().getName()
            if name.startswith("data-") and d.getModificationTime() <= limit:
                if name not in folders:
                    delete_path(self.spark, f"{self.path}/{name}")
                    continue
                for f in fs.listStatus(d.getPath()):
                    if f.getPath().getName().startswith("part-") and f"{name}/{f.getPath().getName()}" not in named:
                        fs.delete(f.getPath(), False)

    def numbered(self) -> DataFrame:
        """All documents with ``shard`` (a number from 0 in the order of the manifest) and ``shard_bytes``; columns of these names are replaced."""
        found = self.shards()
        docs = self.read()
        own = [c for c in docs.columns if c.lower() not in ("shard", "shard_bytes")]
        packed = F.struct(*(F.col(f"`{c}`") for c in own)) if own else F.struct(F.lit(None))
        if not found:
            return docs.select(packed.alias("__doc")).select("__doc.*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("shard_bytes")).limit(0)
        listed = self.spark.createDataFrame([(s.path, i, s.bytes) for i, s in enumerate(found)], "__file string, shard int, shard_bytes long")
        return docs.select(packed.alias("__doc"), _file().alias("__file")).join(sent(listed), "__file").select("__doc.*", "shard", "shard_bytes")


def shard(docs: DataFrame, path: str, **sizes) -> ShardStore:
    """Loads the documents into the store at ``path``, compacts it and drops what its last version does not name.

    All rows and columns stay as they are: nulls, empty and very long texts, and
    rows that repeat. An empty table makes a version without documents.
    """
    store = ShardStore(docs.sparkSession, path, private=True, **sizes)
    store.load(docs)
    store.expire(grace_s=0)
    return store


def described(store: ShardStore, scratch: Scratch, id_col: str = "doc_id") -> DataFrame:
    """(id, shard, shard_bytes, shard_rows) of every row of a store."""
    rows = scratch.table(store.numbered().select(F.col(id_col).alias("__id"), "shard", "shard_bytes"), "numbered")
    counts = scratch.table(rows.groupBy("shard").agg(F.count("*").alias("shard_rows")), "counts")  # a row a shard
    return rows.join(sent(counts), "shard").select(F.col("__id").alias(id_col), "shard", "shard_bytes", "shard_rows")


def shard_of(docs: DataFrame, id_col: str = "doc_id", **sizes) -> DataFrame:
    """(id, shard, shard_bytes, shard_rows) of every row, once the documents are sharded in a store that is dropped again.

    The id may have any name and type; columns named as the results are only
    stored.
    """
    with Scratch(docs.sparkSession) as scratch:
        return checkpoint(described(shard(docs, f"{scratch.root}/store", **sizes), scratch, id_col))
