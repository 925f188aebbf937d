import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fragstream.llm import sharding
from fragstream.llm.common import Scratch
from fragstream.llm.manifest import Conflict
from fragstream.llm.sharding import Shard, plan_merges


def rows(df):
    return sorted(map(str, df.collect()))


def test_round_trip_of_every_row(docs, none, tmp_path):
    store = sharding.shard(docs.repartition(9), f"file://{tmp_path}/s", target=1 << 20, floor=1 << 12)
    assert rows(store.read()) == rows(docs)
    assert rows(store.numbered().drop("shard", "shard_bytes")) == rows(docs)
    got = sharding.shard_of(docs)
    assert got.count() == docs.count() and got.where("shard is null or shard_rows < 1").count() == 0
    empty = sharding.shard(none, f"file://{tmp_path}/e")
    assert empty.read().count() == 0 and empty.numbered().count() == 0 and sharding.shard_of(none).count() == 0


def test_arrivals_accumulate_and_old_versions_stay_readable(docs, tmp_path):
    store = sharding.ShardStore(docs.sparkSession, f"file://{tmp_path}/s", floor=1 << 10)
    parts = [docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == i).coalesce(2) for i in range(3)]
    seen = [store.append(p) for p in parts]
    assert seen == [1, 2, 3] and rows(store.read()) == rows(docs)
    last = store.compact()
    store.compact(finish=True)
    assert last > 3 and rows(store.read()) == rows(docs) and rows(store.read(1)) == rows(parts[0])
    assert len(store.shards()) < len(store.shards(3))
    store.expire(versions=2)  # nothing is old enough to go
    assert rows(store.read()) == rows(docs)
    listed = {str(p) for p in (tmp_path / "s").glob("data-*/part-*")}
    store.expire(versions=2, grace_s=0)
    left = {str(p) for p in (tmp_path / "s").glob("data-*/part-*")}
    assert left < listed and rows(store.read()) == rows(docs) == rows(store.read(store.log.latest()[0] - 1))
    assert len(list((tmp_path / "s" / "manifests").glob("v*.json"))) == 2  # no version is listed that can't be read


def test_merges_take_similar_sizes_up_to_the_target():
    mb = 1 << 20
    shards = [Shard(f"s{i}", mb) for i in range(9)] + [Shard("m", 6 * mb), Shard("big", 30 * mb)]
    groups = plan_merges(shards, target=4 * mb, floor=mb // 4, fan_in=4)
    assert [len(g) for g in groups] == [4, 4] and not any(s.path in ("m", "big") for g in groups for s in g)
    assert plan_merges(shards[:3], 32 * mb, mb // 4, 4) == []
    assert [len(g) for g in plan_merges(shards[:3], 32 * mb, mb // 4, 4, finish=True)] == [3]
    assert sharding.tier(0) == sharding.tier(1 << 18) == 0 and sharding.tier((1 << 18) + 1) == 1


def hexes(blocks):
    """Text that Parquet can't make much smaller: 64 bytes a block."""
    return F.array_join(F.transform(F.sequence(F.lit(1), blocks), lambda k: F.sha2(F.concat_ws("-", "doc_id", k), 256)), "")


def test_large_partitions_become_shards_of_the_target_at_most(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 2).withColumnRenamed("id", "doc_id").withColumn("text", hexes(F.lit(320)))  # 40 MB a partition
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s")
    store.append(docs)
    assert max(s.bytes for s in store.shards()) <= sharding.TARGET_BYTES / 2
    store = sharding.shard(docs, f"file://{tmp_path}/t")
    sizes = [s.bytes for s in store.shards()]
    assert max(sizes) <= sharding.TARGET_BYTES and sum(n > sharding.TARGET_BYTES / 2 for n in sizes) >= len(sizes) - 1
    assert store.log.latest()[0] > 1  # merged
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("doc_id", "text").cast("decimal(38,0)"))).first()
    assert digest(store.read()) == digest(docs)


def test_each_group_becomes_a_shard_of_its_own(docs, tmp_path):
    store = sharding.ShardStore(docs.sparkSession, f"file://{tmp_path}/s")
    for _ in range(4):
        store.append(docs.limit(3).coalesce(1))
    old = store.shards()
    store._merge([old[:2], old[2:]])
    assert len(store.shards()) == 2 and store.read().count() == 12
    assert docs.sparkSession.conf.get(sharding.UNION, "true") == "true"


def test_uneven_rows_are_cut_to_the_target_but_never_a_row(spark, tmp_path):
    # the mean row is small: the last rows together, and one alone, are above the target
    docs = spark.range(0, 3000, 1, 1).withColumnRenamed("id", "doc_id").withColumn("text", hexes(F.when(F.col("doc_id") == 2999, 12000).when(F.col("doc_id") > 2990, 2000).otherwise(1)))
    target = 1 << 18
    store = sharding.shard(docs, f"file://{tmp_path}/s", target=target, floor=1 << 12)
    large = {i for i, s in enumerate(store.shards()) if s.bytes > target}
    assert [r.doc_id for r in store.numbered().where(F.col("shard").isin(large)).select("doc_id").collect()] == [2999]
    assert rows(store.read()) == rows(docs)
    old = sharding.ShardStore(spark, f"file://{tmp_path}/old")  # a store from before, with a shard above its target
    old.append(docs)
    old = sharding.ShardStore(spark, f"file://{tmp_path}/old", target=target, floor=1 << 12)
    old.compact()
    assert sum(s.bytes > target for s in old.shards()) == 1 and rows(old.read()) == rows(docs)


def test_writers_at_the_same_time(docs, tmp_path, monkeypatch):
    a, b = (sharding.ShardStore(docs.sparkSession, f"file://{tmp_path}/s", floor=1 << 10) for _ in range(2))
    a.append(docs.limit(3))
    version, now = a.log.latest()
    a.append(docs.limit(2))
    with pytest.raises(Conflict):
        a.log.commit(version + 1, now)
    written = a._written

    def slow(*args):
        made = written(*args)
        monkeypatch.setattr(a, "_written", written)
        b.append(docs.limit(4))
        return made

    monkeypatch.setattr(a, "_written", slow)  # b commits between a's files and a's version
    a.append(docs.limit(1))
    assert a.read().count() == 10
    old = a.shards()
    b._merge([old[:2]])
    before = sorted(str(p) for p in (tmp_path / "s").glob("data-*/part-*"))
    a._commit(a._written(docs.limit(1)), old[1:3], docs.schema)  # one of them has been merged meanwhile
    assert a.read().count() == 10 and sorted(str(p) for p in (tmp_path / "s").glob("data-*/part-*")) == before


def test_every_load_arrives_and_is_merged(docs, none, tmp_path):
    """A load of any size makes several versions, and fewer shards than it has written files."""
    store = sharding.ShardStore(docs.sparkSession, f"file://{tmp_path}/s")
    arrived, commit = [], store._commit

    def seen(add, remove, schema):
        arrived.append((len(add), len(remove)))
        return commit(add, remove, schema)

    store._commit = seen
    store.load(docs)
    loads, merges = [a for a, r in arrived if not r], [(a, r) for a, r in arrived if r]
    assert len(loads) == sharding.ARRIVALS and min(loads) >= sharding.FAN_IN and len(merges) >= 2 and all(a < r for a, r in merges)
    assert store.log.latest()[0] == len(arrived) and len(store.shards()) == 1 and rows(store.read()) == rows(docs)


def test_digest_equals_the_files(docs, tmp_path):
    """Brute force: what pyarrow finds in each file of the manifest."""
    store = sharding.shard(docs.repartition(9), f"file://{tmp_path}/s", target=1 << 13, floor=1 << 11)
    assert len(store.shards()) > 2
    expected = []
    for i, s in enumerate(store.shards()):
        path = tmp_path / "s" / s.path
        ids = pq.read_table(path, columns=["doc_id"]).column(0).to_pylist()
        expected += [(d, i, path.stat().st_size, len(ids)) for d in ids]
    with Scratch(docs.sparkSession) as scratch:
        assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in sharding.described(store, scratch).collect())


def test_columns_named_as_the_results(docs, none):
    named = docs.selectExpr("doc_id as shard_rows", "text", "cast(doc_id as string) as Shard", "1 as shard_bytes", "'x' as __file", "2 as __doc")
    got = sharding.shard_of(named.withColumnRenamed("shard_rows", "key"), id_col="key")
    assert got.columns == ["key", "shard", "shard_bytes", "shard_rows"] and got.count() == docs.count()
    with Scratch(docs.sparkSession) as scratch:
        made = sharding.shard(named, f"{scratch.root}/s").numbered()
        assert made.columns == ["shard_rows", "text", "__file", "__doc", "shard", "shard_bytes"] and made.count() == docs.count()
        assert made.where("__file <> 'x' or __doc <> 2 or shard <> 0").count() == 0
        assert sharding.shard(named.limit(0), f"{scratch.root}/e").numbered().columns == made.columns
