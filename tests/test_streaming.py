import pytest
from pyspark.sql import functions as F

from fragstream import cli
from fragstream.operators import ordering
from fragstream.sources import datasource
from fragstream.sources.http import Fetcher, FetchError, cache_control
from fragstream.plans.config import Config, Fetch
from fragstream.streaming import stateful

from . import streams
from .conftest import SF

MEMBERS = "member_id long, timestamp timestamp_ntz, is_version_of long"


@pytest.fixture
def batches(spark, tmp_path):
    """A stream over a folder, and a function that adds a batch."""
    path = f"{tmp_path}/in"

    def add(*rows):
        spark.createDataFrame([(m, __import__("datetime").datetime(2024, 1, t), e) for m, t, e in rows], MEMBERS).coalesce(1).write.mode("append").parquet(path)

    add()
    return lambda: spark.readStream.schema(MEMBERS).parquet(path), add, f"{tmp_path}/check"


def drained(stream, check, mode="append"):
    """What one run until the input ends has emitted."""
    out = []
    q = stream.writeStream.option("checkpointLocation", check).outputMode(mode).foreachBatch(lambda df, _: out.extend(df.collect())).trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def test_each_member_once_across_restarts(batches):
    stream, add, check = batches
    add((1, 1, 1), (1, 1, 1), (2, 2, 1))
    assert sorted(r.member_id for r in drained(stateful.once(stream()), check)) == [1, 2]
    add((2, 2, 1), (3, 1, 1))
    assert [r.member_id for r in drained(stateful.once(stream()), check)] == [3]


def test_latest_versions_so_far(batches):
    stream, add, check = batches
    add((1, 1, 7), (2, 5, 7), (3, 5, 7), (4, 2, None))
    assert sorted(r.member_id for r in drained(stateful.latest_versions(stream()), check)) == [2, 3, 4]
    add((5, 4, 7), (6, 6, 7), (7, 1, 8))
    assert sorted(r.member_id for r in drained(stateful.latest_versions(stream()), check)) == [6, 7]


def test_batches_are_ordered_and_late_members_come_later(batches):
    stream, add, check = batches
    seen = []

    def go():
        q = stateful.in_order(stream(), lambda df, _: seen.append([r.member_id for r in df.collect()])).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination()

    add((1, 5, 1), (2, 3, 1))
    go()
    add((3, 1, 1))
    go()
    assert [x for x in seen if x] == [[2, 1], [3]]


def test_marker_buffer(spark, tmp_path):
    from datetime import datetime

    buffer = stateful.MarkerBuffer(spark, f"file://{tmp_path}/b")
    made = lambda *rows: spark.createDataFrame([(m, datetime(2024, 1, t), 0) for m, t in rows], MEMBERS)
    ids = lambda df: [r.member_id for r in df.collect()]
    assert ids(buffer.push(made((1, 5), (2, 1), (3, 3)), 0, datetime(2024, 1, 3))) == [2]
    assert ids(buffer.push(made((4, 4)), 1, datetime(2024, 1, 5))) == [3, 4]
    assert ids(buffer.push(made((4, 4)), 1, datetime(2024, 1, 5))) == [3, 4]
    assert ids(buffer.push(made(), 2)) == [1]
    assert ids(buffer.push(made(), 3)) == []


def test_source_reads_prunes_and_polls(spark, site, tmp_path):
    datasource.register(spark)
    url = streams.plain(site)
    df = spark.read.format("fragments").option("url", url).load()
    assert df.count() == 12 and all("inner" in r.text for r in df.collect())
    url = streams.calendar(site)
    site.requests.clear()
    late = spark.read.format("fragments").option("url", url).option("urlIsView", "true").load().where(F.col("timestamp") > F.lit("2025-01-02T00:00:00Z").cast("timestamp"))
    assert late.count() == 3 and site.fetched("/2025-01-01") == 0
    site.put("/page", streams.stream("/page", shape=False) + streams.member("p", 0, "2024-01-05T00:00:00Z"))
    stream = lambda: stateful.once(spark.readStream.format("fragments").option("url", site.base + "/page").load())
    check, out = f"{tmp_path}/c", []
    q = stream().writeStream.option("checkpointLocation", check).foreachBatch(lambda df, _: out.extend(r.member_id.rpartition("/")[2] for r in df.collect())).trigger(processingTime="1 second").start()
    try:
        for wanted in (["p#0"], ["p#0", "p#1"]):
            for _ in range(60):
                if out == wanted or not q.isActive:
                    break
                __import__("time").sleep(0.5)
            assert out == wanted, q.exception()
            site.put("/page", site.pages["/page"] + streams.member("p", 1, "2024-01-04T00:00:00Z"))
    finally:
        q.stop()


def test_retries_authentication_and_headers(site):
    site.put("/a", "x", immutable=True)
    site.failures["/a"] = 2
    naps = []
    got = Fetcher(Fetch(), sleep=naps.append).get(site.base + "/a#part")
    assert got.text == "x" and got.immutable and got.max_age == 604800 and naps == [0.5, 1.0]
    site.failures["/a"] = 5
    with pytest.raises(FetchError, match="429 after 5 tries"):
        Fetcher(Fetch(), sleep=naps.append).get(site.base + "/a")
    with pytest.raises(FetchError, match="404"):
        Fetcher(Fetch()).get(site.base + "/none")
    site.failures.clear()
    site.auth = "Basic dTpw"
    with pytest.raises(FetchError, match="401"):
        Fetcher(Fetch(username="u", password="p", auth_host="elsewhere.example")).get(site.base + "/a")
    with pytest.raises(FetchError, match="401"):
        Fetcher(Fetch(username="u", password="p")).get(site.base + "/a")  # for no host known
    assert Fetcher(Fetch(username="u", password="p", auth_host="127.0.0.1")).get(site.base + "/a").text == "x"
    sent = [a for p, a, _ in site.requests if p == "/a" and a]
    assert sent == ["Basic dTpw"]
    assert cache_control(None) == (False, None) and cache_control("MAX-AGE=x, Immutable") == (True, None)


def test_window_of_the_data_source(spark, site):
    """Options before and after hold for members, not for pages alone."""
    datasource.register(spark)
    url = streams.plain(site)
    read = lambda **o: spark.read.format("fragments").options(url=url, **o).load().count()
    assert read() == 12 and site.fetched("/0") == site.fetched("/1") == site.fetched("/2") == 1  # once each
    assert read(after="2024-07-14T10:20:00Z") == 3
    assert read(before="2024-07-14T09:20:00Z", after="2024-07-14T08:00:00Z") == 3
    with pytest.raises(Exception, match="no date"):
        read(after="soon")


def test_command_line(spark, site, tmp_path, capsys):
    url = streams.plain(site)
    assert cli.main([url, "--ordered", "ascending", "--after", "2024-07-14T10:00:00Z", "--concurrent", "2"], spark) == 0
    out = capsys.readouterr()
    assert out.out.count("label") == 5 and "5 members, 4 fragments" in out.err
    condition = tmp_path / "c.ttl"
    condition.write_text('@prefix csp: <http://vocab.deri.ie/csp#> . @prefix tree: <https://w3id.org/tree#> . <> a csp:Condition ; tree:relationType tree:EqualToRelation ; tree:path <http://example.org/ns#label> ; tree:value "e1 0" .')
    assert cli.main([url, "--condition", str(condition), "--sds-stream", "http://s", "--out", f"{tmp_path}/out", "--concurrent", "2"], spark) == 0
    assert sum("sds#payload" in r[0] for r in spark.read.text(f"{tmp_path}/out").collect()) == 1


def test_config_rejects_what_it_does_not_know():
    with pytest.raises(ValueError, match="unknown options: bogus"):
        Config.of(url="x", bogus=1)
    with pytest.raises(ValueError, match="order"):
        Config(url="x", ordered="up")
    assert Config.of(url="x", before=None).timezone == "AoE" and Config(url="x", default_timezone="nowhere").timezone == "AoE"


def test_events_stream_agrees_with_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("event_id").alias("member_id"), F.col("ts").alias("timestamp"), F.col("user_id").alias("is_version_of"))
    events.coalesce(1).write.parquet(f"{tmp_path}/e")
    got = drained(stateful.latest_versions(stateful.once(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e"))), f"{tmp_path}/c")
    from fragstream.operators import versions

    assert sorted(r.member_id for r in got) == sorted(r.member_id for r in versions.last_version_only(ordering.distinct_members(events)).collect())
