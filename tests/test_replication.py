import threading

import pytest
from pyspark.sql import functions as F

from fragstream.functions import paths
from fragstream.functions import terms as V
from fragstream.operators.conditions import And, Leaf, MaxCount, Or
from fragstream.plans.config import Fetch
from fragstream.plans.replicate import replicate as replicate_with
from fragstream.plans.state import DifferentConditions
from fragstream.sources import sinks

from . import streams

EX = "http://example.org/ns#"


def replicate(spark, url, **options):
    return replicate_with(spark, url, **{"concurrent_fetches": 2} | options)


def times(df):
    return [r.timestamp for r in df.collect()]


def ids(df):
    return sorted(r.member_id.rpartition("/")[2] for r in df.select("member_id").collect())


def types_of(df):
    return {r[0] for r in df.select(F.explode("quads").alias("q")).where(F.col("q.p") == V.TYPE).select("q.o.value").distinct().collect()}


def test_all_members_and_fragments(spark, site):
    run = replicate(spark, streams.plain(site))
    got = run.members()
    assert got.count() == 12 and run.fragment_count == 4
    row = got.where("member_id like '%e1#0'").first()
    assert row.is_version_of.endswith("/things/e1") and row.type == EX + "Thing" and str(row.timestamp) == "2024-07-14 08:00:00"
    assert {EX + "Thing", EX + "Part"} == types_of(got)
    run.commit()
    assert run.member_count == 12


def test_tasks_crawl_what_the_driver_does_not(spark, site):
    from fragstream.operators.conditions import Condition
    from fragstream.plans import crawl
    from fragstream.plans.config import Config

    start = spark.createDataFrame([(streams.plain(site).replace("/root", "/0"),)], "u string")
    config = Config(url="-", concurrent_fetches=2)
    for skip in (None, spark.createDataFrame([(site.base + "/1",)], "u string")):
        got = [sorted(r.target.rpartition("/")[2] for r in crawl.waves(start, config, Condition(), skip, n).collect()) for n in (64, 1, 0)]
        assert got == [["0", "1", "2"] if skip is None else ["0"]] * 3


@pytest.mark.parametrize(("options", "expected"), [
    ({"after": "3024-07-14T00:00:00Z"}, 0),
    ({"before": "1325-07-14T00:00:00Z"}, 0),
    ({"after": "2024-07-14T08:30:00Z", "before": "2024-07-14T09:30:00Z"}, 3),
    ({"after": "2024-07-14T09:00:00Z", "before": "2024-07-14T10:30:00Z"}, 5),
])
def test_windows_are_exclusive(spark, site, options, expected):
    assert replicate(spark, streams.plain(site), **options).members().count() == expected


def test_links_are_pruned(spark, site):
    run = replicate(spark, streams.calendar(site), url_is_view=True, after="2025-01-02T00:00:00Z")
    assert run.members().count() == 3 and run.fragment_count == 4
    assert site.fetched("/2025-01-01") == 0
    site.requests.clear()
    run = replicate(spark, streams.between(site), after="2024-10-01T00:00:00Z", default_timezone="Z")
    assert run.members().count() == 3 and run.fragment_count == 3 and not site.fetched("/m9")
    run = replicate(spark, site.base + "/root")
    assert run.members().count() == 15


def test_orders(spark, site):
    url = streams.plain(site)
    up = times(replicate(spark, url, ordered="ascending").members())
    assert up == sorted(up) and len(up) == 12
    down = times(replicate(spark, url, ordered="descending").members())
    assert down == up[::-1]


def test_latest_version_only_is_descending_among_members_that_pass(spark, site):
    url = streams.plain(site)
    got = replicate(spark, url, last_version_only=True).members()
    assert ids(got) == [f"e{i}#1" for i in range(1, 7)] and times(got) == sorted(times(got), reverse=True)
    got = replicate(spark, url, last_version_only=True, before="2024-07-14T10:00:00Z").members()
    assert ids(got) == [f"e{i}#0" for i in range(1, 7)]


def test_materialised(spark, site):
    got = replicate(spark, streams.plain(site), materialize=True).members()
    assert got.count() == 12 and got.select("member_id").distinct().count() == 6
    quads = got.select(F.explode("quads").alias("q"))
    assert quads.where(f"q.p = '{EX}of'").count() == 0
    assert quads.where("q.s.value like '%#%'").count() == 0


def test_shapes(spark, site, tmp_path):
    url = streams.plain(site)
    assert EX + "Part" not in types_of(replicate(spark, url, no_shape=True).members())
    partial = tmp_path / "partial.ttl"
    partial.write_text(streams.PREFIXES + "<http://x/s> a sh:NodeShape ; sh:targetClass ex:Thing .")
    got = replicate(spark, url, shape_file=str(partial)).members()
    assert got.count() == 12 and EX + "Part" not in types_of(got)
    full = tmp_path / "full.ttl"
    full.write_text(streams.PREFIXES + streams.SHAPE.replace("BASE", "http://x"))
    assert EX + "Part" in types_of(replicate(spark, url, shape_file=str(full)).members())
    two = tmp_path / "two.ttl"
    two.write_text(streams.PREFIXES + "<http://x/s> a sh:NodeShape . <http://x/t> a sh:NodeShape .")
    with pytest.raises(ValueError, match="one main shape"):
        replicate(spark, url, shape_file=str(two)).members()
    with pytest.raises(OSError):
        replicate(spark, url, shape_file=str(tmp_path / "none.ttl")).members()


def test_out_of_band_parts(spark, site):
    got = replicate(spark, streams.linked(site), ordered="ascending").members()
    assert got.count() == 9 and times(got) == sorted(times(got))
    texts = [r[0] for r in got.select(F.explode("quads").alias("q")).where(f"q.p = '{EX}inner'").select("q.o.value").collect()]
    assert len(texts) == 9 and site.fetched("/parts/l1") == 1


def test_state_resumes_and_rejects_another_condition(spark, site, tmp_path):
    url, state = streams.plain(site), f"file://{tmp_path}/state"
    seen = []
    run = replicate(spark, url, state_path=state)
    run.run(lambda df: seen.extend(ids(df)))
    assert len(seen) == 12
    again = replicate(spark, url, state_path=state)
    assert again.members().count() == 0 and again.fragment_count == 1
    site.put("/2", site.pages["/2"] + streams.PREFIXES + streams.member("e7", 0, "2024-07-14T12:00:00Z"))
    more = replicate(spark, url, state_path=state, refetch_mutable=True)
    assert ids(more.members()) == ["e7#0"] and site.fetched("/0") == 1
    with pytest.raises(DifferentConditions, match="Different conditions"):
        replicate(spark, url, state_path=state, before="2024-07-14T12:00:00Z").members()
    fresh = replicate(spark, url, state_path=state, start_fresh=True, before="2024-07-14T12:00:00Z")
    assert fresh.members().count() == 12


def test_following_emits_once_and_late(spark, site, tmp_path):
    site.put("/page", streams.stream("/page", shape=False) + streams.member("p", 0, "2024-01-05T00:00:00Z"))
    polls, naps = [], []

    def sink(df, poll):
        polls.append(ids(df))
        if poll == 0:
            site.put("/page", site.pages["/page"] + streams.member("p", 1, "2024-01-04T00:00:00Z"))

    run = replicate(spark, site.base + "/page", state_path=f"file://{tmp_path}/s", ordered="ascending", poll_interval_ms=1)
    events = []
    run.on("poll", events.append).follow(sink, polls=3, sleep=naps.append)
    assert polls == [["p#0"], ["p#1"], []] and events == [1, 2] and naps == [0.001, 0.001]


def test_limit_counts_arrivals_before_order(spark, site):
    got = replicate(spark, streams.plain(site), condition=MaxCount(4), ordered="descending").members()
    assert got.count() == 4


def test_conditions_on_payload(spark, site):
    label = paths.iri(EX + "label")
    part = paths.sequence(paths.iri(EX + "part"), paths.iri(EX + "inner"))
    cond = Or((Leaf(label, V.EQUAL, "e1 0"), And((Leaf(part, V.EQUAL, "in e2"), Leaf(label, V.GREATER, "e2 0")))))
    url = streams.plain(site)
    assert ids(replicate(spark, url, condition=cond).members()) == ["e1#0", "e2#1"]
    missing = Leaf(paths.iri(EX + "nothing"), V.LESS, "5", "integer")
    assert replicate(spark, url, condition=missing).members().count() == 0
    assert replicate(spark, url, condition=missing, compat=True).members().count() == 12
    with pytest.raises(Exception, match="has no value"):
        replicate(spark, url, condition=missing, strict=True).members().count()


def test_local_dump_and_envelope(spark, tmp_path):
    path = tmp_path / "dump.ttl"
    text = streams.PREFIXES + "<http://d/s> a ldes:EventStream ; ldes:timestampPath ex:at ; ldes:versionOfPath ex:of ; ldes:retentionPolicy [ a ldes:LatestVersionSubset ] .\n"
    path.write_text(text + "".join(streams.member(f"d{k}", 0, f"2024-08-22T0{k}:56:57Z") for k in (5, 6, 7, 8)).replace("BASE", "http://d"))
    assert replicate(spark, str(path)).members().count() == 4
    run = replicate(spark, str(path), after="2024-08-22T05:56:57Z", before="2024-08-22T08:00:00Z", ordered="ascending")
    got = run.members()
    assert got.count() == 2 and run.fragment_count == 1
    lines = [r[0] for r in sinks.text(run.envelope("http://d/s")).collect()]
    assert all("https://w3id.org/sds#payload" in x and "<https://w3id.org/sds#DataDescription> ." in x for x in lines)


def test_errors(spark, site):
    site.put("/none", streams.PREFIXES + "<BASE/x> a ex:Thing .")
    with pytest.raises(ValueError, match="no view"):
        replicate(spark, site.base + "/none").members()
    site.put("/bare", streams.PREFIXES + "<BASE/s> tree:view <BASE/bare> ; tree:member <BASE/m> . <BASE/m> ex:label 'x' .")
    assert replicate(spark, site.base + "/bare").members().count() == 1
    for options in ({"ordered": "ascending"}, {"before": "2024-01-01T00:00:00Z"}):
        with pytest.raises(ValueError, match="timestamp path"):
            replicate(spark, site.base + "/bare", **options).members()
    assert replicate(spark, site.base + "/bare", last_version_only=True).members().count() == 1
    site.put("/broken", streams.stream("/gone", shape=False))
    with pytest.raises(OSError, match="404"):
        replicate(spark, site.base + "/broken").members()


def test_an_older_version_does_not_follow_a_newer_one(spark, site, tmp_path):
    """Latest versions hold over polls and restarts; one of the same time passes, as within a poll."""
    site.put("/page", streams.stream("/page", shape=False) + streams.member("p", 1, "2024-01-05T00:00:00Z") + streams.member("q", 0, "2024-01-01T00:00:00Z"))
    late = [streams.member("p", 0, "2024-01-04T00:00:00Z") + streams.member("q", 1, "2024-01-02T00:00:00Z"), streams.member("p", 2, "2024-01-05T00:00:00Z")]
    polls, state = [], f"file://{tmp_path}/s"

    def sink(df, poll):
        polls.append(ids(df))
        if poll < len(late):
            site.put("/page", site.pages["/page"] + late[poll])

    options = {"state_path": state, "last_version_only": True, "poll_interval_ms": 1}
    replicate(spark, site.base + "/page", **options).follow(sink, polls=3)
    assert polls == [["p#1", "q#0"], ["q#1"], ["p#2"]]
    site.put("/page", site.pages["/page"] + streams.member("q", 5, "2024-01-01T12:00:00Z") + streams.member("r", 0, "2024-01-01T12:00:00Z"))
    assert ids(replicate(spark, site.base + "/page", refetch_mutable=True, **options).members()) == ["r#0"]


def test_a_limit_counts_over_polls_and_restarts_and_ends_the_crawl(spark, site, tmp_path):
    url, state = streams.plain(site), f"file://{tmp_path}/s"
    run = replicate(spark, url, condition=MaxCount(4), state_path=state)
    seen = []
    run.run(lambda df: seen.extend(ids(df)))
    assert seen == ["e1#0", "e2#0", "e3#0", "e4#0"] and not site.fetched("/2")  # pages in the order they were found
    assert replicate(spark, url, condition=MaxCount(4), state_path=state, refetch_mutable=True).members().count() == 0
    site.put("/page", streams.stream("/page", shape=False) + streams.member("p", 0, "2024-01-05T00:00:00Z"))
    for reset, expected in ((False, [["p#0"], ["p#1"], []]), (True, [["p#0"], ["p#1"], ["p#2"]])):
        site.put("/page", streams.stream("/page", shape=False) + streams.member("p", 0, "2024-01-05T00:00:00Z"))
        polls = []

        def sink(df, poll):
            polls.append(ids(df))  # noqa: B023
            site.put("/page", site.pages["/page"] + streams.member("p", poll + 1, f"2024-01-0{poll + 6}T00:00:00Z"))

        replicate(spark, site.base + "/page", condition=MaxCount(1 if reset else 2, reset), state_path=f"file://{tmp_path}/{reset}", poll_interval_ms=1).follow(sink, polls=3)
        assert polls == expected


def test_a_crawl_that_broke_off_goes_on(spark, site, tmp_path):
    url, state = streams.plain(site), f"file://{tmp_path}/s"
    page = site.pages.pop("/2")
    errors = []
    with pytest.raises(OSError, match="404"):
        replicate(spark, url, state_path=state).on("error", errors.append).run(lambda df: None)
    assert len(errors) == 1 and site.fetched("/0") == 1
    site.pages["/2"] = page
    run = replicate(spark, url, state_path=state)
    assert run.members().count() == 12 and site.fetched("/0") == site.fetched("/1") == 1 and run.fragment_count == 4
    run.commit()
    assert not (tmp_path / "s" / "crawl").exists()


def test_waves_of_tasks_go_on_too(spark, site, tmp_path):
    from fragstream.operators.conditions import Condition
    from fragstream.plans import crawl
    from fragstream.plans.config import Config

    start = spark.createDataFrame([(streams.plain(site).replace("/root", "/0"),)], "u string")
    page = site.pages.pop("/1")
    for local in (0, 64):
        path = f"file://{tmp_path}/c{local}"
        with pytest.raises(OSError, match="404"):
            crawl.waves(start, Config(url="-", concurrent_fetches=2), Condition(), None, local, path)
        site.pages["/1"] = page
        before = site.fetched("/0")
        got = crawl.waves(start, Config(url="-", concurrent_fetches=2), Condition(), None, local, path)
        assert sorted(r.target[-1] for r in got.collect()) == ["0", "1", "2"] and site.fetched("/0") == before
        site.pages.pop("/1")


@pytest.mark.parametrize("order", ["ascending", "descending"])
def test_members_leave_as_soon_as_nothing_can_come_before_them(spark, site, tmp_path, order):
    url = streams.calendar(site)
    parts, fetched = [], []

    def sink(df):
        parts.append([(r.timestamp, r.member_id) for r in df.collect()])
        fetched.append(len({p for p, _, _ in site.requests}))

    run = replicate(spark, url, url_is_view=True, ordered=order, state_path=f"file://{tmp_path}/s")
    run.run_early(sink, pages_a_step=1)
    whole = [(r.timestamp, r.member_id) for r in replicate(spark, url, url_is_view=True, ordered=order).members().collect()]
    assert len(parts) == 2 and [x for p in parts for x in p] == whole and fetched[0] < fetched[1]
    assert run.member_count == 6 and run.fragment_count == 5
    again = []
    replicate(spark, url, url_is_view=True, ordered=order, state_path=f"file://{tmp_path}/s").run_early(again.append)
    assert again == []


def test_a_link_that_leads_back_keeps_the_place_of_its_page(spark, site):
    """Of two bounds on the way to a page the later one counts: what is found behind such a link does not hold back more than its page did."""
    site.put("/root", streams.stream("/a", shape=False))
    site.put("/a", streams.PREFIXES + streams.relation("/a", "/b", "GreaterThanRelation", "2024-02-01T00:00:00Z"))
    site.put("/b", streams.PREFIXES + streams.member("b", 0, "2024-02-02T00:00:00Z") + streams.relation("/b", "/c", "GreaterThanRelation", "2024-01-01T00:00:00Z") + streams.relation("/b", "/d"))
    site.put("/c", streams.PREFIXES + streams.member("c", 0, "2024-01-02T00:00:00Z"))
    site.put("/d", streams.PREFIXES + streams.member("d", 0, "2024-02-03T00:00:00Z"))
    got = []
    replicate(spark, site.base + "/root", ordered="ascending").run_early(lambda df: got.extend(r.member_id.rpartition('/')[2] for r in df.collect()), pages_a_step=1)
    assert got == ["c#0", "b#0", "d#0"]


def test_events_pause_and_close(spark, site, tmp_path):
    url, state = streams.plain(site), f"file://{tmp_path}/s"
    run = replicate(spark, url, state_path=state, poll_interval_ms=60_000)
    with pytest.raises(ValueError, match="an event is one of"):
        run.on("bogus", print)
    polls = []

    def sink(df, poll):
        polls.append(df.count())
        threading.Timer(0.2, run.close).start()

    run.follow(sink)  # closing ends the wait between polls
    assert polls == [12]
    run.run(lambda df: polls.append("closed"))
    assert polls == [12]
    held = replicate(spark, url, state_path=state, refetch_mutable=True)
    held.pause()
    t = threading.Thread(target=lambda: held.run(lambda df: polls.append(df.count())))
    t.start()
    t.join(1)
    assert t.is_alive() and polls == [12]
    held.unpause()
    t.join(120)
    assert polls == [12, 0]


def test_credentials_stay_with_their_host(spark, site):
    """A link to another host, and a redirect to it, ask for credentials and get none."""
    from .conftest import Site

    evil = Site()
    try:
        for s in (site, evil):
            s.auth = "Basic dTpw"
        site.put("/root", streams.stream("/a", shape=False))
        site.put("/a", streams.PREFIXES + streams.member("a", 0, "2024-01-01T00:00:00Z") + f"<BASE/a> tree:relation [ tree:node <{evil.base}/x> ] .")
        evil.put("/x", streams.PREFIXES)
        fetch = Fetch(username="u", password="p")
        with pytest.raises(OSError, match="401"):
            replicate(spark, site.base + "/root", fetch=fetch).members()
        assert site.fetched("/a") and evil.fetched("/x") and not any(a for _, a, _ in evil.requests)
        site.redirects["/a"] = evil.base + "/x"
        with pytest.raises(OSError, match="401"):
            replicate(spark, site.base + "/root", fetch=fetch).members()
        assert evil.fetched("/x") >= 2 and not any(a for _, a, _ in evil.requests)
    finally:
        evil.server.shutdown()


def test_the_limit_by_origin_holds_over_all_tasks(spark, site):
    """More pages than the driver fetches itself, dealt over tasks: no more are asked for at a time than allowed."""
    site.put("/root", streams.stream("/0", shape=False))
    site.put("/0", streams.PREFIXES + "".join(streams.relation("/0", f"/n{i}") for i in range(80)))
    for i in range(80):
        site.put(f"/n{i}", streams.PREFIXES)
    site.slow = 0.02
    assert replicate(spark, site.base + "/root", concurrent_fetches=3).pages().count() == 81
    assert 1 < site.most <= 3
