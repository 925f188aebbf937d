"""Ranges, conditions, links, versions and order, without pages."""

import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fragstream.functions import partial_dates, paths, rdf, scalars
from fragstream.functions import terms as V
from fragstream.operators import ordering, relations, versions
from fragstream.operators.bounds import Range
from fragstream.operators.conditions import And, Condition, Leaf, MaxCount, Or, over_columns, window
from fragstream.operators.relations import Chain, Link, Step
from fragstream.plans import condition_files

from .conftest import SF

KINDS = {V.EQUAL: (False, True, False), V.LESS: (True, False, False), V.LESS_EQUAL: (True, True, False), V.GREATER: (False, False, True), V.GREATER_EQUAL: (False, True, True)}


@pytest.mark.parametrize("kind", KINDS)
def test_contains_around_a_bound(spark, kind):
    r = Range.of(kind, 5)
    assert tuple(r.contains(v) for v in (4, 5, 6)) == KINDS[kind]
    got = spark.createDataFrame([(4,), (5,), (6,), (None,)], "v int").select(r.holds(F.col("v")).alias("x")).collect()
    assert [x.x for x in got] == [*KINDS[kind], None]


def _truth(a, x, b, y):
    test = {V.EQUAL: lambda v, w: v == w, V.LESS: lambda v, w: v < w, V.LESS_EQUAL: lambda v, w: v <= w, V.GREATER: lambda v, w: v > w, V.GREATER_EQUAL: lambda v, w: v >= w}
    return any(test[a](v / 4, x) and test[b](v / 4, y) for v in range(8, 40))


@pytest.mark.parametrize("a", KINDS)
@pytest.mark.parametrize("b", KINDS)
def test_overlaps_and_meet(a, b):
    for y in (4, 5, 6):
        one, two = Range.of(a, 5), Range.of(b, y)
        assert one.overlaps(two) == two.overlaps(one) == _truth(a, 5, b, y)
        both = one.meet(two)
        assert all(both.contains(v) == (one.contains(v) and two.contains(v)) for v in (3.5, 4, 4.5, 5, 5.5, 6, 6.5))


def test_zero_and_empty_are_bounds():
    assert not Range.of(V.GREATER, 0).contains(-1) and not Range.of(V.LESS, "").contains("a")
    assert Range().contains(1) and Range().overlaps(Range.of(V.LESS, 3))


@pytest.mark.parametrize(("value", "kind", "zone", "low", "high"), [
    ("2024", "gYear", "Z", "2024-01-01 00:00", "2025-01-01 00:00"),
    ("2024-12", "gYearMonth", "Z", "2024-12-01 00:00", "2025-01-01 00:00"),
    ("2024-02-29", "date", "Z", "2024-02-29 00:00", "2024-03-01 00:00"),
    ("2024-02-29", "date", "AoE", "2024-02-28 12:00", "2024-03-01 12:00"),
    ("2024-02-29+01:00", "date", "AoE", "2024-02-28 23:00", "2024-02-29 23:00"),
    ("2024-02-29", "date", "-02:30", "2024-02-29 02:30", "2024-03-01 02:30"),
    ("2024-02-29T10", "string", "Z", "2024-02-29 10:00", "2024-02-29 11:00"),
    ("2024-02-29T10:05Z", "string", "AoE", "2024-02-29 10:05", "2024-02-29 10:06"),
    ("2024-13", "gYearMonth", "Z", None, None),
    ("soon", "date", "Z", None, None),
])
def test_partial_dates(spark, value, kind, zone, low, high):
    at = lambda x: x and datetime.strptime(x, "%Y-%m-%d %H:%M")
    got = partial_dates.parse(value, kind, zone)
    assert tuple(x and x.replace(tzinfo=None) for x in got) == (at(low), at(high))
    row = spark.createDataFrame([(value,)], "v string").select(partial_dates.interval(F.col("v"), kind, zone).alias("i")).first().i
    assert (row["min"], row["max"]) == (at(low), at(high))


def test_compat_offsets_are_added():
    assert partial_dates.parse("2024-01-01+01:00", "date", "Z", compat=True)[0].hour == 1
    with pytest.raises(ValueError, match="time zone"):
        partial_dates.parse("2024-01-01", "date", "CET")


def test_scalars(spark):
    df = spark.createDataFrame([("12abc",), (" -3.5e2x",), ("abc",), (None,)], "v string")
    got = df.select(scalars.leading_integer(F.col("v")).alias("i"), scalars.leading_float(F.col("v")).alias("f")).collect()
    assert [tuple(r) for r in got] == [(12, 12.0), (-3, -350.0), (None, None), (None, None)]
    df = spark.createDataFrame([("http://a.b:80/c?d", "public, max-age=7, immutable", "2024-01-01T00:00:00+01:00")], "u string, h string, t string")
    r = df.select(scalars.host(F.col("u")).alias("h"), scalars.origin(F.col("u")).alias("o"), scalars.cache_directives(F.col("h")).alias("c"), scalars.instant(F.col("t")).alias("t"), scalars.iso(scalars.instant(F.col("t"))).alias("iso")).first()
    assert (r.h, r.o, r.c, r.t, r.iso) == ("a.b", "http://a.b:80", {"public": "", "max-age": "7", "immutable": ""}, datetime(2023, 12, 31, 23), "2023-12-31T23:00:00.000Z")


def leaf(kind, value, domain="float", column="v"):
    return Leaf(paths.iri(column), kind, str(value), domain)


def passing(df, cond, **how):
    return sorted(r.i for r in cond.apply(df, over_columns({"v": "v", "t": "t"}), "i", "p", **how).collect())


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, float(i) if i != 7 else None, i // 5, "ab"[i % 2]) for i in range(10)], "i long, v double, p int, t string")


def test_condition_trees(rows):
    low, high = leaf(V.LESS, 3), leaf(V.GREATER_EQUAL, 8)
    assert passing(rows, low | high) == [0, 1, 2, 8, 9]
    assert passing(rows, And((low, leaf(V.GREATER, 0)))) == [1, 2]
    assert passing(rows, Condition()) == list(range(10))
    assert passing(rows, low, compat=True) == [0, 1, 2, 7]
    with pytest.raises(Exception, match="has no value"):
        passing(rows, low, strict=True)


def test_limits(rows):
    assert passing(rows, MaxCount(3)) == [0, 1, 2]
    assert passing(rows, MaxCount(2, reset_on_poll=True)) == [0, 1, 5, 6]
    assert passing(rows, And((leaf(V.GREATER, 4), MaxCount(2)))) == [5, 6]
    assert passing(rows, Or((leaf(V.GREATER, 7), MaxCount(2)))) == [0, 1, 8, 9]
    assert passing(rows, Or((And((leaf(V.GREATER, 4), MaxCount(1))), leaf(V.EQUAL, 0)))) == [0, 5]
    assert MaxCount(2).full(2) and And((MaxCount(2), leaf(V.LESS, 1))).full(2) and not Or((MaxCount(2), leaf(V.LESS, 1))).full(5)
    with pytest.raises(ValueError, match="orders arrivals"):
        MaxCount(1).apply(rows, None)


def test_pruning_agrees_with_the_driver(spark):
    t = "<http://x/t>"
    cond = window(paths.iri("http://x/t"), "2024-02-01T00:00:00Z", "2024-01-10T00:00:00Z")
    links = [
        Link("r", "a", V.GREATER_EQUAL, t, (("2024-01-01T00:00:00Z", V.XSD + "dateTime"),)),
        Link("r", "a", V.LESS, t, (("2024-01-10T00:00:00Z", V.XSD + "dateTime"),)),
        Link("r", "b", V.GREATER_EQUAL, t, (("2024-01-31T00:00:00Z", V.XSD + "dateTime"),)),
        Link("r", "c", V.BETWEEN, t, (("2024-01", V.XSD + "gYearMonth"),)),
        Link("r", "d", V.BETWEEN, t, (("2024-02-05", V.XSD + "date"),)),
        Link("r", "e", V.GREATER, "<http://x/other>", (("zzz", V.XSD + "string"),)),
        Link("r", "f"),
        Link("r", "g", V.LESS, t),
        Link("r", "h", "http://x/InBetweenRelation", t, (("1999", V.XSD + "gYear"),)),
    ]
    by = {}
    for x in links:
        by.setdefault(x.node, []).append(x)
    own = {n: relations.allowed(ls, cond, "Z") for n, ls in by.items()}
    assert own == {"a": False, "b": True, "c": True, "d": False, "e": True, "f": True, "g": False, "h": True}
    df = spark.createDataFrame([(x.source, x.node, x.type, x.path, x.values[0][0] if x.values else None, x.values[0][1] if x.values else None) for x in links], relations.LINK)
    got = relations.pruned(relations.merged(relations.bounds_of(df)), cond).collect()
    assert {r.node: r.allowed for r in got} == own
    assert not Or((leaf(V.LESS, 1), leaf(V.LESS, 2))).allows("<v>", Range.of(V.GREATER, 3))


def test_chains():
    def chain(*steps, descending=False):
        c = Chain((), descending)
        for s in steps:
            c = c.push(Step(s is not None, s))
        return [s.value if s.important else None for s in c.steps]

    assert chain(None, None) == [None] and chain(None, 3) == [3] and chain(3, None) == [3, None] and chain(3, None, None) == [3, None]
    assert chain(3, 5) == [5] and chain(5, 3) == [5] and chain(3, None, 5) == [5]
    assert chain(3, 5, descending=True) == [3] and chain(3, 5, descending=None) == [3]
    keys = [Chain((Step(True, 4),)), Chain((Step(False),)), Chain((Step(True, 2), Step(False)))]
    assert [c.value for c in sorted(keys, key=lambda c: c.key)] == [None, 2, 4]
    assert Chain((Step(True, 2),)).before(Chain((Step(True, 3),))) and not Chain((Step(False),)).before(Chain((Step(True, 3),)))
    up = [Link("r", "n", V.GREATER_EQUAL, "t", (("5", V.XSD + "integer"),)), Link("r", "n", V.LESS, "t", (("9", V.XSD + "integer"),))]
    assert relations.step_of(up, "t") == Step(True, 5) and relations.step_of(up, "t", True) == Step(True, 9)
    assert relations.step_of(up, "u") == Step(False) and relations.step_of([Link("r", "n", V.GREATER, "t")], "t") == Step(False)


def test_versions_keep_ties_and_unknowns(spark):
    rows = [("a0", "a", 1), ("a1", "a", 3), ("a2", "a", 3), ("n", None, 0), ("t", "a", None), ("b", "b", 2)]
    df = spark.createDataFrame(rows, "member_id string, is_version_of string, timestamp int")
    assert sorted(r.member_id for r in versions.last_version_only(df).collect()) == ["a1", "a2", "b", "n", "t"]
    assert sorted(r.member_id for r in versions.latest_in_arrival_order(df, "member_id").collect()) == ["a0", "a1", "a2", "b", "n", "t"]
    assert sorted(r.member_id for r in versions.latest_in_arrival_order(df, F.desc("member_id")).collect()) == ["a1", "a2", "b", "n", "t"]


def test_numbering_is_global(spark):
    df = spark.range(1000).select(F.col("id").alias("member_id"), (F.col("id") % 7).alias("timestamp"))
    got = ordering.numbered(df.repartition(8)).orderBy("emit_seq").collect()
    assert [r.emit_seq for r in got] == list(range(1, 1001))
    assert [(r.timestamp, r.member_id) for r in got] == sorted((r.timestamp, r.member_id) for r in got)
    assert ordering.inside_marker(df, F.lit(None).cast("int")).count() == 1000 and ordering.inside_marker(df, F.lit(2)).count() == 286


def test_filters_reach_the_scan(spark):
    cond = window(paths.iri("urn:time"), "2024-01-20T00:00:00Z", "2024-01-10T00:00:00Z")
    df = cond.apply(spark.read.parquet(f"{SF}/events.parquet"), over_columns({"urn:time": "ts"})).select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-10T00:00)" in plan and "LessThan(ts,2024-01-20T00:00)" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_rdf_round_trip_and_syntax():
    text = """@prefix ex: <http://e/> . @base <http://b/> . PREFIX xsd: <http://www.w3.org/2001/XMLSchema#>
    <x> a ex:T ; ex:n 1, -2.5, 1e3, true ; ex:l "a\\"\\u00e9"@en-GB, '''long
    "text" ''' ; ex:o [ ex:p ( 1 "two" ) ] . # comment
    ex:g.h { _:b ex:p <#frag> . } GRAPH <g2> { <s> ex:p "2024"^^xsd:gYear }
    [] ex:q <> ."""
    quads = rdf.parse(text, "", "t")
    assert len(quads) == 16 and {q[3][1] for q in quads} == {"", "http://e/g.h", "http://b/g2"}
    values = {q[2][1:3] for q in quads}
    assert {("1", V.XSD + "integer"), ("-2.5", V.XSD + "decimal"), ("1e3", V.XSD + "double"), ('a"é', V.LANG_STRING), ("http://b/#frag", None)} <= values
    again = rdf.parse(rdf.write(quads))
    # blank nodes may have other names: each is told by what it stands in
    shape = lambda qs: [tuple("_" if t[0] == V.BLANK else t for t in (q[0], q[2], q[3])) + (q[1],) for q in qs]
    degree = lambda qs: sorted((sum(q[0] == b for q in qs), sum(q[2] == b for q in qs)) for b in {t for q in qs for t in (q[0], q[2]) if t[0] == V.BLANK})
    key = lambda qs: sorted(map(str, shape(qs)))
    assert key(again) == key(quads) and degree(again) == degree(quads)
    for bad in ("<a> <b>", "<a> <b> 'x", "a b c .", "x:y <p> 1 ."):
        with pytest.raises(rdf.RdfError):
            rdf.parse(bad)


def test_paths():
    quads = rdf.parse("@prefix e: <http://e/> . e:a e:p e:b . e:b e:p e:c ; e:n 1 . e:x e:q e:a .")
    e = lambda x: paths.iri("http://e/" + x)
    go = lambda p: [t[1].replace("http://e/", "") for t in paths.walk(p, quads, (V.IRI, "http://e/a", None, None))]
    assert go(paths.sequence(e("p"), e("n"))) == ["1"] and go(paths.inverse(e("q"))) == ["x"]
    assert go(paths.Path("some", (e("p"),))) == ["b", "c"] and go(paths.Path("any", (e("p"),))) == ["a", "b", "c"]
    assert go(paths.Path("alternative", (e("p"), e("n")))) == ["b"] and go(paths.Path("optional", (e("p"),))) == ["a", "b"]
    assert str(paths.sequence(paths.inverse(e("p")), e("n"))) == "^<http://e/p>/<http://e/n>"


TERM = "struct<type:string,value:string,datatype:string,lang:string>"
QUADS = f"array<struct<s:{TERM},p:string,o:{TERM},g:{TERM}>>"


def test_path_columns_equal_walks(spark):
    """Cycles, several next nodes, inverse steps, paths within repeated paths, and terms that differ in their datatype or language alone."""
    rng = __import__("random").Random(3)
    node = lambda x: (V.IRI, f"http://e/{x}", None, None)
    ends = [node(i) for i in range(9)] + [("literal", "1", "urn:int", None), ("literal", "1", "urn:string", None), ("literal", "1", "urn:string", "en")]
    members = [[(node(rng.randrange(9)), rng.choice("pPq"), rng.choice(ends), node("g")) for _ in range(rng.randrange(16))] for _ in range(60)]
    p, upper, q = paths.iri("p"), paths.iri("P"), paths.iri("q")
    some, any_ = (lambda x, k=k: paths.Path(k, (x,)) for k in ("some", "any"))
    either = paths.Path("alternative", (p, upper, paths.inverse(q)))
    turned, back = paths.Path("alternative", (paths.inverse(p), paths.inverse(upper), q)), paths.sequence(paths.inverse(upper), paths.inverse(p))
    same = [some(p), any_(p), some(paths.inverse(p)), any_(either), any_(paths.sequence(p, paths.Path("optional", (q,)))), some(paths.sequence(any_(p), q))]
    found = [*((x, x) for x in same), (some(paths.inverse(either)), some(turned)), (any_(paths.inverse(paths.sequence(p, upper))), any_(back))]
    df = spark.createDataFrame(list(enumerate(members)), f"i int, quads {QUADS}").repartition(4)
    start = F.struct(F.lit(V.IRI).alias("type"), F.lit("http://e/0").alias("value"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    got = {r[0]: r[1:] for r in df.select("i", *(paths.values(x, F.col("quads"), start).alias(f"x{k}") for k, (x, _) in enumerate(found))).collect()}
    for i, quads in enumerate(members):
        for k, (x, plain) in enumerate(found):
            assert {tuple(t) for t in got[i][k]} == set(paths.walk(plain, quads, node(0))), (i, str(x))
            assert len(got[i][k]) == len({tuple(t) for t in got[i][k]})


def test_a_long_repeated_path_follows_each_quad_about_once(spark):
    """Members with 120 nodes in a row: a step from all that was found, in each of 120 rounds, takes minutes here."""
    term = lambda x: F.struct(F.lit(V.IRI).alias("type"), x.alias("value"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    at = lambda i: term(F.concat(F.lit("urn:"), "id", F.lit("/"), i.cast("string")))
    chain = F.transform(F.sequence(F.lit(0), F.lit(119)), lambda i: F.struct(at(i).alias("s"), F.lit("p").alias("p"), at(i + 1).alias("o"), at(i).alias("g")))
    df = spark.range(0, 480, 1, 4).withColumn("quads", chain)
    began = time.monotonic()
    sizes = df.select(F.size(paths.values(paths.Path("any", (paths.iri("p"),)), F.col("quads"), at(F.lit(0)))).alias("n")).groupBy("n").count().collect()
    assert [tuple(r) for r in sizes] == [(121, 480)]
    assert time.monotonic() - began < 20


def test_condition_files(tmp_path):
    head = "@prefix csp: <http://vocab.deri.ie/csp#> . @prefix tree: <https://w3id.org/tree#> . @prefix ex: <http://e/> . @prefix sh: <http://www.w3.org/ns/shacl#> .\n"
    one = lambda kind, path, value, t: f'[ a csp:Condition ; tree:relationType tree:{kind}Relation ; tree:path {path} ; tree:value {value} ; tree:compareType "{t}" ]'
    f = tmp_path / "c.ttl"
    f.write_text(head + f"<> a csp:And ; csp:and {one('GreaterThanOrEqualTo', 'ex:lat', 10, 'number')} ; csp:and [ a csp:Or ; csp:or {one('LessThan', '( [ sh:inversePath ex:of ] ex:v )', 3, 'integer')}, [ a csp:MaxCount ; csp:val 5 ; csp:reset true ] ] .")
    got = condition_files.load(str(f), "Z")
    assert isinstance(got, And) and {type(p) for p in got.parts} == {Leaf, Or}
    assert "^<http://e/of>/<http://e/v>" in got.fingerprint() and "at most 5 a poll" in got.fingerprint()
    f.write_text(head + "<> a csp:Condition ; tree:path ex:x .")
    with pytest.raises(ValueError, match="needs a relation type"):
        condition_files.load(str(f))
    with pytest.raises(ValueError, match="comparison domain"):
        condition_files.parse(head + one("LessThan", "ex:a", 1, "decimal") + " .", "http://none")


def test_instants_without_zone_are_utc():
    cond = Leaf(paths.iri("t"), V.LESS, "2024-01-01T01:00:00+01:00", "date")
    assert cond.range.max == datetime(2024, 1, 1, tzinfo=timezone.utc)
    with pytest.raises(ValueError, match="timestamp path"):
        window(None, before="2024-01-01")
