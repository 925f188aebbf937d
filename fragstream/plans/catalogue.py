"""The registered queries over the driver's tables, with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import partial_dates, paths, rdf, scalars
from ..functions import terms as V
from ..operators import members as member_ops
from ..operators import ordering, relations, versions
from ..operators.conditions import And, Condition, MaxCount, Or, over_columns, over_quads, typed, window
from ..sources import sinks
from . import crawl, state, tabular
from .tabular import EVENTS, ORDERS, TIME, leaf

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _events(spark: SparkSession, d: str) -> DataFrame:
    return EVENTS.members(spark, d)


def _within(spark: SparkSession, d: str, before: str | None = None, after: str | None = None, table: tabular.Table = EVENTS) -> DataFrame:
    return window(TIME, before, after).apply(table.members(spark, d), table.resolve())


def _where(df: DataFrame, cond, *columns: str) -> DataFrame:
    return cond.apply(df, over_columns({c: c for c in df.columns} | {"urn:time": "timestamp"}))


@query
def replicate_all(spark, d):
    return _events(spark, d).select("member_id", "timestamp", "is_version_of", "type")


@query
def filter_after(spark, d):
    return _within(spark, d, after="2024-01-15T00:00:00Z").select("member_id", F.col("timestamp").alias("ts"))


@query
def filter_before(spark, d):
    return _within(spark, d, before="2024-01-15T00:00:00Z").select("member_id", F.col("timestamp").alias("ts"))


@query
def filter_window(spark, d):
    return _within(spark, d, "2024-01-20T00:00:00Z", "2024-01-10T00:00:00Z").select("member_id", F.col("timestamp").alias("ts"))


@query
def filter_exclusive_bounds(spark, d):
    return _within(spark, d, "1998-02-01T00:00:00Z", "1998-01-01T00:00:00Z", ORDERS).select("member_id", F.col("timestamp").alias("o_orderdate"))


@query
def cond_equal_string(spark, d):
    return _where(_events(spark, d), leaf("type", V.EQUAL, "purchase")).select("member_id", F.col("type").alias("event_type"))


@query
def cond_lt(spark, d):
    return _where(_events(spark, d), leaf("value", V.LESS, 10, "float")).select("member_id", "value")


def _lines(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet")


def _quantity(spark, d, kind, value):
    return _where(_lines(spark, d), leaf("l_quantity", kind, value, "float")).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def cond_lte(spark, d):
    return _quantity(spark, d, V.LESS_EQUAL, 2)


@query
def cond_gt(spark, d):
    return _quantity(spark, d, V.GREATER, 49)


@query
def cond_gte(spark, d):
    return _quantity(spark, d, V.GREATER_EQUAL, 49)


@query
def cond_in_between_month(spark, d):
    cond = leaf("timestamp", V.BETWEEN, "1998-03", "date", zone="Z")
    return _where(ORDERS.members(spark, d), cond).select("member_id", F.col("timestamp").alias("o_orderdate"))


@query
def cond_in_between_aoe(spark, d):
    cond = leaf("timestamp", V.BETWEEN, "2024-01-10", "date", zone="AoE")
    return _where(_events(spark, d), cond).select("member_id", F.col("timestamp").alias("ts"))


@query
def cond_and(spark, d):
    cond = And((leaf("value", V.GREATER_EQUAL, 5, "float"), leaf("value", V.LESS, 50, "float"), leaf("type", V.EQUAL, "click")))
    return _where(_events(spark, d), cond).select("member_id", "value", F.col("type").alias("event_type"))


@query
def cond_or(spark, d):
    cond = Or((leaf("type", V.EQUAL, "click"), leaf("type", V.EQUAL, "view")))
    return _where(_events(spark, d), cond).select("member_id", F.col("type").alias("event_type"))


@query
def cond_nested(spark, d):
    cond = window(TIME, after="2024-01-05T00:00:00Z", rest=Or((leaf("type", V.EQUAL, "click"), leaf("value", V.GREATER_EQUAL, 90, "float"))))
    return _where(_events(spark, d), cond).select("member_id", F.col("type").alias("event_type"), "value")


@query
def cond_json_payload(spark, d):
    df = _events(spark, d).withColumn("k", scalars.leading_integer(F.get_json_object("props", "$.k")))
    return _where(df, leaf("k", V.GREATER, 50, "integer")).select("member_id", "k")


@query
def max_count(spark, d):
    return MaxCount(100).apply(_events(spark, d), None, "member_id").select("member_id", F.col("timestamp").alias("ts"))


@query
def max_count_before_order(spark, d):
    return ordering.numbered(MaxCount(100).apply(_events(spark, d), None, "member_id"), "descending").select("member_id", "emit_seq")


@query
def max_count_reset_per_poll(spark, d):
    df = _events(spark, d).withColumn("poll", F.to_date("timestamp"))
    return MaxCount(3, reset_on_poll=True).apply(df, None, "member_id", "poll").select("member_id", F.col("timestamp").alias("ts"))


@query
def max_count_in_or(spark, d):
    cond = Or((leaf("type", V.EQUAL, "purchase"), MaxCount(50)))
    return cond.apply(_events(spark, d), over_columns({"type": "type"}), "member_id").select("member_id", F.col("type").alias("event_type"))


@query
def ordered_ascending(spark, d):
    return ordering.numbered(_events(spark, d)).select("member_id", "emit_seq")


@query
def ordered_descending(spark, d):
    return ordering.numbered(_events(spark, d), "descending").select("member_id", "emit_seq")


@query
def last_version_only(spark, d):
    return versions.last_version_only(_events(spark, d)).select("member_id", "is_version_of", F.col("timestamp").alias("ts"))


@query
def last_version_ties(spark, d):
    return versions.last_version_only(ORDERS.members(spark, d)).select("member_id", "is_version_of", F.col("timestamp").alias("d"))


@query
def last_version_as_of(spark, d):
    return versions.last_version_only(_within(spark, d, before="2024-01-15T00:00:00Z")).select("member_id", "is_version_of", F.col("timestamp").alias("ts"))


@query
def latest_in_arrival_order(spark, d):
    arrival = (F.col("member_id") * 7919) % 1000003
    return versions.latest_in_arrival_order(_events(spark, d), arrival, "member_id").select("member_id", "is_version_of", F.col("timestamp").alias("ts"))


@query
def materialize(spark, d):
    return versions.materialize_ids(_events(spark, d)).select("member_id", F.col("timestamp").alias("ts"), "type", "value")


@query
def materialize_last_version(spark, d):
    return versions.materialize_ids(versions.last_version_only(_events(spark, d))).select("member_id", F.col("timestamp").alias("ts"))


@query
def member_to_quads(spark, d):
    return member_ops.statements(_events(spark, d), {"type": F.col("type"), "isVersionOf": F.col("is_version_of").cast("string")})


@query
def sds_envelope(spark, d):
    return sinks.envelope_rows(_events(spark, d), "urn:stream:events", graph="DataDescription")


@query
def dedup_across_pages(spark, d):
    pages = _within(spark, d, before="2024-01-20T00:00:00Z").unionByName(_within(spark, d, after="2024-01-10T00:00:00Z"))
    return ordering.distinct_members(pages.select("member_id", F.col("timestamp").alias("ts")))


@query
def resume_anti_join(spark, d):
    emitted = _within(spark, d, before="2024-01-18T00:00:00Z").select("member_id")
    return ordering.not_emitted(_events(spark, d), emitted).select("member_id", F.col("timestamp").alias("ts"))


@query
def fragment_stats(spark, d):
    return member_ops.page_statistics(_events(spark, d).withColumn("page", F.to_date("timestamp")), "page")


@query
def relation_ranges(spark, d):
    ranges = tabular.calendar_ranges(_events(spark, d))
    return ranges.select(F.col("node").cast("date").alias("page"), F.col("low").alias("lower_bound"), F.col("high").alias("upper_bound"))


def _window_condition():
    return window(TIME, "2024-01-20T00:00:00Z", "2024-01-10T00:00:00Z")


@query
def relation_pruning(spark, d):
    return relations.pruned(tabular.calendar_ranges(_events(spark, d)), _window_condition()).select(F.col("node").cast("date").alias("page"), "allowed")


@query
def pruned_scan(spark, d):
    reached = relations.pruned(tabular.calendar_ranges(_events(spark, d)), _window_condition()).where("allowed").select(F.col("node").cast("date").alias("page"))
    df = _where(_events(spark, d), _window_condition()).withColumn("page", F.to_date("timestamp"))
    return df.join(reached, "page", "left_semi").select("member_id", F.col("timestamp").alias("ts"))


@query
def frontier_order(spark, d):
    steps = relations.priority(tabular.calendar_ranges(_events(spark, d)), str(TIME)).select(F.col("node").cast("date").alias("page"), F.col("important").cast("int").alias("important"), "value")
    plain = spark.sql("select date'1970-01-01' as page, 0 as important, cast(null as timestamp_ntz) as value")
    return relations.frontier(steps.unionByName(plain), "important", "value", "page").select("page", "important", "fetch_seq")


@query
def marker_emission(spark, d):
    pending = tabular.calendar_ranges(_within(spark, d, after="2024-01-11T23:59:59.999999Z"))
    return ordering.inside_marker(_events(spark, d), pending.agg(F.min("low").alias("marker"))).select("member_id", F.col("timestamp").alias("ts"))


@query
def tree_traversal(spark, d):
    day = F.to_date("timestamp")
    year, month = F.year(day).cast("bigint") * 10000, F.month(day) * 100
    days = _events(spark, d).select(day.alias("timestamp")).distinct()
    steps = F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("src"), year.alias("dst")), F.struct(year.alias("src"), (year + month).alias("dst")), F.struct((year + month).alias("src"), (year + month + F.day(day)).alias("dst"))))
    edges = days.select(steps.alias("e")).select("e.src", "e.dst").distinct()
    return crawl.reachable(edges, 0)


def _visits(spark, d):
    """Visits to pages, here one a user and day: a visit that ended in a purchase found the page immutable."""
    return _events(spark, d).select(F.concat_ws("/", "is_version_of", F.date_format("timestamp", "yyyy-MM-dd")).alias("page_url"), (F.col("type") == "purchase").alias("immutable"))


@query
def immutable_skip(spark, d):
    """Pages that a next crawl need not fetch, by what the state remembers of all visits."""
    return state.settled(_visits(spark, d)).select(F.col("page_url").alias("page"))


@query
def mutable_pages(spark, d):
    return state.changing(_visits(spark, d)).select(F.col("page_url").alias("page"))


@query
def progress_counters(spark, d):
    df = _events(spark, d)
    return df.agg(F.count("*").alias("member_count"), F.count_distinct(F.to_date("timestamp")).alias("fragment_count"), F.count_distinct("is_version_of").alias("entity_count"))


@query
def partial_date_intervals(spark, d):
    """The interval of each day, month and year that events fall on, as links carry them."""
    days = _events(spark, d).select(F.explode(F.array(*(F.struct(F.lit(k).alias("unit"), F.date_format("timestamp", f).alias("lexical")) for k, f in (("day", "yyyy-MM-dd"), ("month", "yyyy-MM"), ("year", "yyyy")))))).select("col.*").distinct()
    made = F.when(F.col("unit") == "day", partial_dates.interval(F.col("lexical"), "date", "Z")).when(F.col("unit") == "month", partial_dates.interval(F.col("lexical"), "gYearMonth", "Z")).otherwise(partial_dates.interval(F.col("lexical"), "gYear", "Z"))
    return days.withColumn("i", made).select("unit", "lexical", F.col("i.min").alias("lower_bound"), F.col("i.max").alias("upper_bound"))


def _none():
    return F.lit(None).cast("string")


def _iri(c):
    return F.struct(F.lit(V.IRI).alias("type"), c.alias("value"), _none().alias("datatype"), _none().alias("lang"))


def _blank(c):
    return F.struct(F.lit(V.BLANK).alias("type"), c.alias("value"), _none().alias("datatype"), _none().alias("lang"))


def _text(c, datatype=V.STRING):
    return F.struct(F.lit(V.LITERAL).alias("type"), c.cast("string").alias("value"), F.lit(datatype).alias("datatype"), _none().alias("lang"))


def _graph(name=None):
    return F.struct(F.lit(V.IRI if name else V.DEFAULT).alias("type"), F.lit(name or "").alias("value"), _none().alias("datatype"), _none().alias("lang"))


def _quad(s, p, o, graph=None):
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), _graph(graph).alias("g"))


def _named(kind, c):
    return F.concat(F.lit(f"urn:{kind}:"), c.cast("string"))


def _quads(spark, d):
    """Events as members with two quads each."""
    df = _events(spark, d).select(_named("event", F.col("member_id")).alias("member_id"), _named("user", F.col("is_version_of")).alias("is_version_of"), "timestamp", "type", "value")
    me = _iri(F.col("member_id"))
    return df.withColumn("quads", F.array(_quad(me, "urn:of", _iri(F.col("is_version_of"))), _quad(me, "urn:type", _text(F.col("type")))))


@query
def members_as_nquads(spark, d):
    return sinks.text(_quads(spark, d))


@query
def materialized_nquads(spark, d):
    """Members renamed to their entity: the version link is gone, the subject rewritten."""
    return versions.materialize(_quads(spark, d), "urn:of").select("member_id", rdf.nquads(F.col("quads")).alias("value"))


@query
def path_values(spark, d):
    """The first value of a path over each member's quads, as conditions on payloads read it."""
    df = _quads(spark, d)
    own = over_quads()(paths.iri("urn:type"))
    return df.where(leaf("urn:type", V.GREATER_EQUAL, "p").column(over_quads())).select("member_id", own.alias("value"))


@query
def page_links_grouped(spark, d):
    """How many links each page of the calendar has, by kind."""
    return tabular.calendar_links(_events(spark, d)).groupBy(F.col("node").cast("date").alias("page")).agg(F.count_if(F.col("type") == V.GREATER_EQUAL).alias("lower_links"), F.count_if(F.col("type") == V.LESS).alias("upper_links"))


@query
def latest_marker_descending(spark, d):
    """Descending emission: members later than the greatest upper bound still pending."""
    pending = tabular.calendar_ranges(_within(spark, d, before="2024-01-12T00:00:00Z"))
    return ordering.inside_marker(_events(spark, d), pending.agg(F.max("high").alias("marker")), descending=True).select("member_id", F.col("timestamp").alias("ts"))


@query
def page_hosts(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", scalars.host(F.col("url")).alias("host"), scalars.origin(F.col("url")).alias("origin"))


@query
def cond_empty(spark, d):
    return Condition().apply(_events(spark, d), None).select("member_id")


def _weighed(spark, d):
    """Events as quads in which only clicks have a weight."""
    df = _quads(spark, d)
    weight = F.array(_quad(_iri(F.col("member_id")), "urn:weight", _text(F.col("value"), V.XSD + "double")))
    return df.withColumn("quads", F.when(F.col("type") == "click", F.concat("quads", weight)).otherwise(F.col("quads")))


@query
def cond_missing_path(spark, d):
    """A member without a value of the path fails the comparison."""
    return typed(leaf("urn:weight", V.GREATER, 50, "float")).apply(_weighed(spark, d), over_quads()).select("member_id")


@query
def cond_missing_path_compat(spark, d):
    return typed(leaf("urn:weight", V.GREATER, 50, "float")).apply(_weighed(spark, d), over_quads(), compat=True).select("member_id")


def _chained(spark, d):
    """Orders as quads: a blank part with the status inside, and a chain of twelve further nodes."""
    df = ORDERS.members(spark, d).select("member_id", F.col("o_orderstatus").alias("status"))
    # paths cost much a row, and a small file is one task: its rows go to all cores
    df = df.repartition(max(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)).withColumn("member_id", _named("order", F.col("member_id")))
    me, part = _iri(F.col("member_id")), _blank(F.concat(F.lit("b"), "member_id"))
    step = lambda i: _iri(F.concat("member_id", F.lit(f"/{i}")))
    chain = [_quad(me if i == 0 else step(i), "urn:next", step(i + 1)) for i in range(12)]
    return df.withColumn("quads", F.array(_quad(me, "urn:part", part), _quad(part, "urn:inner", _text(F.col("status"))), _quad(me, "urn:label", _text(F.col("member_id"))), *chain))


@query
def path_sequence(spark, d):
    """The status, found through a part; the member again, through the part and back; and either of two labels."""
    part, inner = paths.iri("urn:part"), paths.iri("urn:inner")
    read = over_quads()
    there, back = paths.sequence(part, inner), paths.sequence(part, paths.inverse(part))
    either = paths.Path("alternative", (paths.iri("urn:title"), paths.iri("urn:label")))
    return _chained(spark, d).select("member_id", read(there).alias("status"), read(back).alias("self"), read(either).alias("label"))


@query
def path_repeated(spark, d):
    """How many nodes a repeated path reaches, and the last of them: no step is too far."""
    step = paths.iri("urn:next")
    found = lambda kind: paths.values(paths.Path(kind, (step,)), F.col("quads"), _iri(F.col("member_id")))
    once = _chained(spark, d).withColumn("some", found("some"))
    return once.select("member_id", F.size("some").alias("n_some"), F.size(found("any")).alias("n_any"), F.size(found("optional")).alias("n_optional"), F.element_at("some", -1)["value"].alias("last"))


@query
def typed_envelope(spark, d):
    """Time, entity and type of members, read from their quads."""
    df = _quads(spark, d)
    me = _iri(F.col("member_id"))
    more = F.array(_quad(me, "urn:time", _text(scalars.iso(F.col("timestamp")), V.XSD + "dateTime")), _quad(me, V.TYPE, _iri(F.concat(F.lit("urn:class:"), "type"))))
    bare = df.select(F.lit("page").alias("page_url"), "member_id", F.concat("quads", more).alias("quads"))
    return member_ops.enveloped(bare, TIME, paths.iri("urn:of")).select("member_id", F.date_trunc("millisecond", "timestamp").alias("ts"), "is_version_of", "type")


def _paged(spark, d):
    """Orders and their lines as the quads (page_url, s, p, o, g) of a page a year: orders are members, lines blank nodes that they lead to."""
    orders = ORDERS.raw(spark, d).select(F.concat(F.lit("urn:page:"), F.year("o_orderdate")).alias("page_url"), _named("order", F.col("o_orderkey")).alias("m"), "o_orderkey", "o_orderdate")
    listed = _quad(_iri(F.lit("urn:stream")), V.TREE + "member", _iri(F.col("m")))
    own = F.array(listed, _quad(_iri(F.col("m")), "urn:time", _text(F.date_format("o_orderdate", "yyyy-MM-dd"))), _quad(_iri(F.col("m")), V.DCT + "created", _text(F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")), V.INGESTION))
    lines = _lines(spark, d).select("l_orderkey", "l_linenumber", "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    node = _blank(F.concat_ws("-", F.lit("l"), "l_orderkey", "l_linenumber"))
    inner = F.array(_quad(_iri(F.col("m")), "urn:line", node), _quad(node, "urn:quantity", _text(F.col("l_quantity"))))
    return orders.select("page_url", F.explode(own).alias("q")).unionByName(lines.select("page_url", F.explode(inner).alias("q"))).select("page_url", "q.*")


@query
def member_listing(spark, d):
    return member_ops.listed(_paged(spark, d), "urn:stream")


@query
def member_assembly(spark, d):
    """How many quads each member owns: its own and those of the blank nodes it leads to, but none of the ingestion's."""
    quads = _paged(spark, d)
    got = member_ops.described(quads, member_ops.listed(quads, "urn:stream"))
    return got.select("page_url", "member_id", F.size("quads").alias("n_quads"))


@query
def member_assembly_flat(spark, d):
    """Only what members are the subject of."""
    quads = _paged(spark, d)
    got = member_ops.described(quads, member_ops.listed(quads), nested=False, only_default_graph=True)
    return got.select("page_url", "member_id", F.size("quads").alias("n_quads"))


@query
def created_by_ingestion(spark, d):
    return member_ops.ingested(_paged(spark, d))


@query
def page_metadata(spark, d):
    """What pages say about themselves, and how many members they list."""
    quads = _paged(spark, d)
    about = ORDERS.raw(spark, d).groupBy(F.concat(F.lit("urn:page:"), F.year("o_orderdate")).alias("page_url")).agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    day = lambda c: _text(F.date_format(c, "yyyy-MM-dd'T'00:00:00'Z'"))
    own = F.array(_quad(_iri(F.col("page_url")), V.DCT + "created", day("a")), _quad(_iri(F.col("page_url")), V.DCT + "modified", day("b")))
    return member_ops.page_metadata(quads.unionByName(about.select("page_url", F.explode(own).alias("q")).select("page_url", "q.*")))


@query
def prune_other_paths(spark, d):
    """Links on another path, and plain ones, are followed whatever their values; links on the path without a value are not."""
    links = tabular.calendar_links(_events(spark, d))
    other = links.withColumns({"path": F.lit("<urn:other>"), "node": F.concat("node", F.lit("/other"))})
    plain = links.withColumns({"path": _none(), "value": _none(), "datatype": _none(), "type": F.lit(V.PLAIN), "node": F.concat("node", F.lit("/plain"))}).distinct()
    bare = links.withColumns({"value": _none(), "datatype": _none(), "node": F.concat("node", F.lit("/bare"))})
    every = links.unionByName(other).unionByName(plain).unionByName(bare)
    return relations.pruned(relations.merged(relations.bounds_of(every)), _window_condition()).select("node", "allowed")


@query
def partial_time_intervals(spark, d):
    """The interval of each hour and minute that events fall in, as partial dateTimes; what can't be read has none."""
    kinds = F.array(*(F.struct(F.lit(k).alias("unit"), F.date_format("timestamp", f).alias("lexical")) for k, f in (("hour", "yyyy-MM-dd'T'HH"), ("minute", "yyyy-MM-dd'T'HH:mm"), ("none", "'at' HH"))))
    found = _events(spark, d).select(F.explode(kinds)).select("col.*").distinct()
    return found.withColumn("i", partial_dates.interval(F.col("lexical"), "string", "Z")).select("unit", "lexical", F.col("i.min").alias("lower_bound"), F.col("i.max").alias("upper_bound"))


@query
def link_bounds(spark, d):
    """Bounds of links by type and datatype: equality closes both ends, in-between opens the upper one, other types and unreadable values bound nothing."""
    day = F.date_format("timestamp", "yyyy-MM-dd")
    days = _events(spark, d).select(day.alias("day")).distinct()
    link = lambda kind, value, datatype: F.struct(F.lit(kind).alias("type"), value.alias("value"), F.lit(datatype).alias("datatype"))
    at = F.concat("day", F.lit("T06:30:00Z"))
    kinds = F.array(link(V.EQUAL, at, V.XSD + "dateTime"), link(V.GREATER, at, V.XSD + "dateTime"), link(V.LESS_EQUAL, at, V.XSD + "dateTime"), link(V.BETWEEN, F.col("day"), V.XSD + "date"), link(V.BETWEEN, F.substring("day", 1, 7), V.XSD + "gYearMonth"), link(V.TREE + "PrefixRelation", at, V.XSD + "dateTime"), link(V.GREATER, F.lit("soon"), V.XSD + "dateTime"))
    links = days.select("day", F.posexplode(kinds).alias("n", "k")).select("day", "n", "k.*")
    return relations.bounds_of(links).select("day", "n", F.col("low").alias("lower_bound"), F.col("high").alias("upper_bound"), "low_closed", "high_closed")


@query
def lexical_domains(spark, d):
    """Texts read as numbers and instants: what a number begins with counts, what can't be read is null."""
    df = _events(spark, d)
    number, other = F.concat("member_id", F.lit(" pieces")), F.concat(F.lit("about "), "member_id")
    when = scalars.iso(F.col("timestamp"))
    return df.select("member_id", scalars.in_domain(number, "integer").alias("i"), scalars.in_domain(F.concat(F.lit("-1."), "member_id", F.lit("kg")), "float").alias("f"), scalars.in_domain(other, "integer").alias("none_i"), scalars.in_domain(when, "date").alias("t"), scalars.in_domain(other, "date").alias("none_t"), when.alias("iso"))


@query
def cache_headers(spark, d):
    """Directives of Cache-Control headers."""
    header = F.when(F.col("member_id") % 3 == 0, F.concat(F.lit("public, MAX-AGE = "), "member_id", F.lit(" ,immutable"))).when(F.col("member_id") % 3 == 1, F.concat(F.lit("max-age="), "member_id"))
    found = scalars.cache_directives(header)
    return _events(spark, d).select("member_id", F.try_element_at(found, F.lit("max-age")).cast("long").alias("max_age"), F.map_contains_key(found, "immutable").alias("immutable"))


def _polls(spark, d):
    """Three polls, each of which finds what came since the one before: up to the 10th, the 20th and the end of the month; late ones among them, as every seventh member is found a poll later."""
    df = _events(spark, d)
    day = F.dayofmonth("timestamp")
    poll = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    return df.withColumn("poll", F.least(poll + (F.col("member_id") % 7 == 0).cast("int"), F.lit(2)))


@query
def latest_over_polls(spark, d):
    """What following emits poll by poll: latest versions of the poll that are not older than what left in an earlier one."""
    df, out, remembered = _polls(spark, d), None, None
    for n in range(3):
        own = df.where(F.col("poll") == n)
        got = versions.last_version_only(own)
        got = got if remembered is None else versions.not_older(got, remembered)
        out = got if out is None else out.unionByName(got)
        before = versions.newest(own)
        remembered = before if remembered is None else before.unionByName(remembered).groupBy("entity").agg(F.max("timestamp").alias("timestamp"))
    return out.select("member_id", "is_version_of", F.col("timestamp").alias("ts"), "poll")


@query
def max_count_over_polls(spark, d):
    """A limit that is not reset counts over polls: what one takes, the next ones lack."""
    df, out, cond, taken = _polls(spark, d).where("type = 'purchase' and is_version_of <= 3"), None, MaxCount(12), 0
    for n in range(3):
        got = cond.spent(taken).apply(df.where(F.col("poll") == n), None, "member_id")
        taken += got.count()
        out = got if out is None else out.unionByName(got)
    return out.select("member_id", "poll")


@query
def pending_by_level(spark, d):
    """How many pages each level of a crawl adds to what is pending."""
    return tree_traversal(spark, d).groupBy("depth").agg(F.count("*").alias("pending"))


@query
def local_or_remote(spark, d):
    url = F.col("url")
    some = F.when(F.col("page_id") % 2 == 0, url).otherwise(F.concat(F.lit("file:///dump/"), F.col("page_id").cast("string")))
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", scalars.remote(some).alias("remote"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


ORACLE: dict[str, str] = {
    "replicate_all": """SELECT event_id AS member_id, ts AS timestamp, user_id AS is_version_of, event_type AS type FROM events""",
    "filter_after": """SELECT event_id AS member_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    "filter_before": """SELECT event_id AS member_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'""",
    "filter_window": """SELECT event_id AS member_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
    "filter_exclusive_bounds": """SELECT o_orderkey AS member_id, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-02-01 00:00:00'""",
    "cond_equal_string": """SELECT event_id AS member_id, event_type FROM events WHERE event_type = 'purchase'""",
    "cond_lt": """SELECT event_id AS member_id, value FROM events WHERE value < 10.0""",
    "cond_lte": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 2.0""",
    "cond_gt": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 49.0""",
    "cond_gte": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49.0""",
    "cond_in_between_month": """SELECT o_orderkey AS member_id, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'""",
    "cond_in_between_aoe": """SELECT event_id AS member_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-09 12:00:00' AND ts < TIMESTAMP '2024-01-11 12:00:00'""",
    "cond_and": """SELECT event_id AS member_id, value, event_type FROM events WHERE value >= 5.0 AND value < 50.0 AND event_type = 'click'""",
    "cond_or": """SELECT event_id AS member_id, event_type FROM events WHERE event_type = 'click' OR event_type = 'view'""",
    "cond_nested": """SELECT event_id AS member_id, event_type, value FROM events WHERE (event_type = 'click' OR value >= 90.0) AND ts > TIMESTAMP '2024-01-05 00:00:00'""",
    "max_count": """SELECT event_id AS member_id, ts FROM events ORDER BY event_id LIMIT 100""",
    "max_count_before_order": """SELECT member_id, row_number() OVER (ORDER BY ts DESC, member_id) AS emit_seq FROM (SELECT event_id AS member_id, ts FROM events ORDER BY event_id LIMIT 100) t""",
    "max_count_reset_per_poll": """SELECT member_id, ts FROM (SELECT event_id AS member_id, ts, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events) t WHERE rn <= 3""",
    "ordered_ascending": """SELECT event_id AS member_id, row_number() OVER (ORDER BY ts, event_id) AS emit_seq FROM events""",
    "ordered_descending": """SELECT event_id AS member_id, row_number() OVER (ORDER BY ts DESC, event_id) AS emit_seq FROM events""",
    "last_version_only": """SELECT member_id, is_version_of, ts FROM (SELECT event_id AS member_id, user_id AS is_version_of, ts, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) t WHERE r = 1""",
    "last_version_ties": """SELECT member_id, is_version_of, d FROM (SELECT o_orderkey AS member_id, o_custkey AS is_version_of, o_orderdate AS d, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) t WHERE r = 1""",
    "last_version_as_of": """SELECT member_id, is_version_of, ts FROM (SELECT event_id AS member_id, user_id AS is_version_of, ts, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00') t WHERE r = 1""",
    "latest_in_arrival_order": """SELECT member_id, is_version_of, ts FROM (SELECT event_id AS member_id, user_id AS is_version_of, ts, max(ts) OVER (PARTITION BY user_id ORDER BY (event_id * 7919) % 1000003, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM events) t WHERE ts >= m""",
    "materialize": """SELECT user_id AS member_id, ts, event_type AS type, value FROM events""",
    "materialize_last_version": """SELECT is_version_of AS member_id, ts FROM (SELECT user_id AS is_version_of, ts, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) t WHERE r = 1""",
    "member_to_quads": """SELECT event_id AS s, 'type' AS p, event_type AS o FROM events UNION ALL SELECT event_id, 'isVersionOf', CAST(user_id AS VARCHAR(20)) FROM events""",
    "sds_envelope": """SELECT event_id AS payload, 'urn:stream:events' AS stream, 'DataDescription' AS graph FROM events""",
    "dedup_across_pages": """SELECT DISTINCT event_id AS member_id, ts FROM (SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' UNION ALL SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00') t""",
    "resume_anti_join": """SELECT e.event_id AS member_id, e.ts FROM events e WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-18 00:00:00') x WHERE x.event_id = e.event_id)""",
    "fragment_stats": """SELECT CAST(ts AS DATE) AS page, count(*) AS member_count, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY CAST(ts AS DATE)""",
    "relation_ranges": """SELECT page, max(CASE WHEN rel = 'GTE' THEN v END) AS lower_bound, min(CASE WHEN rel = 'LT' THEN v END) AS upper_bound FROM (SELECT DISTINCT CAST(ts AS DATE) AS page, 'GTE' AS rel, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS v FROM events UNION ALL SELECT DISTINCT CAST(ts AS DATE), 'LT', CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY FROM events) r GROUP BY page""",
    "relation_pruning": """SELECT page, (lo < TIMESTAMP '2024-01-20 00:00:00' AND hi > TIMESTAMP '2024-01-10 00:00:00') AS allowed FROM (SELECT DISTINCT CAST(ts AS DATE) AS page, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS lo, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY AS hi FROM events) p""",
    "pruned_scan": """SELECT e.event_id AS member_id, e.ts FROM events e WHERE CAST(e.ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20') AND e.ts > TIMESTAMP '2024-01-10 00:00:00' AND e.ts < TIMESTAMP '2024-01-20 00:00:00'""",
    "frontier_order": """SELECT page, important, row_number() OVER (ORDER BY important, page) AS fetch_seq FROM (SELECT DISTINCT CAST(ts AS DATE) AS page, 1 AS important FROM events UNION ALL SELECT DATE '1970-01-01', 0) f""",
    "marker_emission": """SELECT event_id AS member_id, ts FROM events WHERE ts < (SELECT min(lo) FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS lo FROM events WHERE ts >= TIMESTAMP '2024-01-12 00:00:00') pending)""",
    "tree_traversal": """WITH RECURSIVE edge AS (SELECT DISTINCT 'root' AS src, CAST(extract(year FROM ts) * 10000 AS BIGINT) AS dst FROM events), day_edge AS (SELECT DISTINCT CAST(extract(year FROM ts) * 10000 AS BIGINT) AS src, CAST(extract(year FROM ts) * 10000 + extract(month FROM ts) * 100 AS BIGINT) AS dst FROM events UNION ALL SELECT DISTINCT CAST(extract(year FROM ts) * 10000 + extract(month FROM ts) * 100 AS BIGINT), CAST(extract(year FROM ts) * 10000 + extract(month FROM ts) * 100 + extract(day FROM ts) AS BIGINT) FROM events), reach(node, depth) AS (SELECT dst, 1 FROM edge UNION ALL SELECT d.dst, r.depth + 1 FROM reach r JOIN day_edge d ON d.src = r.node) SELECT node, depth FROM reach""",
    "immutable_skip": """SELECT DISTINCT user_id || '/' || strftime(ts, '%Y-%m-%d') AS page FROM events WHERE event_type = 'purchase'""",
    "mutable_pages": """SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS page FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'purchase') = 0""",
    "progress_counters": """SELECT count(*) AS member_count, count(DISTINCT CAST(ts AS DATE)) AS fragment_count, count(DISTINCT user_id) AS entity_count FROM events""",
    "cond_json_payload": """SELECT event_id AS member_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50""",
    "max_count_in_or": """SELECT event_id AS member_id, event_type FROM events WHERE event_type = 'purchase' OR event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 50)""",
    "page_hosts": """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS origin FROM pages""",
    "partial_date_intervals": """SELECT DISTINCT 'day' AS unit, strftime(ts, '%Y-%m-%d') AS lexical, date_trunc('day', ts) AS lower_bound, date_trunc('day', ts) + INTERVAL 1 DAY AS upper_bound FROM events
UNION SELECT DISTINCT 'month', strftime(ts, '%Y-%m'), date_trunc('month', ts), date_trunc('month', ts) + INTERVAL 1 MONTH FROM events
UNION SELECT DISTINCT 'year', strftime(ts, '%Y'), date_trunc('year', ts), date_trunc('year', ts) + INTERVAL 1 YEAR FROM events""",
    "members_as_nquads": """SELECT '<urn:event:' || event_id || '> <urn:of> <urn:user:' || user_id || '> .' || chr(10) || '<urn:event:' || event_id || '> <urn:type> "' || event_type || '" .' || chr(10) AS value FROM events""",
    "materialized_nquads": """SELECT 'urn:user:' || user_id AS member_id, '<urn:user:' || user_id || '> <urn:type> "' || event_type || '" .' || chr(10) AS value FROM events""",
    "path_values": """SELECT 'urn:event:' || event_id AS member_id, event_type AS value FROM events WHERE event_type >= 'p'""",
    "page_links_grouped": """SELECT CAST(ts AS DATE) AS page, CAST(1 AS BIGINT) AS lower_links, CAST(1 AS BIGINT) AS upper_links FROM events GROUP BY CAST(ts AS DATE)""",
    "latest_marker_descending": """SELECT event_id AS member_id, ts FROM events WHERE ts > (SELECT max(date_trunc('day', ts) + INTERVAL 1 DAY) FROM events WHERE ts < TIMESTAMP '2024-01-12 00:00:00')""",
    "cond_empty": """SELECT event_id AS member_id FROM events""",
    "cond_missing_path": """SELECT 'urn:event:' || event_id AS member_id FROM events WHERE event_type = 'click' AND value > 50.0""",
    "cond_missing_path_compat": """SELECT 'urn:event:' || event_id AS member_id FROM events WHERE event_type <> 'click' OR value > 50.0""",
    "path_sequence": """SELECT 'urn:order:' || o_orderkey AS member_id, o_orderstatus AS status, 'urn:order:' || o_orderkey AS self, 'urn:order:' || o_orderkey AS label FROM orders""",
    "path_repeated": """SELECT 'urn:order:' || o_orderkey AS member_id, 12 AS n_some, 13 AS n_any, 2 AS n_optional, 'urn:order:' || o_orderkey || '/12' AS last FROM orders""",
    "typed_envelope": """SELECT 'urn:event:' || event_id AS member_id, date_trunc('millisecond', ts) AS ts, 'urn:user:' || user_id AS is_version_of, 'urn:class:' || event_type AS type FROM events""",
    "member_listing": """SELECT 'urn:page:' || extract(year FROM o_orderdate) AS page_url, 'urn:order:' || o_orderkey AS member_id FROM orders""",
    "member_assembly": """SELECT 'urn:page:' || extract(year FROM o_orderdate) AS page_url, 'urn:order:' || o_orderkey AS member_id, CAST(1 + coalesce(n, 0) AS INTEGER) AS n_quads FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) + count(DISTINCT (l_linenumber, l_quantity)) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "member_assembly_flat": """SELECT 'urn:page:' || extract(year FROM o_orderdate) AS page_url, 'urn:order:' || o_orderkey AS member_id, CAST(1 + coalesce(n, 0) AS INTEGER) AS n_quads FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "created_by_ingestion": """SELECT 'urn:page:' || extract(year FROM o_orderdate) AS page_url, 'urn:order:' || o_orderkey AS member_id, date_trunc('day', o_orderdate) AS created FROM orders""",
    "page_metadata": """SELECT 'urn:page:' || extract(year FROM o_orderdate) AS page_url, date_trunc('day', min(o_orderdate)) AS created, date_trunc('day', max(o_orderdate)) AS updated, count(*) AS member_count FROM orders GROUP BY 1""",
    "prune_other_paths": """SELECT page || suffix AS node, CASE suffix WHEN '' THEN page >= '2024-01-10' AND page < '2024-01-20' WHEN '/bare' THEN false ELSE true END AS allowed FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS page FROM events), (VALUES (''), ('/other'), ('/plain'), ('/bare')) s(suffix)""",
    "partial_time_intervals": """SELECT DISTINCT 'hour' AS unit, strftime(ts, '%Y-%m-%dT%H') AS lexical, date_trunc('hour', ts) AS lower_bound, date_trunc('hour', ts) + INTERVAL 1 HOUR AS upper_bound FROM events
UNION SELECT DISTINCT 'minute', strftime(ts, '%Y-%m-%dT%H:%M'), date_trunc('minute', ts), date_trunc('minute', ts) + INTERVAL 1 MINUTE FROM events
UNION SELECT DISTINCT 'none', strftime(ts, 'at %H'), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM events""",
    "link_bounds": """WITH d AS (SELECT DISTINCT date_trunc('day', ts) AS t FROM events), k(n, low, high, lc, hc) AS (VALUES (0, 1, 1, true, true), (1, 1, 0, false, false), (2, 0, 1, false, true), (3, 2, 2, true, false), (4, 3, 3, true, false), (5, 0, 0, false, false), (6, 0, 0, false, false))
SELECT strftime(t, '%Y-%m-%d') AS day, n, CASE low WHEN 1 THEN t + INTERVAL '6 hours 30 minutes' WHEN 2 THEN CAST(t AS TIMESTAMP) WHEN 3 THEN CAST(date_trunc('month', t) AS TIMESTAMP) END AS lower_bound,
CASE high WHEN 1 THEN t + INTERVAL '6 hours 30 minutes' WHEN 2 THEN t + INTERVAL 1 DAY WHEN 3 THEN date_trunc('month', t) + INTERVAL 1 MONTH END AS upper_bound, lc AS low_closed, hc AS high_closed FROM d, k""",
    "lexical_domains": """SELECT event_id AS member_id, CAST(event_id AS BIGINT) AS i, CAST('-1.' || event_id AS DOUBLE) AS f, CAST(NULL AS BIGINT) AS none_i, date_trunc('millisecond', ts) AS t, CAST(NULL AS TIMESTAMP) AS none_t, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM events""",
    "cache_headers": """SELECT event_id AS member_id, CASE WHEN event_id % 3 < 2 THEN CAST(event_id AS BIGINT) END AS max_age, event_id % 3 = 0 AS immutable FROM events""",
    "latest_over_polls": """WITH p AS (SELECT event_id, user_id, ts, event_type, least(CASE WHEN extract(day FROM ts) <= 10 THEN 0 WHEN extract(day FROM ts) <= 20 THEN 1 ELSE 2 END + CAST(event_id % 7 = 0 AS INTEGER), 2) AS poll FROM events), l AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY poll RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest FROM p) SELECT event_id AS member_id, user_id AS is_version_of, ts, poll FROM l WHERE ts = newest""",
    "max_count_over_polls": """SELECT event_id AS member_id, poll FROM (SELECT event_id, user_id, ts, event_type, least(CASE WHEN extract(day FROM ts) <= 10 THEN 0 WHEN extract(day FROM ts) <= 20 THEN 1 ELSE 2 END + CAST(event_id % 7 = 0 AS INTEGER), 2) AS poll FROM events) WHERE event_type = 'purchase' AND user_id <= 3 ORDER BY poll, event_id LIMIT 12""",
    "pending_by_level": """SELECT 1 AS depth, count(DISTINCT extract(year FROM ts)) AS pending FROM events UNION ALL SELECT 2, count(DISTINCT strftime(ts, '%Y-%m')) FROM events UNION ALL SELECT 3, count(DISTINCT CAST(ts AS DATE)) FROM events""",
    "local_or_remote": """SELECT page_id, page_id % 2 = 0 AND (url LIKE 'http://%' OR url LIKE 'https://%') AS remote FROM pages""",
}
