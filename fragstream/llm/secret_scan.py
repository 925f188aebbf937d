"""Secret scans over a trigram index: Boolean queries narrow each rule down, its regex then verifies the candidates.

DataFrame functions only. The postings hold the trigrams that the rules' queries
ask for, a row for each document that has one; intersecting them is a count of
met trigrams by document and conjunction. Rules without a mandatory trigram are
run on every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, checkpoint
from .trigrams import trigram_query

#: Candidate documents up to this many (some 30 bytes each) are broadcast to pick out texts.
BROADCAST_DOCS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """A regex; ``group`` of a match must have ``least`` characters, or the match is dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = True


#: The first three are the contract's (fixed values); a run of 16+ or 32+ characters can be asked of the regex itself, as its matches are whole runs.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
)


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, key, copy): which of the wanted trigrams each lower-cased text of (key, copy, text) holds."""
    held = F.element_at(F.transform(F.array(F.lower("text")), lambda low: F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(low, t))), 1)
    return rows.select("key", "copy", F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...], scratch: Scratch) -> DataFrame | None:
    """(key, copy, kinds): documents that meet the query of some rule; None if no rule has a query."""
    terms = [(t, r.kind, i, len(c)) for r in rules for i, c in enumerate(sorted(trigram_query(r.regex) or (), key=sorted)) for t in sorted(c)]
    if not terms:
        return None
    literal = lambda t: F.struct(F.lit(t[0]).alias("t"), F.lit(t[1]).alias("kind"), F.lit(t[2]).alias("conj"), F.lit(t[3]).alias("need"))
    asked = rows.sparkSession.range(1).select(F.inline(F.array(*map(literal, terms))))  # as long as the rules are
    index = postings(rows, sorted({t[0] for t in terms}))
    met = index.join(F.broadcast(asked), F.col("trigram") == F.col("t")).groupBy("key", "copy", "kind", "conj", "need").agg(F.count_distinct("trigram").alias("n"))
    return scratch.table(met.where("n = need").groupBy("key", "copy").agg(F.collect_set("kind").alias("kinds")), "candidates")


def _matches(rows: DataFrame, rule: Rule) -> DataFrame:
    """(key, copy, kind, start, end) of the rule's leftmost non-overlapping matches, in code points."""
    text = F.col("text")
    gaps, whole = F.split(text, rule.regex, -1), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else whole
    lengths = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(whole, F.length).alias("len"), F.transform(tested, F.length).alias("part"))
    each = rows.where(text.rlike(rule.regex)).select("key", "copy", F.posexplode(lengths).alias("i", "m")).select("key", "copy", "i", "m.*")
    upto = Window.partitionBy("key", "copy").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # no more rows than a text has matches
    end = F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(upto)
    each = each.withColumn("end", end).where(F.col("len").isNotNull() & (F.col("part") >= rule.least))
    return each.select("key", "copy", F.lit(rule.kind).alias("kind"), (F.col("end") - F.col("len")).cast("long").alias("start"), F.col("end").cast("long").alias("end"))


def secret_spans(docs: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, copy, kind, start, end): spans of secrets; ``copy`` is a hash of the text, so that rows that share an id keep their own spans."""
    rows = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("copy"), F.col(text_col).alias("text")).where("text is not null")
    found = candidates(rows, rules, scratch)
    scanned = [r for r in rules if trigram_query(r.regex) is None]
    if scanned:
        some = rows.where(F.array_contains(F.array(*(F.col("text").rlike(r.regex) for r in scanned)), True))
        spans = [_matches(scratch.table(some.dropDuplicates(["key", "copy"]), "scanned"), r) for r in scanned]
    else:
        spans = []
    if found is not None:
        same = F.col("key").eqNullSafe(F.col("__k")) & (F.col("copy") == F.col("__c"))
        side = found.withColumnsRenamed({"key": "__k", "copy": "__c"})
        side = F.broadcast(side) if found.count() <= BROADCAST_DOCS else side
        picked = scratch.table(rows.join(side, same).select("key", "copy", "text", "kinds").dropDuplicates(["key", "copy"]), "picked")
        spans += [_matches(picked.where(F.array_contains("kinds", r.kind)), r) for r in rules if r not in scanned]
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_assign, n_access, n_hex, base_sha256 and spans, as op7's contract says.

    A null or empty text has no spans; rows that repeat have a result each;
    spans that start together come in the order of the rules; extra columns are
    not read; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        order = F.element_at(F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i)))), F.col("kind"))
        spans = secret_spans(docs, scratch, rules, id_col, text_col)
        own = spans.groupBy("key", "copy").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("rank"), "kind", "end"))).alias("found"))
        rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("__copy"))
        out = rows.join(own, F.col("__id").eqNullSafe(F.col("key")) & (F.col("__copy") == F.col("copy")), "left")
        found = F.coalesce("found", F.array().cast(own.schema["found"].dataType))
        listed = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
        base = F.filter(found, lambda s: s["kind"].isin([r.kind for r in rules if r.base]))
        count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        return checkpoint(out.select(F.col("__id").alias(id_col), *(count(r.kind) for r in rules if r.base), F.sha2(listed(base), 256).alias("base_sha256"), listed(found).alias("spans")))


_TEMPLATE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS (__MATCHES__),
x AS (SELECT r, kind, rank, least, generate_subscripts(g, 1) AS i, unnest(list_zip(g, w, p)) AS z FROM m),
c AS (SELECT r, kind, rank, least, z[2] AS whole, z[3] AS part, sum(length(z[1]) + coalesce(length(z[2]), 0)) OVER (PARTITION BY r, kind ORDER BY i) - coalesce(length(z[2]), 0) AS s FROM x),
f AS (SELECT r, kind, rank, CAST(s AS BIGINT) AS s, CAST(s + length(whole) AS BIGINT) AS e FROM c WHERE length(part) >= least),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN a USING (r)
"""


def _oracle() -> str:
    kinds = [("assign", 0, r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8), ("access", 1, "AKIA[A-Z0-9]+", 0, 16), ("hex", 2, "[0-9a-f]+", 0, 32), ("pem", 3, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0), ("forge", 4, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0)]
    found = " UNION ALL ".join(f"SELECT r, '{kind}' AS kind, {rank} AS rank, regexp_split_to_array(text, '{regex}') AS g, regexp_extract_all(text, '{regex}', 0) AS w, regexp_extract_all(text, '{regex}', {group}) AS p, {least} AS least FROM t" for kind, rank, regex, group, least in kinds)
    return _TEMPLATE.replace("__MATCHES__", found)


ORACLE_SQL = _oracle()
