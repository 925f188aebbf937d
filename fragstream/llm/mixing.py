"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

DataFrame functions only. One scan sizes the documents; all else works on sums
by source or by (source, hash bucket), so a source that holds most rows is
never gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ordering
from .common import WORD, Scratch, checkpoint, n_words, sent

MAX_EPOCHS = 3
SEED = "mix-1"
#: Digits of the seeded hash by which a source is divided, again and again within the bucket at the cut; only the last such bucket, a
#: 16 ** (HEX_DIGITS * LEVELS)-th of the source, is ordered document by document.
HEX_DIGITS, LEVELS = 3, 2


def source_key(c: Column) -> Column:
    """A null-free key of a source, in code point order with null last."""
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def cycled_weights(keys: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """(key, weight): the distinct keys in code point order take the weights of the cycle in turn."""
    rank = F.col("__place") - 1
    return ordering.sequence(keys.select("key"), "key", name="__place").withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(rank, F.lit(len(cycle))) + 1).cast("int")).cast("double")).drop("__place")


def water_fill(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to sources (key, weight, source_size): shares of ``total`` by weight, none above ``max_epochs`` sizes.

    Sources above their cap are clamped and the excess is shared by weight among
    the others until none is above. Each round is one aggregate over the sources,
    of which two sums reach the driver. If all caps together stay below the
    total, every source ends at its cap. Sources without weight get 0.
    """
    cap, weight = F.col("source_size") * F.lit(float(max_epochs)), F.coalesce("weight", F.lit(0.0))
    level, clamped = 0.0, -1
    while True:
        over = weight * F.lit(level) > cap
        r = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)).alias("held"), F.sum(F.when(over, 0.0).otherwise(weight)).alias("open"), F.sum(F.when(over, 1).otherwise(0)).alias("n")).first()
        if not r["open"] or r["n"] == clamped:
            break
        level, clamped = (total - r["held"]) / r["open"], r["n"]
    return sources.withColumn("target", F.when(weight * F.lit(level) > cap, cap).otherwise(weight * F.lit(level)))


@dataclass
class Plan:
    """Per source: whole repetitions, and where in hash order the fractional one ends."""

    sources: DataFrame

    def taken(self, sized: DataFrame) -> DataFrame:
        """Adds ``whole`` and ``part`` (words of the fractional repetition) to rows with __key, __h, __size, __tie."""
        rows = sized.join(sent(self.sources), F.col("__key") == F.col("key"))
        bucket = F.substring("__h", 1, HEX_DIGITS * LEVELS)
        at_cut = (bucket == F.col("cut")) & (F.col("need") > 0)
        clear = rows.where(~at_cut).withColumn("part", F.when(F.col("need") <= 0, F.lit(0)).when(bucket < F.col("cut"), F.col("__size")).otherwise(0).cast("long"))
        ordered = Window.partitionBy("__key").orderBy("__h", "__tie", "__size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("__size").over(ordered) - F.col("__size")
        cut = rows.where(at_cut).withColumn("part", F.least(F.greatest(F.col("need") - F.col("before_cut") - before, F.lit(0)), F.col("__size")).cast("long"))
        return clear.unionByName(cut)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str = SEED) -> DataFrame:
    """The rows with their size in words, their source's key and their place in the seeded order; rows without an id are placed by their text."""
    tie = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    return docs.withColumns({"__size": n_words(F.col(text_col)), "__key": source_key(F.col(source_col)), "__tie": tie, "__h": F.substring(F.md5(F.concat(F.lit(f"{seed}:"), tie).cast("binary")), 1, 16)})


def plan_mixture(rows: DataFrame, scratch: Scratch, weights=cycled_weights, max_epochs: int = MAX_EPOCHS, total: float | None = None) -> Plan:
    """Plans the mixture of materialised rows (__key, __size, __h, __tie).

    ``weights`` makes (key, weight) of a DataFrame of the distinct keys, which
    grows with the sources alone. ``total`` defaults to all words there are.
    """
    part = lambda level: F.substring("__h", 1, HEX_DIGITS * level)
    by_bucket = scratch.table(rows.groupBy("__key", part(1).alias("bucket")).agg(F.sum("__size").alias("words")), "buckets")
    by_source = scratch.table(by_bucket.groupBy(F.col("__key").alias("key")).agg(F.sum("words").alias("source_size")), "sources")
    if total is None:
        total = by_source.agg(F.sum("source_size")).first()[0] or 0
    weighed = by_source.join(weights(by_source.select("key")).withColumnRenamed("key", "__k"), F.col("key") == F.col("__k")).drop("__k")
    goal = scratch.table(water_fill(scratch.table(weighed, "weighed"), float(total), max_epochs), "targets")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("need", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("long"))
    plan = goal.select("key", "source_size", "target", "whole", "need").withColumns({"cut": F.lit("~"), "before_cut": F.lit(0).cast("long")})
    for level in range(1, LEVELS + 1):
        if level > 1:  # the bucket at the cut, divided once more
            inside = rows.join(sent(plan.select("key", "cut")), (F.col("__key") == F.col("key")) & (part(level - 1) == F.col("cut")))
            by_bucket = scratch.table(inside.groupBy("__key", part(level).alias("bucket")).agg(F.sum("__size").alias("words")), f"buckets{level}")
        running = F.sum("words").over(Window.partitionBy("__key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))  # at most 16 ** HEX_DIGITS rows a source
        ends = by_bucket.withColumn("upto", running).join(plan.select("key", "need", "before_cut"), F.col("__key") == F.col("key")).withColumn("upto", F.col("upto") + F.col("before_cut")).where("upto >= need")
        ends = ends.groupBy(F.col("__key").alias("__k")).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
        plan = plan.join(ends, F.col("key") == F.col("__k"), "left").withColumns({"cut": F.coalesce("c.bucket", F.lit("~")), "before_cut": F.coalesce("c.before", F.lit(0))}).drop("__k", "c")
        plan = scratch.table(plan, f"plan{level}")
    return Plan(plan)


def mixture_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Per row: its id, size, source_size, target and taken, as op3's contract says.

    The words of a source that the mix takes are its target, rounded. A null or
    empty text has size 0 and is taken 0 times; null sources are one source,
    last in order; rows that repeat are rows of their own; an empty table gives
    an empty result. Extra columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.table(sized(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"), F.col(source_col).alias("__s")), "__id", "__t", "__s").drop("__t", "__s"), "sized")
        out = plan_mixture(rows, scratch, **how).taken(rows)
        return checkpoint(out.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * F.col("whole") + F.col("part")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents as the mix takes them: a row for each whole repetition, and the leading words for a part of one.

    Columns stay as they are; ``n_chars``, where there is one, follows the text.
    """
    with Scratch(docs.sparkSession) as scratch:
        packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__doc"))
        doc = F.col("__doc")
        rows = sized(packed.withColumns({"__id": doc[id_col], "__t": doc[text_col], "__s": doc[source_col]}), "__id", "__t", "__s").drop("__id", "__t", "__s")
        plan = plan_mixture(scratch.table(rows.drop("__doc"), "sized"), scratch, **how)
        got = plan.taken(rows)
        full = F.col("whole") + F.when((F.col("part") == F.col("__size")) & (F.col("part") > 0), 1).otherwise(0)
        some = F.when((F.col("part") > 0) & (F.col("part") < F.col("__size")), 1).otherwise(0)
        got = got.withColumn("__full", full.cast("int")).withColumn("__rows", (full + some).cast("int")).where("__rows > 0")
        got = got.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__rows"))))
        head = _leading(doc[text_col], F.col("part"))
        cut = doc.withField(text_col, head)
        if "n_chars" in docs.columns:
            cut = cut.withField("n_chars", F.length(head).cast(docs.schema["n_chars"].dataType))
        got = got.withColumn("__doc", F.when(F.col("__turn") > F.col("__full"), cut).otherwise(doc))
        return checkpoint(got.select("__doc.*"))


def _leading(text: Column, words: Column) -> Column:
    """A text up to the end of its ``words``-th word, with the white space that is there."""
    found, gaps = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.split(text, WORD, -1)
    both = F.arrays_zip(F.slice(gaps, F.lit(1), words.cast("int")).alias("g"), F.slice(found, F.lit(1), words.cast("int")).alias("w"))
    return F.array_join(F.transform(both, lambda x: F.concat(x["g"], x["w"])), "")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS tie, substr(md5('mix-1:' || tie), 1, 16) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_w FROM w),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3.0 AS held, coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM o),
l AS (SELECT (total - held) / (all_w - gone) AS level FROM c WHERE (total - held) / (all_w - gone) * weight <= 3.0 * source_size ORDER BY k LIMIT 1),
t AS (SELECT w.source, w.source_size, CASE WHEN l.level * w.weight > 3.0 * w.source_size THEN 3.0 * w.source_size ELSE l.level * w.weight END AS target FROM w, l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, n.source_size, n.target, n.whole, CAST(floor(n.target - n.whole * n.source_size + 0.5) AS BIGINT) AS need, CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, tie, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS before FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, CAST(size * whole + least(greatest(need - before, 0), size) AS BIGINT) AS taken FROM r
"""
