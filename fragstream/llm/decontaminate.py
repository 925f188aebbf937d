"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned by the windows of every document.

DataFrame functions only. A window is 13 consecutive words; an item with fewer
words is one window. One scan hashes every window of every document and joins
it with the distinct hashes of the benchmark; the few documents that are hit are
then verified word by word. All three lower-case A-Z alone: ``lower`` of a whole text
and of its words differ, as a capital sigma depends on what is around the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, checkpoint, lower_ascii, sent

WINDOW = 13
# Everything but ASCII that is no letter or digit, listed one by one: Java looks such a class up in a table, ranges it compares in turn.
_OTHER = [c for c in range(128) if not chr(c).isalnum()]
ANY_CASE_WORD = "[^" + "".join(rf"\x{c:02X}" for c in _OTHER) + "]+"
#: A word of texts whose A-Z are lower-cased.
WORD = "[^" + "".join(rf"\x{c:02X}" for c in [*_OTHER, *range(65, 91)]) + "]+"
#: Hashes of so many windows (8 bytes each) are broadcast to one scan; a larger benchmark is scanned for block by block, as each scan costs less than dealing every window of the corpus.
BROADCAST_WINDOWS = 2_000_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def windows_of(bench: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """(hash, size, gram, items): the distinct windows of all items with their words and the ids of the items that have them."""
    rows = bench.select(F.col(id_col).cast("string").alias("item"), _words(lower_ascii(F.col(text_col))).alias("w")).where(F.size("w") > 0)
    sized = rows.withColumn("size", F.least(F.size("w"), F.lit(WINDOW)))
    each = sized.select("item", "size", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1), lambda i: F.slice("w", i, F.col("size")))).alias("g"))
    grams = each.groupBy(F.array_join("g", " ").alias("gram"), "size").agg(F.collect_set("item").alias("items"), F.first("g").alias("g"))
    scanned = F.transform("g", lambda x: F.xxhash64(x))
    return scratch.table(grams.select(F.xxhash64("size", scanned).alias("hash"), "size", "gram", "items"), "windows")


def _scan(text: Column, sizes: list[int]) -> Column:
    """Array of (pos, size, hash) of every window of each size in a text."""

    def of(hashed: Column, size: int) -> Column:
        n = F.size(hashed) - size + 1
        made = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.lit(size), F.slice(hashed, i, size)))
        return F.when(n >= 1, made).otherwise(F.array().cast("array<long>"))

    # the one-element array binds the hashed words, so that they are made once a text and not once a window
    return F.element_at(F.transform(F.array(F.transform(_words(lower_ascii(text)), lambda x: F.xxhash64(x))), lambda h: F.array(*(of(h, s) for s in sizes))), 1)


def contaminated_windows(docs: DataFrame, bench: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(key, copy, hits, n_hit, items) of the documents with windows of the benchmark.

    ``key`` is the document's id and ``copy`` a hash of its text, so that rows
    that share an id keep their own result. ``hits`` are (pos, size) in words,
    ``items`` the ids, as text, of the items whose windows occur.
    """
    windows = windows_of(bench, scratch, item_col, item_text_col)
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).where("text is not null")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most WINDOW numbers
    empty = "key {}, copy long, hits array<struct<pos:int,size:int>>, n_hit long, items array<string>".format(docs.schema[id_col].dataType.simpleString())
    if not sizes:
        return docs.sparkSession.createDataFrame([], empty)
    blocks = -(-windows.select("hash").distinct().count() // BROADCAST_WINDOWS)
    scanned = texts.select("key", F.xxhash64("text").alias("copy"), F.posexplode(_scan(F.col("text"), sizes)).alias("which", "hashes"))
    scanned = scanned.select("key", "copy", "which", F.posexplode("hashes").alias("pos", "hash"))
    found = None
    for b in range(blocks):
        wanted = windows.select("hash").where(F.pmod("hash", F.lit(blocks)) == b).distinct()
        one = scanned.join(F.broadcast(wanted), "hash")  # about BROADCAST_WINDOWS longs
        found = one if found is None else found.unionByName(one)
    size = F.element_at(F.array(*map(F.lit, sizes)), F.col("which") + 1)
    hits = scratch.table(found.select("key", "copy", "pos", size.alias("size")).groupBy("key", "copy").agg(F.collect_set(F.struct("pos", "size")).alias("hits")), "hits")
    same = (F.col("key").eqNullSafe(F.col("__k"))) & (F.col("copy") == F.col("__c"))
    side = hits.withColumnsRenamed({"key": "__k", "copy": "__c"})
    some = texts.withColumn("copy", F.xxhash64("text")).join(sent(side), same).select("key", "copy", "text", "hits").dropDuplicates(["key", "copy"])
    grams = F.element_at(F.transform(F.array(_words(lower_ascii(F.col("text")))), lambda w: F.transform("hits", lambda h: F.struct(h["pos"].alias("pos"), h["size"].alias("size"), F.array_join(F.slice(w, h["pos"] + 1, h["size"]), " ").alias("gram")))), 1)
    each = some.select("key", "copy", F.explode(grams).alias("h")).select("key", "copy", "h.*")
    right = windows.select(F.col("gram").alias("__g"), F.col("size").alias("__s"), "items")
    sure = each.join(sent(right), (F.col("gram") == F.col("__g")) & (F.col("size") == F.col("__s")))
    per_doc = sure.groupBy("key", "copy").agg(F.collect_set(F.struct("pos", "size")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1)))))
    return per_doc.select("key", "copy", "hits", covered.cast("long").alias("n_hit"), "items")


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """Per row: its id, n_words, n_hit, n_items, items_sha256 and contaminated, as op8's contract says.

    A null text, or one without words, has no words and is clean; rows that
    repeat have a result each; an empty benchmark leaves all clean; an item with
    a null id is found but not listed; extra columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        found = contaminated_windows(docs, bench, scratch, id_col, text_col, **named)
        rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("__copy"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"))
        found = scratch.table(found, "found")
        out = rows.join(sent(found.drop("hits")), F.col("__id").eqNullSafe(F.col("key")) & (F.col("__copy") == F.col("copy")), "left")
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
        items = F.coalesce("items", F.array().cast("array<string>"))
        return checkpoint(out.select(F.col("__id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: str = "documents", **named) -> DataFrame:
    """The documents without contaminated ones (``remove="documents"``), or with the words that are hit cut out of all texts (``"spans"``)."""
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.table(contaminated_windows(docs, bench, scratch, id_col, text_col, **named), "found")
        doc = F.col("__doc")
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__doc"))
        text = doc[text_col]
        n_words = F.regexp_count(text, F.lit(ANY_CASE_WORD))
        side = found.select(F.col("key").alias("__k"), F.col("copy").alias("__c"), F.col("n_hit").alias("__n"), F.col("hits").alias("__hits"))
        same = doc[id_col].eqNullSafe(F.col("__k")) & (F.xxhash64(text) == F.col("__c"))
        if remove == "documents":
            side = side.drop("__hits").where("__n > 0")
            out = rows.join(sent(side), same & (20 * F.col("__n") >= n_words), "left_anti")
        else:
            out = rows.join(sent(side), same, "left").withColumn("__doc", F.when(F.col("__n") > 0, doc.withField(text_col, _without(text, F.col("__hits")))).otherwise(doc))
        return checkpoint(out.select("__doc.*"))


def _without(text: Column, hits: Column) -> Column:
    """The text without the words at the positions that hits cover; what lies between words stays."""
    gaps, found = F.split(text, ANY_CASE_WORD, -1), F.regexp_extract_all(text, F.lit(f"({ANY_CASE_WORD})"), F.lit(1))
    gone = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1))))
    return F.element_at(F.transform(F.array(F.struct(gaps.alias("g"), found.alias("w"), gone.alias("x"))), lambda s: F.array_join(F.transform(s["g"], lambda g, i: F.concat(g, F.when((i >= F.size(s["w"])) | F.array_contains(s["x"], i), "").otherwise(F.get(s["w"], i)))), "")), 1)


ORACLE_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 13) AS n FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
ns AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, ns)),
h AS (SELECT dg.r, dg.n, dg.i, bg.item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
p AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, n, i FROM h)) GROUP BY r),
m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN p USING (r) LEFT JOIN m USING (r)
"""
