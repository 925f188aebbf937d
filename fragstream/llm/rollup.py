"""Token counts as delta-maintained rollups: signed changes add up, and each batch counts once however often it is committed."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .common import Scratch, checkpoint, delete_path, n_words
from .manifest import Manifests

KEYS = ("source", "lang", "tokenizer")
#: Tokenizer versions that SQL functions can count: words between ASCII white space, and UTF-8 bytes.
NATIVE: dict[str, Callable[[Column], Column]] = {"words-1": n_words, "bytes-1": lambda c: F.coalesce(F.octet_length(c), F.lit(0)).cast("long")}
#: Deltas are folded into one table after so many batches.
FOLD_AFTER = 32


def counted(docs: DataFrame, tokenizers: tuple[str, ...] = tuple(NATIVE), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens): one row a document and tokenizer version, in one scan."""
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("tokenizer"), NATIVE[t](F.col(text_col)).alias("tokens")) for t in tokenizers)))
    return docs.select(F.col(id_col).alias("doc_id"), "source", "lang", each.alias("t")).select("doc_id", "source", "lang", "t.*")


def counted_by_bpe(docs: DataFrame, ranks_path: str, pattern: str, version: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Like ``counted`` under a byte-pair vocabulary in tiktoken's format; the file must be at ``ranks_path`` on every worker."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(n)), pa.array(n, pa.int64())], ["doc_id", "source", "lang", "tokenizer", "tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), "source", "lang", F.col(text_col).alias("text"))
    schema = rows.drop("text").withColumns({"tokenizer": F.lit(""), "tokens": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(run, schema)


class TokenRollup:
    """Additive totals of documents and tokens by source, language and tokenizer version, in a folder.

    A batch is a DataFrame of changes: ``change`` ("insert", "delete" or
    "revise"), the keys, ``tokens`` and, for a revision, ``old_tokens``. Its sums
    are written as one delta and become part of the totals with the manifest
    version that lists the batch; a batch that is listed is never added again,
    and what a failed commit has written is listed nowhere. Null keys are keys of their own; null counts are 0; other
    changes are an error; groups without documents and tokens disappear.
    """

    def __init__(self, spark: SparkSession, path: str, private: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = Manifests(spark, f"{self.path}/manifests", private)

    def _sums(self, changes: DataFrame) -> DataFrame:
        old = F.coalesce("old_tokens", F.lit(0)) if "old_tokens" in changes.columns else F.lit(0)
        new, kind = F.coalesce("tokens", F.lit(0)), F.col("change")
        wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null")))).cast("long")
        docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(wrong)
        tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(kind == "revise", new - old).otherwise(wrong)
        return changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; False if it was there already.

        Each attempt writes a folder of its own before it claims a version, so
        that a late attempt changes nothing that counts.
        """
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"a batch id is made of letters, digits, dots and dashes: {batch_id!r}")
        if batch_id in self.log.latest()[1].get("batches", ()):
            return False
        delta = f"delta-{batch_id}-{uuid.uuid4().hex}"
        self._sums(changes).write.parquet(f"{self.path}/{delta}")
        won = lambda now: delta in now.get("tables", ())
        _, now = self.log.update(lambda _, now: None if batch_id in now.get("batches", ()) else now | {"batches": [*now.get("batches", []), batch_id], "tables": [*now.get("tables", []), delta]})
        if not won(now):
            delete_path(self.spark, f"{self.path}/{delta}")
            return False
        if len(now["tables"]) > FOLD_AFTER:
            self.fold()
        return True

    def fold(self) -> None:
        """Replaces the deltas there are by one table; the totals stay as they are, and batches committed meanwhile stay beside it."""
        version, now = self.log.latest()
        old = set(now.get("tables", ()))
        if len(old) < 2:
            return
        base = f"base-{uuid.uuid4().hex}"
        self.totals(version).write.parquet(f"{self.path}/{base}")
        _, then = self.log.update(lambda _, now: now | {"tables": [base, *(t for t in now["tables"] if t not in old)]} if old <= set(now["tables"]) else None)
        if base not in then["tables"]:  # another fold was faster
            delete_path(self.spark, f"{self.path}/{base}")

    def totals(self, version: int | None = None) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) as of a version, by default the newest."""
        now = self.log.latest()[1] if version is None else self.log.read(version) if version else {}
        if not now.get("tables"):
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        all_ = self.spark.read.parquet(*(f"{self.path}/{t}" for t in now["tables"]))
        sums = all_.groupBy(*KEYS).agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")


def history(rows: DataFrame, batches: int) -> dict[str, DataFrame]:
    """Batches of changes that end at the counts of ``rows``, by way of wrong ones.

    The documents are loaded in ``batches`` inserts by a hash of the id. A fifth
    of them come with a count of an older text (one token more than half), which
    a later batch revises; a fifth come twice, and the second copy is deleted as it
    came by the last batch.
    """
    part = lambda n, salt: F.coalesce(F.pmod(F.crc32(F.concat(F.lit(salt), F.col("doc_id").cast("string")).cast("binary")), F.lit(n)), F.lit(0))
    old = F.when(part(5, "old") == 0, F.floor(F.col("tokens") / 2) + 1).otherwise(F.col("tokens")).cast("long")
    twice = F.when(part(5, "twice") == 1, 2).otherwise(1)
    first = rows.withColumns({"change": F.lit("insert"), "part": part(batches, ""), "copies": twice}).withColumn("tokens", old)
    first = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    made = {f"load-{i}": first.where(F.col("part") == i) for i in range(batches)}
    made["revised"] = rows.where(part(5, "old") == 0).withColumns({"change": F.lit("revise"), "old_tokens": (F.floor(F.col("tokens") / 2) + 1).cast("long")})
    made["deleted"] = rows.where(part(5, "twice") == 1).withColumn("change", F.lit("delete")).withColumn("tokens", old)
    return made


def token_counts(docs: DataFrame, batches: int = 4) -> DataFrame:
    """Totals of all documents, after the batches of ``history``, the first of which is committed twice.

    Null texts have no tokens; null sources and languages are groups; rows that
    repeat count again; an empty table has no groups; extra columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.table(counted(docs), "counted")
        rollup = TokenRollup(docs.sparkSession, f"{scratch.root}/rollup", private=True)
        changes = history(rows, batches)
        for name in [*changes, "load-0"]:
            rollup.commit(name, changes[name])
        return checkpoint(rollup.totals())


ORACLE_SQL = r"""
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n_tokens
FROM (SELECT source, lang, 'words-1' AS tokenizer, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens FROM documents
      UNION ALL SELECT source, lang, 'bytes-1', coalesce(strlen(text), 0) FROM documents) t
GROUP BY source, lang, tokenizer
"""
