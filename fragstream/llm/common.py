"""What the corpus operators share: the shared folder, ASCII word rules, sampling of labelled rows."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import checkpoint, delete_path, file_system, shared_dir

__all__ = ["TRAIN_BYTES", "WORD", "Scratch", "bounded", "checkpoint", "delete_path", "file_system", "held_out", "labelled_rows", "labelled_sample", "lower_ascii", "n_words", "row_bytes", "sent", "shared_dir"]

#: A side of a join is broadcast if its rows take so many bytes at most, as ``row_bytes`` counts them.
BROADCAST_BYTES = 64 << 20
#: Labelled texts that a model learns from take so many bytes together at most.
TRAIN_BYTES = 48 << 20

#: A word of the corpus contract: a run of anything but ASCII white space (listed one by one, which Java looks up in a table).
WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Scratch:
    """Parquet tables in the shared folder that one operator call writes, reads and drops again.

    Broadcasts, shuffles and plans of what is written go when the driver collects
    its garbage, which it need not do before its heap is full: every few tables ask for it.
    """

    #: Tables written since the driver was last asked to collect its garbage, by all operators; and at how many it is.
    written, EVERY = 0, 8

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete_path(self.spark, self.root)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        Scratch.written += 1
        if Scratch.written >= Scratch.EVERY:
            Scratch.written = 0
            self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete_path(self.spark, f"{self.root}/{name}")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` would also change letters beyond ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def n_words(c: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: str, mod: int, rest: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``rest``; a null id counts as held out (it is never learned from)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(True))


def row_bytes(schema: T.StructType) -> Column:
    """About the bytes of a row before compression; nested values by their JSON or text form."""

    def of(f: T.StructField) -> Column:
        c = F.col(f"`{f.name.replace('`', '``')}`")
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return F.lit(8)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        return F.coalesce(F.octet_length(c if isinstance(f.dataType, (T.StringType, T.BinaryType)) else c.cast("string")), F.lit(0)) + 4

    return sum((of(f).cast("long") for f in schema), F.lit(0).cast("long"))


def sent(side: DataFrame, most: int | None = None) -> DataFrame:
    """The materialised side of a join, marked for broadcast if its rows take at most ``most`` bytes; else as it is, and the join shuffles."""
    size = side.agg(F.sum(row_bytes(side.schema) + 16)).first()[0] or 0
    return F.broadcast(side) if size <= (BROADCAST_BYTES if most is None else most) else side


def bounded(drawn: DataFrame, scratch: Scratch, order: tuple[str, ...], most: int = TRAIN_BYTES) -> DataFrame:
    """The first of a few thousand drawn rows (``text``), in a seeded order, that take ``most`` bytes together; the first always stays, and texts of over an eighth of it come last.

    ``order`` names columns that tell rows apart. Only they and the sizes are
    ordered; what is left out is a matter of the sample's documented bound.
    """
    drawn = scratch.table(drawn, f"drawn-{uuid.uuid4().hex[:8]}")
    by = Window.orderBy("__large", *order)
    sizes = drawn.select(*order, F.octet_length("text").alias("__n")).withColumn("__large", F.col("__n") > most // 8)
    upto = sizes.withColumns({"__upto": F.sum("__n").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "__place": F.row_number().over(by)})
    return drawn.join(F.broadcast(upto.where((F.col("__upto") <= most) | (F.col("__place") == 1)).select(*order)), [*order])


@contextlib.contextmanager
def labelled_rows(docs: DataFrame, labels: DataFrame, target: str, *, mod: int, rest: int, rows: int, seed: int, most_bytes: int = TRAIN_BYTES) -> Iterator[DataFrame]:
    """At most ``rows`` whole labelled texts, of ``most_bytes`` together, that are not held out (__i, text, __y, __h), while the context lasts.

    The ids are drawn by a seeded hash from the labels alone, so only ids are
    sorted; the texts of the drawn ids are then picked out in one scan. Rows
    without a label are skipped; several labels of one id count by their mean;
    a text that several rows share an id with is taken once (the smallest).
    """
    marked = labels.select(F.col("doc_id").alias("__i"), F.col(target).cast("double").alias("__y")).where("__i is not null and __y is not null").where(~held_out("__i", mod, rest))
    marked = marked.groupBy("__i").agg((F.avg("__y") >= 0.5).cast("int").alias("__y"))
    drawn = marked.withColumn("__h", F.xxhash64("__i", F.lit(seed))).orderBy("__h", "__i").limit(rows)
    found = docs.select(F.col("doc_id").alias("__i"), "text").where("text is not null").join(F.broadcast(drawn), "__i")
    with Scratch(docs.sparkSession) as scratch:
        yield bounded(found.groupBy("__i").agg(F.min("text").alias("text"), F.first("__y").alias("__y"), F.first("__h").alias("__h")), scratch, ("__h", "__i"), most_bytes)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, **how) -> list[tuple[str, int]]:
    """The (text, label) of ``labelled_rows`` in the order of their ids."""
    with labelled_rows(docs, labels, target, **how) as some:
        return [(r["text"], r["__y"]) for r in sorted(some.collect(), key=lambda r: r["__i"])]
