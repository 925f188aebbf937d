"""Near-duplicate classes by min-max hashing, banding and confirmation on full shingle sets.

Min-max hashing keeps the minimum *and* the maximum of each permuted shingle
set. Both agree between two sets with a probability equal to their Jaccard
similarity, so PERMS hash evaluations give 2 * PERMS signature values.
With ROWS values in each of BANDS bands, a pair at a similarity of 0.75
shares no band with a probability of (1 - 0.75**6)**64, about 4 in a million;
more similar pairs are missed far more seldom.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .bytesgrams import FOLD, P, SPACE, lean, mix, slices, word_hashes, words
from .common import Scratch, checkpoint, sent
from .graph import components, hub, nearest

SHINGLE, BANDS, ROWS = 5, 64, 6
PERMS = BANDS * ROWS // 2
SHARE = (75, 100)  # linked if 100 * intersection >= 75 * union
#: Members of a candidate bucket are compared in tiles of so many.
TILE = 512
#: And so many bytes of shingles at most, by the mean of the bucket; members of a hub are confirmed in groups of so many bytes of shingles.
TILE_BYTES = 4 << 20

_rng = np.random.default_rng(75)
FACTORS = _rng.integers(0, 2**32, PERMS, dtype=np.uint32) | np.uint32(1)
SHIFTS = _rng.integers(0, 2**32, PERMS, dtype=np.uint32)
#: Each band takes minima of half a band of permutations, and maxima of the next ones, so that no permutation comes twice in a band.
_half = _rng.permutation(PERMS).reshape(BANDS, ROWS // 2)
SLOTS = np.concatenate([_half, PERMS + np.roll(_half, 1, axis=0)], axis=1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text the sorted distinct hashes of its shingles and a digest of its word sequence (b'' without words).

    With fewer words than ``size``, the whole sequence is the one shingle.
    """
    for _, _, data, off in slices(texts):
        data = FOLD[data]
        start, end, row = words(data, off, ~SPACE[data])
        h = word_hashes(data, start, end)
        m = max(0, len(h) - size + 1)
        run = np.zeros(m, np.uint64)
        for j in range(size):
            run = run * P + h[j : j + m]
        run = mix(run + np.uint64(size))
        bounds = np.searchsorted(row, np.arange(len(off)), "left")
        for i in range(len(off) - 1):
            a, b = bounds[i], bounds[i + 1]
            if a == b:
                yield np.zeros(0, np.uint64), b""
                continue
            if b - a >= size:
                found = np.unique(run[a : b - size + 1])
            else:
                one = np.uint64(0)
                with np.errstate(over="ignore"):
                    for x in h[a:b]:
                        one = one * P + x
                found = mix(np.array([one + np.uint64(b - a)], np.uint64))
            yield found, hashlib.blake2b(b" ".join(data[off[i] : off[i + 1]].tobytes().split()), digest_size=16).digest()


def signature(found: np.ndarray) -> np.ndarray:
    """Minima and then maxima of the set under each permutation, 32 bits each."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(PERMS, 2**32 - 1, np.uint32), np.zeros(PERMS, np.uint32)
    for a in range(0, len(x), 1024):
        y = FACTORS[:, None] * x[None, a : a + 1024] + SHIFTS[:, None]
        np.minimum(low, y.min(1), out=low)
        np.maximum(high, y.max(1), out=high)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * P + sig[SLOTS[:, j]].astype(np.uint64))
    return key


@lean
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, digest, keys, seen = [], [], [], {}
        for found, d in shingle_sets(batch.column(3)):
            size.append(len(found))
            digest.append(d or None)
            if d and d not in seen:
                seen[d] = band_keys(signature(found)).view(np.int64)
            keys.append(seen.get(d))
        offs = np.cumsum([0, *(0 if k is None else BANDS for k in keys)]).astype(np.int32)
        flat = np.concatenate([k for k in keys if k is not None]) if offs[-1] else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))], ["row", "id", "copy", "n", "digest", "bands"])


@lean
def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [found.tobytes() for found, _ in shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "shingles"])


def _confirm(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of one hub (role 0) and some members (role 1): the members that reach the share."""
    sets = [s for s, _ in shingle_sets(pa.array(group["text"]))]
    at = int(np.flatnonzero(group["role"].to_numpy() == 0)[0])
    hub, out = sets[at], []
    for i, (role, b) in enumerate(zip(group["role"], group["b"], strict=True)):
        if role:
            both = len(np.intersect1d(hub, sets[i], assume_unique=True))
            if both and SHARE[1] * both >= SHARE[0] * (len(hub) + len(sets[i]) - both):
                out.append(b)
    return pd.DataFrame({"a": np.full(len(out), group["a"].iloc[at], np.int64), "b": np.array(out, np.int64)})


def _tile(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of one tile of a bucket (role 0: minor members, 1: all): links between different components.

    Full sets are compared, as ``_confirm`` does. Of the links only those are given
    that join components which the ones before have not joined, so that a tile
    gives fewer links than it has components.
    """
    minor, rest = group[group["role"] == 0], group[group["role"] == 1]
    out: list[tuple[int, int]] = []
    if len(minor) and len(rest):
        sets = [np.frombuffer(x, np.uint64) for x in rest["shingles"]]
        size = np.array([len(x) for x in sets])
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.cumsum(size) - size
        ids, kinds = rest["id"].to_numpy(), {c: k for k, c in enumerate(sorted({*minor["comp"], *rest["comp"]}))}
        comp = np.array([kinds[c] for c in rest["comp"]])
        joined = np.arange(len(kinds))  # of each component, what it is joined with in this tile
        mark = np.zeros(len(values), np.int64)
        for i, c, x in zip(minor["id"].tolist(), minor["comp"], minor["shingles"], strict=True):
            own = np.frombuffer(x, np.uint64)
            at = np.minimum(np.searchsorted(values, own), len(values) - 1)
            at = at[values[at] == own]
            mark[at] = 1
            both = np.add.reduceat(mark[code], first)
            mark[at] = 0
            linked = (both > 0) & (SHARE[1] * both >= SHARE[0] * (len(own) + size - both))
            me = kinds[c]
            for j in np.flatnonzero(linked & (joined[comp] != joined[me])).tolist():
                if joined[comp[j]] != joined[me]:
                    joined[joined == joined[comp[j]]] = joined[me]
                    out.append((min(i, int(ids[j])), max(i, int(ids[j]))))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_shingles, component_id and kept, as op1's contract says.

    Steps: (1) signatures in one scan; rows with the same word sequence form a
    class, of which one row goes on as a node; (2) buckets of equal band keys,
    each member paired with the bucket's smallest node; (3) pairs confirmed on
    full sets, components; (4) in buckets that still hold several components,
    members outside the most frequent one are compared with all others by their
    shingles, in bounded tiles, and what links components is confirmed: a large
    bucket costs no pair within what is already connected, and no link is lost.

    Nulls: a null text has no words. Rows with a null id take part like all
    others; the smallest id of their component is theirs, or null. Rows that
    share an id count as one document, whatever their texts: what links one of
    them links the id. Empty texts are alone. Extra columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.col(f"`{text_col}`")
    # an id and a hash of the text name a text in docs; rows are numbered for good only once they are written
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    with Scratch(spark) as scratch:
        rows = texts.select(F.monotonically_increasing_id().alias("row"), "id", "copy", "text")
        signed = scratch.table(rows.mapInArrow(_signed, "row long, id long, copy long, n long, digest binary, bands array<long>"), "signed")
        worded = signed.where("digest is not null")
        # the bands go with the row that is chosen: dealt once, and of copies in one place once for all
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "copy", "bands")).alias("r")
        classes = scratch.table(worded.groupBy("digest").agg(first).select("digest", F.col("r.row").alias("node"), "r.id", "r.copy", "r.bands"), "classes")
        keyed = classes.select("node", F.explode("bands").alias("band"))
        buckets = keyed.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top").select(F.col("band").alias("__b"), "hub")
        members = scratch.table(keyed.join(buckets, F.col("band") == F.col("__b")).select("band", "hub", "node"), "members")
        pairs = scratch.table(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
        links = scratch.table(_confirmed(pairs, classes, texts, scratch, "star"), "links0")
        edges = links.union(_ties(worded, classes, scratch))
        found = scratch.table(components(edges, scratch, "cc-"), "comp")
        opened = _opened(members, found, scratch)
        if not opened.isEmpty():
            fresh = scratch.table(_linking(opened, classes, texts, scratch), "fresh")
            more = scratch.table(_confirmed(fresh, classes, texts, scratch, "rest"), "links1")
            if not more.isEmpty():
                found = scratch.table(components(edges.union(more), scratch, "cc1-"), "comp1")
        # each component's smallest id; classes without a link have their own
        ided = scratch.table(found.join(classes.select(F.col("node").alias("__n"), "id"), F.col("node") == F.col("__n")).select("node", "component", "id"), "ided")
        least = ided.groupBy(F.col("component").alias("c")).agg(F.min("id").alias("m"), F.count("*").alias("size"))
        large = least.where(F.col("size") > hub(ided.count())).select("c", F.struct("m").alias("hot"))
        marked = ided.join(F.broadcast(large), F.col("component") == F.col("c"), "left").drop("c")
        rest = marked.where("hot is null").join(least, F.col("component") == F.col("c")).select("node", "m")
        labels = marked.where("hot is not null").select("node", F.col("hot.m").alias("m")).union(rest).select(F.col("node").alias("__n"), "m", F.lit(True).alias("linked"))
        named = classes.join(labels, F.col("node") == F.col("__n"), "left").select(F.col("digest").alias("__d"), F.when(F.col("linked"), F.col("m")).otherwise(F.col("id")).alias("component"))
        named = scratch.table(named, "named")  # both sides of the next join are then dealt anew, and a class of many copies can be split
        out = signed.select("id", "n", "digest").join(named, F.col("digest") == F.col("__d"), "left")
        component = F.when(F.col("__d").isNotNull(), F.col("component")).otherwise(F.col("id"))
        return checkpoint(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")))


def _ties(worded: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges between the classes that one id's texts are in: the first of them and each other."""
    several = worded.where("id is not null").groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("id")
    several = scratch.table(several, "several")
    texts = worded.join(sent(several), "id", "left_semi").select("id", "digest").distinct()
    nodes = texts.join(classes.select("digest", "node"), "digest").select(F.col("id").alias("a"), F.col("node").alias("b"))
    nodes = scratch.table(nodes, "ties")
    tied, _ = nearest(nodes, hub(nodes.count()))  # an id may have a great many texts
    return tied.where("b <> m").select(F.col("m").alias("a"), "b")


def _picked(nodes: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, text) of the distinct materialised nodes."""
    wanted = scratch.table(classes.join(nodes, "node").select("node", F.col("id").alias("__i"), F.col("copy").alias("__c")), f"wanted-{name}")
    found = texts.join(sent(wanted), F.col("id").eqNullSafe(F.col("__i")) & (F.col("copy") == F.col("__c"))).select("node", "text")
    return found.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The materialised pairs (a, b) of nodes whose full shingle sets reach the share.

    A hub with many members is confirmed in chunks of some 256, fewer where its
    text is long, each with a copy of the hub's text, so that no group grows with
    the number of copies.
    """
    nodes = scratch.table(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), f"nodes-{name}")
    some = scratch.table(_picked(nodes, classes, texts, scratch, name), f"texts-{name}")
    counts = pairs.groupBy(F.col("a").alias("h")).agg(F.count("*").alias("count"))
    hubs = counts.join(some, F.col("h") == F.col("node")).select("h", "text", F.ceil(F.col("count") * F.greatest(F.lit(1 / 256), F.octet_length("text") / F.lit(2.0 * TILE_BYTES))).cast("int").alias("chunks"))
    several = scratch.table(hubs.where("chunks > 1").select(F.col("h").alias("__h"), "chunks"), f"hubs-{name}")
    dealt = pairs.join(sent(several), F.col("a") == F.col("__h"), "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("chunks")), F.lit(0)).cast("int").alias("chunk"))
    member = dealt.join(some, F.col("b") == F.col("node")).select("a", "chunk", "b", F.lit(1).alias("role"), "text")
    own = hubs.select(F.col("h").alias("a"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("h").alias("b"), F.lit(0).alias("role"), "text")
    return member.union(own).groupBy("a", "chunk").applyInPandas(_confirm, "a long, b long")


def _opened(members: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of the buckets that still hold several components; a bucket of two was settled by its one pair.

    Of buckets of the same members one is enough: two sums of hashes and the
    number of the members tell buckets apart.
    """
    tagged = members.join(found.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left").select("band", "node", F.coalesce("component", "node").alias("comp"))
    sums = [F.sum(F.xxhash64(F.col("node"), F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(2)]
    counts = tagged.groupBy("band", "comp").agg(F.count("*").alias("size"), *sums)
    mixed = counts.groupBy("band").agg(F.max(F.struct("size", "comp")).alias("top"), F.count("*").alias("kinds"), F.sum("size").alias("size"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1")).where("kinds > 1 and size > 2")
    mixed = mixed.groupBy("size", "s0", "s1").agg(F.min(F.struct("band", "top")).alias("b")).select(F.col("b.band").alias("__b"), F.col("b.top.comp").alias("major"))
    return scratch.table(tagged.join(mixed, F.col("band") == F.col("__b")).select("band", "node", "comp", "major"), "open")


def _linking(opened: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs to confirm between components that share a bucket; each minor member meets every other member of its bucket in one tile.

    Minor members are divided by their own number, so that a large bucket with
    few of them is sent about once.
    """
    nodes = scratch.table(opened.select("node").distinct(), "opennodes")
    sets = scratch.table(_picked(nodes, classes, texts, scratch, "open").mapInArrow(_listed, "id long, shingles binary"), "sets")
    members = opened.withColumnRenamed("node", "id").withColumn("minor", F.col("comp") != F.col("major"))
    weighed = members.join(sets.select("id", F.octet_length("shingles").alias("bytes")), "id")
    tiles = lambda which: F.greatest(F.ceil(F.greatest(F.sum(F.when(which, 1).otherwise(0)) / TILE, F.sum(F.when(which, F.col("bytes")).otherwise(0)) / TILE_BYTES)), F.lit(1)).cast("int")
    sizes = weighed.groupBy(F.col("band").alias("__b")).agg(tiles(F.col("minor")).alias("rows"), tiles(F.lit(True)).alias("cols"))
    members = members.join(sizes, F.col("band") == F.col("__b"))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = members.withColumn("i", every("rows")).withColumn("j", deal("cols")).withColumn("role", F.lit(1))
    minor = members.where("minor").withColumn("i", deal("rows")).withColumn("j", every("cols")).withColumn("role", F.lit(0))
    dealt = minor.unionByName(rest).select("band", "i", "j", "role", "id", "comp")
    return dealt.join(sets, "id").groupBy("band", "i", "j").applyInPandas(_tile, "a long, b long").distinct()
