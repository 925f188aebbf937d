"""Exact top-k by inner product with a three-phase uniform threshold over slices of the dimensions.

A score is the sum of the local scores of SLICES groups of dimensions. Phase 1
gathers the heads of the local lists and takes, for each query, the k-th best of
their full scores: a cutoff that the true k-th best can't be below. Phase 2
broadcasts it; an entry can only reach it if one of its local scores reaches the
cutoff divided by the number of slices (uniform threshold), and only such
entries are collected. Phase 3 resolves their remaining scores exactly. While the
slices of a row are added up, what is left of it is bounded by the lengths of the
remaining parts; pairs that can't reach the cutoff any more are not read further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .bytesgrams import lean
from .common import Scratch, checkpoint

SLICES = 4
#: The vectors of the queries of one pass over all rows, which are collected and broadcast, take so many bytes at most.
QUERY_BYTES = 8 << 20
#: Scores held at a time in a task: rows are taken in runs of so many divided by the queries.
SCORES = 1 << 21
#: If fewer pairs than this share can still reach the cutoff, the next slice is read for them alone, so many components at a time.
SPARSE, GATHERED = 0.05, 1 << 21
LONG = 2**63 - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, vec): a number of its own, the id and the components as doubles of each row whose vector is finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    return good.select(F.monotonically_increasing_id().alias("row"), "id", "vec")


def quantised(x: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x): floats that hold integers, or, where a product would be beyond floats, integers without a bound."""
    with np.errstate(over="ignore"):
        out = np.floor(x * scale)
    if np.isfinite(out).all():
        return out
    return np.array([[int(np.floor(a * scale)) if abs(a) < 2.0**60 else int(a) * scale for a in row] for row in x.tolist()], object).reshape(x.shape)


def matrix(vecs: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` components; shorter vectors are filled with 0, longer ones meet no component of a query beyond ``dims``."""
    if isinstance(vecs, pa.ChunkedArray):
        vecs = vecs.combine_chunks()
    offs, flat = np.asarray(vecs.offsets), np.asarray(vecs.values)
    size = np.diff(offs)
    if len(size) and (size == dims).all():
        return flat[offs[0] : offs[-1]].reshape(-1, dims)
    out = np.zeros((len(size), dims), flat.dtype)
    for i, n in enumerate(size):
        out[i, : min(n, dims)] = flat[offs[i] : offs[i] + min(n, dims)]
    return out


def _largest(x: np.ndarray) -> int:
    return max(1, int(np.abs(x).max())) if x.size else 1


@dataclass(frozen=True)
class Queries:
    """Queries of one block: the number of each one's row, its id and its quantised vector."""

    row: np.ndarray
    id: np.ndarray
    vec: np.ndarray

    @property
    def cuts(self) -> list[tuple[int, int]]:
        dims = self.vec.shape[1]
        at = [dims * i // SLICES for i in range(SLICES + 1)]
        return list(zip(at, at[1:], strict=False))

    def mine(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, query) of the rows that are queries themselves; row numbers of queries are in order."""
        at = np.minimum(np.searchsorted(self.row, own), max(0, len(self.row) - 1))
        r = np.flatnonzero(self.row[at] == own)
        return r, at[r]

    def exact(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, queries) in a type in which every inner product is exact: floats where all sums fit 53 bits, else integers without a bound."""
        if _largest(rows) * _largest(self.vec) * max(1, self.vec.shape[1]) < 2**53:
            return rows.astype(np.float64), self.vec.astype(np.float64)
        whole = lambda x: np.array([[int(a) for a in r] for r in x.tolist()], object).reshape(x.shape)
        return whole(rows), whole(self.vec)

    def runs(self, batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, ids, vectors) of runs of rows."""
        step = max(1, SCORES // max(1, len(self.row)))
        for batch in batches:
            own, ids, vecs = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2), self.vec.shape[1])
            for a in range(0, len(own), step):
                yield own[a : a + step], ids[a : a + step], quantised(vecs[a : a + step], scale)


def best(query: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each query."""
    order = np.lexsort((-score.astype(np.float64), query))
    q = query[order]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


def heads(runs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], queries: Queries, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, full score) of the k best among the rows that head some local list: phase 1 over the rows of one task."""
    n = len(queries.row)
    held = [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries.cuts]
    level = np.full((SLICES, n), -np.inf)  # the k-th best local score so far
    found_q, found_s = np.zeros(0, np.int64), np.zeros(0)
    for own, _, vecs in runs:
        a, b = queries.exact(vecs)
        head = np.zeros((len(own), n), bool)
        mine = queries.mine(own)
        for i, (x, y) in enumerate(queries.cuts):
            s = (a[:, x:y] @ b[:, x:y].T).astype(np.float64) if y > x else np.zeros((len(a), n))
            s[mine] = -np.inf
            if np.isfinite(level[i]).all():
                r, q = np.nonzero(s > level[i])
            else:  # of the first rows the k best of each list
                at = min(k, len(s)) - 1
                r, q = np.nonzero((s >= -np.partition(-s, at, axis=0)[at]) & (s > level[i]))
            head[r, q] = True
            hq, hs = np.concatenate([held[i][0], q]), np.concatenate([held[i][1], s[r, q]])
            top = best(hq, hs, k)
            held[i] = hq[top], hs[top]
            full = np.bincount(hq[top], minlength=n) >= k
            low = np.full(n, np.inf)
            np.minimum.at(low, hq[top], hs[top])
            level[i] = np.where(full, low, -np.inf)
        r, q = np.nonzero(head)  # a row that heads several lists counts once
        found_q, found_s = np.concatenate([found_q, q]), np.concatenate([found_s, _pairs(a, b, r, q).astype(np.float64)])
        top = best(found_q, found_s, k)
        found_q, found_s = found_q[top], found_s[top]
    return found_q, found_s


def _pairs(a: np.ndarray, b: np.ndarray, r: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the given pairs of rows and queries, some at a time."""
    step = max(1, GATHERED // max(1, a.shape[1]))
    parts = [(a[r[i : i + step]] * b[q[i : i + step]]).sum(1) for i in range(0, len(r), step)]
    return np.concatenate(parts) if parts else np.zeros(0, a.dtype)


def reaching(vecs: np.ndarray, own: np.ndarray, queries: Queries, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, query, score) of all pairs whose score reaches the query's cutoff, and how many (pair, slice) scores were made: phases 2 and 3."""
    a, b = queries.exact(vecs)
    other = np.ones((len(a), len(b)), bool)
    other[queries.mine(own)] = False
    if a.dtype == object:  # beyond 53 bits nothing is left out early
        total = a @ b.T
        r, q = np.nonzero((total.astype(np.float64) >= cut) & other)
        return r, q, total[r, q], total.size * SLICES
    # the length of what is left of each vector after each slice
    rest = lambda x: [np.sqrt((x[:, y:] ** 2).sum(1)) * (1 + 1e-9) for _, y in queries.cuts]
    rest_a, rest_b = rest(a), rest(b)
    total, enough, made = np.zeros((len(a), len(b))), np.zeros((len(a), len(b)), bool), 0
    for i, (x, y) in enumerate(queries.cuts):
        s = a[:, x:y] @ b[:, x:y].T
        made += s.size
        total += s
        enough |= s >= cut / SLICES
        alive = (total + rest_a[i][:, None] * rest_b[i][None, :] + 1 >= cut) & other
        if i + 1 < SLICES and alive.mean() < SPARSE:
            r, q = np.nonzero(alive)
            score, passed = total[r, q], enough[r, q]
            for u, v in queries.cuts[i + 1 :]:
                s = _pairs(a[:, u:v], b[:, u:v], r, q)
                made += len(s)
                score, passed = score + s, passed | (s >= cut[q] / SLICES)
            ok = passed & (score >= cut[q])
            return r[ok], q[ok], score[ok], made
    r, q = np.nonzero(alive & enough & (total >= cut))
    return r, q, total[r, q], made


def order_key(score: int) -> str:
    """A text that sorts as the score does, however large it is."""
    if score >= 0:
        digits = str(score)
        return f"1{len(digits):04}{digits}"
    digits = str(-score)
    return f"0{9999 - len(digits):04}" + "".join(str(9 - int(c)) for c in digits) + "a"


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, id, score): the k best rows for each query, as op10's contract says.

    ``is_query`` is a condition on the column ``id``. Equal scores rank by the
    smaller id; a query with fewer other rows gets all of them. Null vectors and
    those with null or non-finite components take no part, nor do null ids. Rows
    that share an id are rows of their own: each is a candidate for all other
    rows, and each that is a query has ranks of its own. Missing components count
    as 0. Scores rank by their exact value; one beyond a long is given as the
    nearest long. Extra columns are not read. No rows, or no queries, give an
    empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    with Scratch(spark) as scratch:
        rows = scratch.table(usable(vectors, id_col, vector_col), "rows")
        asked = scratch.table(rows.where(is_query), "queries")
        n, width = asked.agg(F.count("*"), F.max(F.size("vec"))).first()
        blocks = -(-n * 8 * max(1, width or 1) // query_bytes)
        found = [_one_block(rows, asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b), k, scratch, b, scale) for b in range(blocks)]
        if not found:
            return checkpoint(spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long"))
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("key"), "vec_id"))
        top = out.withColumn("rank", rank).where(F.col("rank") <= k)
        return checkpoint(top.select("query_id", "rank", F.col("vec_id").alias(id_col), "score"))


def _one_block(rows: DataFrame, asked: DataFrame, k: int, scratch: Scratch, number: int, scale: int) -> DataFrame:
    """Candidates (row, query_id, vec_id, score, key) of one block of queries: all that reach the cutoff, so at least the k best."""
    spark = rows.sparkSession
    got = sorted((r["row"], r["id"], r["vec"]) for r in asked.collect())  # about QUERY_BYTES
    dims = max(1, max((len(v) for _, _, v in got), default=0))
    vec = quantised(matrix(pa.array([v for _, _, v in got], pa.list_(pa.float64())), dims), scale)
    shared = spark.sparkContext.broadcast(Queries(np.array([r for r, _, _ in got], np.int64), np.array([i for _, i, _ in got], np.int64), vec))

    @lean
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        q, s = heads(queries.runs(batches, scale), queries, k)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(s)], ["query", "score"])

    @lean
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, cut = shared.value, cutoffs.value
        for own, ids, vecs in queries.runs(batches, scale):
            r, q, score, _ = reaching(vecs, own, queries, cut)
            whole = [int(x) for x in score]
            near = [max(-LONG - 1, min(LONG, x)) for x in whole]
            yield pa.RecordBatch.from_arrays([pa.array(queries.row[q]), pa.array(queries.id[q]), pa.array(ids[r]), pa.array(near, pa.int64()), pa.array([order_key(x) for x in whole], pa.string())], ["row", "query_id", "vec_id", "score", "key"])

    lists = rows.mapInArrow(first, "query long, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    kth = lists.withColumn("place", place).where(F.col("place") == k).select("query", "score")
    level = dict((r[0], r[1]) for r in kth.collect())  # a number a query of the block
    # a little lower where floats round
    cut = np.array([level.get(i, -np.inf) for i in range(len(got))])
    cutoffs = spark.sparkContext.broadcast(np.where(np.abs(cut) < 2.0**53, cut, cut - np.abs(cut) * 1e-9))
    return scratch.table(rows.mapInArrow(entries, "row long, query_id long, vec_id long, score long, key string"), f"found{number}")


ORACLE_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.r <> q.r),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""
