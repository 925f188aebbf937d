import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from fragstream.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score double"


def brute(rows, is_query, k=5):
    vec = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vec.append((i, [math.floor(256 * Fraction(float(np.float32(x)))) for x in v]))
    out = []
    for a, (q, x) in enumerate(vec):
        if is_query(q):
            best = sorted((-sum(u * v for u, v in zip(x, y, strict=False)), i) for b, (i, y) in enumerate(vec) if a != b)[:k]
            out += [(q, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(best)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.0) for i, v in rows], SCHEMA).repartition(3)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [1 << 20, 200])
def test_equals_brute_force_with_ties_and_odd_rows(spark, seed, block):
    rng = random.Random(seed)
    vec = lambda: [rng.choice((-1.0, -0.5, 0.0, 0.25, 0.5, 1.0)) for _ in range(6)]
    rows = [(i, vec()) for i in range(400)] + [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (None, vec()), (1200, [0.5, 0.5]), (1250, []), (7, vec()), (50, vec()), (1300, [1.0] * 9)]
    got = result(topk.top_k(made(spark, rows), "id % 50 = 0", query_bytes=block))
    assert got == brute(rows, lambda q: q % 50 == 0)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [-3.0, 0.0])]
    assert result(topk.top_k(made(spark, rows), "id % 50 = 0")) == [(0, 1, 1, 196608), (0, 2, 2, -196608)]
    assert result(topk.top_k(made(spark, rows[:1]), "id % 50 = 0")) == []
    assert result(topk.top_k(made(spark, []), "id % 50 = 0")) == []


def test_large_components_stay_exact(spark):
    queries = topk.Queries(np.array([0]), np.array([0]), np.array([[2.0**40, 1.0]]))
    r, q, score, _ = topk.reaching(np.array([[2.0**40, 1.0], [2.0**41, 0.0]]), np.array([0, 1]), queries, np.array([-np.inf]))
    assert (r.tolist(), q.tolist(), [int(x) for x in score]) == ([1], [0], [2**81])
    small = [(0, [1e6, 1.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0])]
    assert result(topk.top_k(made(spark, small), "id = 0")) == brute(small, lambda q: q == 0)


def test_huge_finite_components_rank_by_their_exact_scores(spark):
    rows = [(0, [3e38, 3e38]), (1, [3e38, 1.0]), (2, [3e38, 2e38]), (3, [-3e38, -3e38]), (4, [3e38, 1.0]), (50, [1.0, -3e38]), (5, [0.5, 0.25])]
    got = result(topk.top_k(made(spark, rows), "id % 50 = 0"))
    assert got == brute(rows, lambda q: q % 50 == 0)
    assert [r[2] for r in got if r[0] == 0][:2] == [2, 1] and got[0][3] == 2**63 - 1  # beyond a long, still in order


def test_keys_sort_as_scores_do():
    scores = [0, 1, 9, 10, 99, 2**63, 2**200, -1, -9, -10, -99, -(2**63), -(2**200)]
    assert sorted(scores) == sorted(scores, key=topk.order_key)


def test_the_cutoff_spares_work():
    """Rows in clusters: phase 1 gives a cutoff, and few pairs are read to their last slice; none that reaches it is lost."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 64))
    vecs = np.floor(256 * (centres[rng.integers(40, size=3000)] + 0.1 * rng.standard_normal((3000, 64))))
    own = np.arange(3000)
    queries = topk.Queries(own[::50], own[::50], vecs[::50])
    q, s = topk.heads(iter([(own[a : a + 500], own[a : a + 500], vecs[a : a + 500]) for a in range(0, 3000, 500)]), queries, 5)
    full = vecs @ vecs[::50].T
    full[own[::50], np.arange(60)] = -np.inf
    kth = -np.sort(-full, axis=0)[4]
    cut = np.array([np.sort(s[q == i])[::-1][4] for i in range(60)])
    assert (cut <= kth).all() and np.isfinite(cut).all() and (cut == kth).mean() > 0.3
    r, c, score, made_ = topk.reaching(vecs, own, queries, cut)
    assert set(zip(r.tolist(), c.tolist(), strict=True)) == set(map(tuple, np.argwhere(full >= cut).tolist()))
    assert made_ < 0.6 * full.size * topk.SLICES


def test_matrix_pads_and_cuts():
    got = topk.matrix(pa.array([[1, 2, 3], [4], []], pa.list_(pa.int64())), 2)
    assert got.tolist() == [[1, 2], [4, 0], [0, 0]]
