from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fragstream.llm import mixing
from fragstream.llm.common import Scratch


def filled(sources, total, epochs=3):
    """Water-filling by hand: clamp what is above, share the rest again."""
    target, open_ = {}, dict(sources)
    while open_:
        rest, weight = total - sum(target.values()), sum(w for _, w in open_.values())
        over = {k: s for k, (s, w) in open_.items() if rest * w / weight > epochs * s}
        if not over:
            return target | {k: rest * w / weight for k, (_, w) in open_.items()}
        for k, s in over.items():
            target[k] = epochs * s
            del open_[k]
    return target


@pytest.mark.parametrize(("sources", "total"), [
    ({"a": (100, 5), "b": (100, 2), "c": (100, 1)}, 300),
    ({"a": (1, 5), "b": (1000, 2), "c": (10, 1), "d": (0, 5)}, 1011),
    ({"a": (7, 1)}, 7),
    ({"a": (1, 1), "b": (1, 1)}, 100),
])
def test_water_filling(spark, sources, total):
    df = spark.createDataFrame([(k, float(w), s) for k, (s, w) in sources.items()], "key string, weight double, source_size long")
    got = {r.key: r.target for r in mixing.water_fill(df, float(total)).collect()}
    assert got == pytest.approx(filled(sources, total))


def test_mixture_meets_targets(docs, corpus, none):
    got = mixing.mixture_of(docs).collect()
    size = lambda t: len((t or "").split())
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((d or -1, size(t)) for d, t, *_ in corpus)
    sizes = defaultdict(int)
    for _, t, _, s, _ in corpus:
        sizes[s] += size(t)
    order = sorted((s for s in sizes if s is not None)) + [None]
    goal = filled({s: (sizes[s], (5, 2, 1)[i % 3]) for i, s in enumerate(order)}, sum(sizes.values()))
    source = {d: s for d, _, _, s, _ in corpus}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture_of(docs.repartition(5)).collect()))
    assert mixing.mixture_of(none).collect() == []


def test_mixed_rows_hold_the_words_taken(docs, none):
    plan = mixing.mixture_of(docs).collect()
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    words = defaultdict(int)
    for r in got.select("doc_id", "text").collect():
        words[r.doc_id] += len((r.text or "").split())
    taken = defaultdict(int)
    for r in plan:
        taken[r.doc_id] += r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix(none).count() == 0


def test_a_cut_document_keeps_its_white_space(spark):
    text = "  one\ttwo\n\nthree   four "
    df = spark.createDataFrame([(text, n) for n in range(1, 5)], "t string, n int")
    got = [r[0] for r in df.orderBy("n").select(mixing._leading(F.col("t"), F.col("n"))).collect()]
    assert got == ["  one", "  one\ttwo", "  one\ttwo\n\nthree", "  one\ttwo\n\nthree   four"]


def test_rows_without_an_id_are_spread(spark):
    df = spark.createDataFrame([(None, f"text {i}", "a") for i in range(50)], "doc_id long, text string, source string")
    assert mixing.sized(df, "doc_id", "text", "source").select("__h").distinct().count() == 50
    got = mixing.mixture_of(df, total=51.0).collect()
    assert sum(r.taken for r in got) == 51 and sorted(r.taken for r in got)[-1] <= 2


def test_a_plan_is_small(spark, docs):
    with Scratch(spark) as scratch:
        rows = scratch.table(mixing.sized(docs.select("doc_id", "text", "source"), "doc_id", "text", "source"), "s")
        assert mixing.plan_mixture(rows, scratch).sources.count() == docs.select("source").distinct().count()
