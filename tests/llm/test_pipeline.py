import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fragstream.llm import common, queries

from .test_decontaminate import brute as contamination
from .test_minhash import brute as classes

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "minhash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]
    after = [docs]
    for name, stage in corpus_pipeline.STAGES:
        after.append(common.checkpoint(stage(spark, after[-1], SF)))
        if name != "sharding":
            assert after[-1].columns == docs.columns, name
    rows = [[(r.doc_id, r.text) for r in df.collect()] for df in after]
    assert set(rows[1]) <= set(rows[0])
    kept = classes(rows[1])
    assert sorted(rows[2]) == sorted(r for r in rows[1] if kept[r[0]] == r[0])
    assert sorted(rows[3]) == sorted(r for r in rows[2] if not contamination(r[1], items)[4])
    taken = Counter(i for i, _ in rows[4])
    assert set(taken) <= {i for i, _ in rows[3]} and max(taken.values()) <= 3
    sizes, got = defaultdict(int), defaultdict(int)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for i, t in rows[3]:
        sizes[source[i]] += len(words(t))
    for i, t in rows[4]:
        got[source[i]] += len(words(t))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    assert sorted(rows[5]) == sorted(rows[4])


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.checkpoint(stage(spark, docs, SF))
    rows = lambda df: sorted(map(str, df.select("doc_id", "text", "lang", "source", "n_chars").collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(docs)


def test_stages_take_odd_rows(spark, docs):
    odd = docs
    for name, stage in corpus_pipeline.STAGES:
        odd = common.checkpoint(stage(spark, odd, SF))
        if name != "sharding":
            assert odd.columns == docs.columns
    none = docs.where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        none = common.checkpoint(stage(spark, none, SF))
    assert none.count() == 0


def test_rows_with_null_or_repeated_ids_leave_one_row_a_group(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near = lambda t: t + " more"
    rows = [(None, a), (7, near(a)), (5, a), (None, near(b)), (None, b), (3, c), (3, c), (3, d), (9, near(d)), (None, None), (None, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `a.b` string").repartition(3)
    got = corpus_pipeline.distinct(spark, docs, SF)
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    of_b = [r for r in left if r in ((None, b), (None, near(b)))]
    assert len(of_b) == 1
    assert Counter(r for r in left if r not in of_b) == Counter([(5, a), (3, c), (3, d), (None, None), (None, ""), (4, "")])


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.oracle_sql()) <= set(names)
