import importlib.util

import pytest
from pyspark.sql import functions as F

from fragstream.llm import rollup
from fragstream.llm.manifest import Conflict, Manifests

CHANGES = "change string, source string, lang string, tokenizer string, tokens long, old_tokens long"


def totals(r, version=None):
    return {(x.source, x.lang, x.tokenizer): (x.n_docs, x.n_tokens) for x in r.totals(version).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return rollup.TokenRollup(spark, f"file://{tmp_path}/rollup")


def test_signed_changes_and_idempotent_batches(spark, store):
    made = lambda *rows: spark.createDataFrame(rows, CHANGES)
    assert totals(store) == {}
    assert store.commit("b1", made(("insert", "s", "en", "t1", 10, None), ("insert", "s", "en", "t1", 5, None), ("insert", None, None, "t1", 7, None)))
    assert totals(store) == {("s", "en", "t1"): (2, 15), (None, None, "t1"): (1, 7)}
    assert not store.commit("b1", made(("insert", "s", "en", "t1", 10, None)))
    assert store.commit("b2", made(("revise", "s", "en", "t1", 8, 10), ("delete", None, None, "t1", 7, None), ("insert", "s", "en", "t1", None, None)))
    assert totals(store) == {("s", "en", "t1"): (3, 13)} and len(totals(store, 1)) == 2
    store.fold()
    assert totals(store) == {("s", "en", "t1"): (3, 13)} and not store.commit("b2", made())
    assert store.commit("empty", made()) and totals(store) == {("s", "en", "t1"): (3, 13)}
    with pytest.raises(Exception, match="unknown change"):
        store.commit("bad", made(("upsert", "s", "en", "t1", 1, None)))
    assert totals(store) == {("s", "en", "t1"): (3, 13)}
    with pytest.raises(ValueError, match="batch id"):
        store.commit("../x", made())


def test_what_a_failed_commit_left_is_not_counted(spark, store):
    rows = spark.createDataFrame([("insert", "s", "en", "t", 3, None)], CHANGES)
    store._sums(rows).write.parquet(f"{store.path}/delta-b1")
    assert totals(store) == {} and store.commit("b1", rows) and totals(store) == {("s", "en", "t"): (1, 3)}


def test_a_late_attempt_changes_nothing(spark, store, monkeypatch):
    """Two writers commit one batch id with different rows: the second has looked before the first committed."""
    made = lambda n: spark.createDataFrame([("insert", "s", "en", "t", n, None)], CHANGES)
    late = rollup.TokenRollup(spark, store.path)
    sums = late._sums

    def slow(changes):
        assert store.commit("b", made(10))
        return sums(changes)

    monkeypatch.setattr(late, "_sums", slow)
    assert not late.commit("b", made(99)) and totals(store) == {("s", "en", "t"): (1, 10)}


def test_a_fold_keeps_batches_committed_meanwhile(spark, store, monkeypatch):
    made = lambda n: spark.createDataFrame([("insert", "s", "en", "t", n, None)], CHANGES)
    store.commit("a", made(1)), store.commit("b", made(2))
    other = rollup.TokenRollup(spark, store.path)
    before = store.totals

    def slow(version=None):
        got = before(version)
        other.commit("c", made(4))
        return got

    monkeypatch.setattr(store, "totals", slow)
    store.fold()
    assert totals(other) == {("s", "en", "t"): (3, 7)} and len(other.log.latest()[1]["tables"]) == 2


def test_the_query_deletes_and_revises(docs):
    """The registered result comes by way of wrong counts: without its last batches the totals differ."""
    rows = rollup.counted(docs).cache()
    changes = rollup.history(rows, 4)
    sums = lambda names: {tuple(r[:3]): (r.d, r.t) for r in _all(docs, changes, names)}
    assert sums(list(changes)) != sums([n for n in changes if n != "deleted"]) != sums([n for n in changes if n.startswith("load")])
    assert changes["revised"].count() > 0 and changes["deleted"].count() > 0


def _all(docs, changes, names):
    out = None
    for n in names:
        one = rollup.TokenRollup(docs.sparkSession, "file:///tmp/none")._sums(changes[n])
        out = one if out is None else out.unionByName(one)
    return out.groupBy(*rollup.KEYS).agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t")).collect()


def test_versions_are_taken_once(spark, tmp_path):
    log = Manifests(spark, f"file://{tmp_path}/m")
    log.commit(1, {"a": 1})
    with pytest.raises(Conflict):
        log.commit(1, {"a": 2})
    assert log.latest() == (1, {"a": 1})


def test_counts_of_all_rows(docs, corpus, none):
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.token_counts(docs).collect()}
    expected = {}
    for _, text, lang, source, _ in corpus:
        for t, n in (("words-1", len((text or "").split())), ("bytes-1", len((text or "").encode()))):
            d, k = expected.get((source, lang, t), (0, 0))
            expected[source, lang, t] = d + 1, k + n
    assert got == expected and rollup.token_counts(none).collect() == []


@pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no vocabulary files")
def test_byte_pairs(docs, corpus):
    import base64

    import public_tokenizers as p
    import tiktoken

    path = str(p.path("byte_bpe_50k.tiktoken"))
    got = sorted((r.doc_id or -1, r.tokens) for r in rollup.counted_by_bpe(docs, path, p.PATTERN, "bpe-1").collect())
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("x", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == sorted((r[0] or -1, len(coder.encode_ordinary(r[1] or ""))) for r in corpus)
