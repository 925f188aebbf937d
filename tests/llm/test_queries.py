import os

import duckdb
import pytest

from fragstream.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    found = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(str(r[i]) for i in order) for r in found.fetchall())


def test_shards_of_the_query_hold_all_documents(spark):
    """The contract's digest: every document once, shards of the size and rows they say."""
    got = queries.queries()["op6_sharding"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    rows = got.groupBy("shard", "shard_bytes", "shard_rows").count().collect()
    assert all(r["count"] == r.shard_rows and r.shard_bytes > 0 for r in rows) and len({r.shard for r in rows}) == len(rows)
