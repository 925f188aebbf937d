import os

import duckdb
import pytest

from fragstream.plans import catalogue

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    own = [tuple(map(str, r)) for r in got.select(*sorted(got.columns)).collect()]
    found = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    order = [columns.index(c) for c in sorted(columns)]
    assert sorted(own) == sorted(tuple(str(r[i]) for i in order) for r in found.fetchall())


def test_entry_and_names(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
