"""Every query against its SQL on the smallest tables; the two wide tables only at the scale their SQL is written for."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from driver import queries as catalog
from threadtables.session import scratch, stage

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
OTHER_SCALE = {"wide_reviews"}
NAMES = {q.__name__ for q in catalog.ALL}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert NAMES <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(NAMES - OTHER_SCALE))
def test_query_matches_sql(spark, tables, name):
    result = entry.queries()[name](spark, DATA)
    columns = sorted(result.columns)
    answer = tables.execute(entry.oracle_sql()[name])
    order = [d[0] for d in answer.description]
    assert sorted(order) == columns
    expected = Counter(repr(tuple(row[order.index(c)] for c in columns)) for row in answer.fetchall())
    found = Counter(repr(tuple(row)) for row in result.select(*[f"`{c}`" for c in columns]).collect())
    assert found and found == expected


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


def test_scratch_leaves_what_is_kept_to_the_one_around_it(spark):
    path = lambda table: table.inputFiles()[0].rsplit("/", 1)[0]
    columns = lambda *paths: [spark.read.parquet(p).columns for p in paths]
    with scratch(spark):
        with scratch(spark):
            inner, kept = path(stage(spark.range(3), "inner")), path(stage(spark.range(3), "kept", keep=True))
        assert columns(inner, kept) == [["empty"], ["id"]]
        free = stage(spark.range(3), "free", keep=True)
    assert columns(kept, path(free)) == [["empty"], ["id"]]
