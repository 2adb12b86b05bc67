"""Every query of the folder runs, and those with SQL give its rows."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerfold.llm.oracle import ORACLE
from ledgerfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_are_those_of_the_sql(spark, duck, name):
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    want = Counter(map(repr, result.fetchall()))
    df = QUERIES[name](spark, SF)
    assert set(df.columns) == set(names)
    assert Counter(repr(tuple(r)) for r in df.select(*names).collect()) == want
