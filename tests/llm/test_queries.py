"""Every registered query runs whole tables; those with SQL equal it."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.llm import queries as Q

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_names_and_registration():
    names = sorted(Q.all_queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert {*names, "pipeline"} <= set(E.queries())
    assert set(Q.all_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.all_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(Q.all_sql()[name])
    df = Q.all_queries()[name](spark, SF_SMALL)
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    at = [rel.columns.index(c) for c in order]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*order).collect()), key=repr) == want
