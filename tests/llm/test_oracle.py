"""Queries that SQL can express against DuckDB, on whole tables, and what is
registered."""

import os
from collections import Counter

import pytest

from varlake.llm import queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(queries.oracles()[name])
    at = [[d[0] for d in want.description].index(c) for c in columns]
    assert len(at) == len(want.description)
    rows = Counter(tuple(r[i] for i in at) for r in want.fetchall())
    assert Counter(tuple(r) for r in df.select(columns).collect()) == rows


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(entry.oracle_sql()) <= set(names)
