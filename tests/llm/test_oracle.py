"""The registered queries of the subpackage, and the SQL of those that have it."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from liftlens.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    names = sorted(rel.columns)
    expected = [tuple(r[rel.columns.index(c)] for c in names) for r in rel.fetchall()]
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == names
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == sorted(expected)
