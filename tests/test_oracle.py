"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF001
from liftlens.plans.catalog import QUERIES

TABLES = ["events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(se.queries())
    assert set(QUERIES) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF001)
    rel = con.sql(se.oracle_sql()[name])
    cols = sorted(sdf.columns)
    assert cols == sorted(rel.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    idx = [rel.columns.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert _sorted(srows) == _sorted(drows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("experiment_key", "string"), ("variant", "string"), ("exposed_users", "bigint"),
        ("converters", "bigint"), ("conversion_rate", "double"), ("total_revenue", "double"),
        ("revenue_per_user", "double"), ("absolute_lift", "double"),
        ("relative_lift_pct", "double"), ("rpu_lift", "double"), ("z_score", "double"),
        ("p_value", "double")]
    assert df.count() == 6
