"""Every registered query with SQL beside it, against DuckDB on the smallest tables; plans without Python where none is needed."""

from __future__ import annotations

import math

import duckdb
import pytest

from promolake.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
PYTHON = {"q_fuzzy_dupes", "q_html_blocks", "q_html_cards", "q_stream_state", "q_stream_lifetimes", "q_dashboard_html"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return "" if v is None else f"{v:.6g}" if type(v).__name__ == "Decimal" else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, got), rows(names, want.fetchall())
    assert len(a) == len(b)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SF).collect()) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_plan_stays_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_entry_module():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.queries())
