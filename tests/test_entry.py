"""Driver contract and a DuckDB differential run of every query with a twin at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["row_type", "label", "precision", "recall", "f1_score", "support"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 85


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    a = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in sdf.collect()), key=repr)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in sorted(dcols)]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b
    from tools.oracle_check import type_mismatches

    assert type_mismatches(sdf, con, E.oracle_sql()[name]) == []


PLAIN = [q for q in E.queries() if q != "pipeline" and not q.startswith("op")]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(set(PLAIN) - {"sweep_regularisation", "train_text_classifier"}))
def test_plan_has_no_cross_join_or_row_udf(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, (name, op)
