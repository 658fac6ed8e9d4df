"""Every registered query with an oracle: Spark result == DuckDB SQL result (sf0.001)."""

import math

import pytest

import __spark_entry__ as E

SF_SMALL = "/root/testdata/sf0.001"

ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_entry():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 80


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, rows) == _canon(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLES) - set(E.LLM_QUERIES)))
def test_query_without_oracle_runs(spark, name):
    """Queries that SQL cannot express run too (what they return is checked where their operator is)."""
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = {r["metric"]: r["value"] for r in df.collect()}
    assert df.columns == ["metric", "value"]
    assert set(got) == {"n_test", "accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "auc_roc"}
    assert 0.0 <= got["accuracy"] <= 1.0 and got["n_test"] > 0
