"""Every deterministic registered query equals its DuckDB oracle (smallest scale), and its
physical plan has no cartesian product, nested-loop join or Python UDF."""

import pytest

from tests.compare import compare_one, duck
from tests.conftest import SF_SMALL

from __spark_entry__ import oracle_sql, queries
from stratum.plans.catalog import QUERIES as CORE

SQL = oracle_sql()
Q = queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_is_registered_with_sql_or_is_trained():
    trained = {"logreg_sgd", "score_batch", "logreg_partial", "random_forest", "logreg_balanced", "logreg_text",
               "gbt", "fraud_pipeline", "sink_model", "sink_report"}
    assert set(CORE) - set(SQL) == trained


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = Q[name](spark, SF_SMALL)
    plan = _plan(df)
    assert not [b for b in FORBIDDEN if b in plan], plan
    ok, rows, _, _, msg = compare_one(spark, con, name, lambda s, d: df, SQL[name], SF_SMALL)
    assert ok, msg


def test_range_filters_reach_the_scan(spark):
    plan = _plan(Q["scan_range"](spark, "/root/testdata/sf0.01"))  # offsets lie inside this table
    assert "GreaterThanOrEqual(event_id,2000)" in plan and "LessThan(event_id,7000)" in plan


def test_projection_prunes_columns(spark):
    plan = _plan(Q["scan_project"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,value:double,props:string>" in plan


def test_nb_scoring_does_not_join_back(spark):
    assert "SortMergeJoin" not in _plan(Q["nb_score"](spark, SF_SMALL))
