"""Every registered query beside its SQL, and what its plan must and must not contain."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from check import TABLES, plain
from tests.conftest import SMALL
from yieldlens.operators import skew
from yieldlens.operators.recommend import recommend


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


OWN = registry._own_queries()


def test_every_query_has_its_sql():
    assert set(OWN) == set(registry.ORACLE_SQL)


@pytest.mark.parametrize("hot_floor", [skew.HOT_FLOOR, 30])
@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, db, name, hot_floor, monkeypatch):
    """As it is, and with every key of more than thirty rows taken for hot."""
    monkeypatch.setattr(skew, "HOT_FLOOR", hot_floor)
    df = registry.queries()[name](spark, SMALL)
    mine, theirs = plain(df.toPandas()), plain(db.execute(registry.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(mine, theirs, check_exact=True, check_dtype=False)
    plan = df._jdf.queryExecution().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert costly not in plan


def test_flagship_has_rows(spark):
    df = registry.entry(spark)
    assert df.columns == ["session_id", "rank", "item_id", "score"] and df.count() > 0


def test_scans_read_few_columns_and_push_filters_down(spark):
    plan = registry.queries()["item_utility"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,p" in plan
    assert "event_id" not in plan


def test_scores_need_no_shuffle_after_the_clicks_have_multiplied(spark):
    plan = registry.queries()["recommend_topk"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    after, before = plan.split("BroadcastHashJoin", 1)
    assert "Exchange" not in after and "WindowGroupLimit" in after
    assert "Exchange hashpartitioning(session_id" in before


def test_without_a_count_top_k_is_cut_before_the_shuffle(spark):
    edges = spark.range(9).selectExpr("id AS click_item", "id % 3 AS purchase_item", "id AS weight")
    clicks = spark.range(50).selectExpr("id % 7 AS session_id", "id % 9 AS click_item")
    plan = recommend(clicks, edges, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "salt" in plan
