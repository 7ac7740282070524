"""Registered queries beside their SQL."""

from __future__ import annotations

import pandas as pd
import pytest

from check import plain
from tests.conftest import SMALL
from yieldlens.llm import queries as q


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = q.queries()[name](spark, SMALL)
    mine, theirs = plain(df.toPandas()), plain(db.execute(q.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(mine, theirs, check_exact=True, check_dtype=False)


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op2_quality_rules"])
def test_native_plans_hold_no_python(spark, name):
    plan = q.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    for node in ("Python", "InArrow", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
