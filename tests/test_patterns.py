"""High-utility sequences: what they read, and that amounts count alike as whole units and as decimals."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from yieldlens.functions.threshold import MinUtility
from yieldlens.operators import patterns

MODES = [{"singletons": True}, {"singletons": False, "order": ["ts"]}]


def _rows(seed, n=300):
    draw = random.Random(seed)
    return [(draw.randrange(40), draw.randrange(5), draw.randrange(6), draw.randrange(1, 900)) for _ in range(n)]


def _found(df, how, least=MinUtility.of_share("0.02")):
    found = patterns.high_utility_sequences(df, least, 3, **how)
    assert dict(found.dtypes)["utility"] == "decimal(38,6)"
    return {str(r.pattern): r.utility for r in found.collect()}


@pytest.mark.parametrize("how", MODES)
def test_purchases_are_read_once(spark, tables, how):
    read = spark.sparkContext.accumulator(0)

    def seen(item):
        read.add(1)
        return item

    counted = F.udf(seen, "bigint").asNondeterministic()
    rows = _rows(1)
    purchases = tables.purchases(rows).withColumn("item_id", counted("item_id"))
    assert _found(purchases, how)
    assert read.value == len(rows)


@pytest.mark.parametrize("how", MODES)
def test_amounts_count_alike_as_units_and_as_decimals(tables, how):
    purchases = tables.purchases([(s, t, i, Decimal(u) / 100) for s, t, i, u in _rows(2)])
    # Amounts with more digits, or too large for a long, are no units.
    fine = purchases.withColumn("utility", F.col("utility").cast("decimal(24,8)"))
    large = purchases.withColumn("utility", (F.col("utility") * F.lit(10**15)).cast("decimal(28,2)"))
    found = _found(purchases, how)
    assert len(found) > 50 and any(k.count("[") > 2 or "," in k for k in found)
    assert _found(fine, how) == found
    assert _found(large, how) == {k: u * 10**15 for k, u in found.items()}
    assert _found(purchases, how, MinUtility.of_amount("12.345")) == _found(fine, how, MinUtility.of_amount("12.345"))
