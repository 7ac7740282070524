"""Utilities of sessions and items, and high-utility items, global or shard by shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.functions.threshold import MinUtility
from yieldlens.operators.skew import key_counts, split_join


def session_utility(purchases: DataFrame) -> DataFrame:
    """Everything spent in a session."""
    return purchases.groupBy("session_id").agg(F.sum("utility").alias("utility"))


def item_utility(purchases: DataFrame) -> DataFrame:
    """Everything spent on an item; repeated purchases in a session all count."""
    return purchases.groupBy("item_id").agg(F.sum("utility").alias("utility"))


def _session_weights(purchases: DataFrame, hot: bool = True) -> tuple[DataFrame, DataFrame]:
    """Per session and item what was spent on it, beside the session's total; and the totals alone.

    ``hot`` says whether some session may be hot; if none is, a window over the session will do.
    """
    # Sums of utilities always exist. Testing them, here and below, keeps Spark from pruning them in
    # some of the uses of a table, so that all uses stay alike and the table is computed once.
    own = purchases.groupBy("session_id", "item_id").agg(F.sum("utility").alias("own"))
    own = own.filter(F.col("own").isNotNull())
    totals = key_counts(own, ["session_id"], F.sum("own").alias("total")).filter(F.col("total").isNotNull())
    if hot:
        weights = split_join(own, totals.drop("hot_rows"), ["session_id"], ["item_id"], counts=totals)
    else:
        weights = own.withColumn("total", F.sum("own").over(W.partitionBy("session_id")))
    return weights, totals


def swu(purchases: DataFrame) -> DataFrame:
    """Sequence-weighted utility of an item: the totals of the sessions that hold it, each once."""
    weights, _ = _session_weights(purchases)
    return weights.groupBy("item_id").agg(F.sum("total").alias("swu"))


def promising_items(purchases: DataFrame, min_utility: MinUtility, hot: bool = True) -> DataFrame:
    """Items that may appear in a high-utility pattern: SWU at or above the threshold."""
    weights, totals = _session_weights(purchases, hot)
    items = weights.groupBy("item_id").agg(F.sum("total").alias("swu"))
    return items.filter(F.col("swu") >= min_utility.column(totals, "total"))


def _reject_negative(amount: Column, lowest: Column) -> Column:
    return F.when(lowest < 0, F.raise_error(F.lit("negative utility"))).otherwise(amount)


def high_utility_items(purchases: DataFrame, min_utility: MinUtility, nonnegative: bool = False) -> DataFrame:
    """Items whose SWU and utility over all sessions reach the threshold.

    With utilities that are never negative an item's SWU is at least its utility, so the SWU rule
    removes nothing; ``nonnegative`` then saves the shuffle by session. A negative utility found
    under that promise fails the query.
    """
    if not nonnegative:
        return high_utility_items_by_shard(purchases, min_utility, shards=1)
    # The lowest first, as in the test below: aggregates in one order let Spark share the shuffle.
    items = (
        purchases.groupBy("item_id")
        .agg(F.min("utility").alias("lowest"), F.sum("utility").alias("utility"))
        .select("item_id", _reject_negative(F.col("utility"), F.col("lowest")).alias("utility"))
    )
    return items.filter(F.col("utility") >= min_utility.column(items))


def high_utility_items_by_shard(
    purchases: DataFrame, min_utility: MinUtility, shards: int, merge: str = "max"
) -> DataFrame:
    """High-utility items found separately in each shard of sessions, merged by ``max`` or ``sum``.

    A session belongs to shard ``session_id mod shards``. Both tests, SWU and utility, look at one
    shard only, so an item can be lost that reaches the threshold overall; one shard is exact.
    """
    merges = {"max": F.max, "sum": F.sum}
    weights, totals = _session_weights(purchases)
    local = (
        weights.groupBy(F.pmod("session_id", F.lit(shards)).alias("shard"), "item_id")
        .agg(F.sum("total").alias("swu"), F.sum("own").alias("utility"))
    )
    threshold = min_utility.column(totals, "total")
    return (
        local.filter((F.col("swu") >= threshold) & (F.col("utility") >= threshold))
        .groupBy("item_id")
        .agg(merges[merge]("utility").alias("utility"))
    )
