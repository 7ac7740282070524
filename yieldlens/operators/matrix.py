"""Click-to-purchase matrices as edge lists: session counts (CPS), shares, and utility weights (WHUOM)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldlens.operators.skew import is_small, split_join


def session_items(events: DataFrame, name: str = "item_id") -> DataFrame:
    """Each item of a session once."""
    return events.select("session_id", F.col("item_id").alias(name)).distinct()


def cps(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    """In how many sessions an item was clicked and another (or the same) one bought."""
    clicked = session_items(clicks, "click_item")
    bought = session_items(purchases, "purchase_item")
    return (
        split_join(clicked, bought, ["session_id"], ["click_item"], ["purchase_item"])
        .groupBy("click_item", "purchase_item")
        .agg(F.count("*").alias("cps"))
    )


def _with_sessions(counts: DataFrame, clicks: DataFrame) -> DataFrame:
    """Add ``sessions``, the number of sessions that clicked the clicked item."""
    sessions = session_items(clicks, "click_item").groupBy("click_item").agg(F.count("*").alias("sessions"))
    return split_join(counts, sessions, ["click_item"], ["purchase_item"])


def cps_probability(counts: DataFrame, clicks: DataFrame) -> DataFrame:
    """P(Buy|Click): of the sessions that clicked an item, the share that bought the other one."""
    return _with_sessions(counts, clicks).select(
        "click_item", "purchase_item", "cps", (F.col("cps") / F.col("sessions")).alias("probability")
    )


def _weighted(counts: DataFrame, items: DataFrame, max_items: int | None) -> DataFrame:
    """Counts of pairs with the utility of the bought item, where it is positive."""
    sold = items.filter(F.col("utility") > 0).select(F.col("item_id").alias("purchase_item"), "utility")
    if is_small(max_items):
        return counts.join(F.broadcast(sold), "purchase_item")
    return split_join(counts, sold, ["purchase_item"], ["click_item"])


def whuom(counts: DataFrame, items: DataFrame, max_items: int | None = None) -> DataFrame:
    """CPS times the utility of the bought item, for pairs whose weight is positive.

    ``max_items`` is a proven bound on the rows of ``items``, if there is one.
    """
    return _weighted(counts, items, max_items).select(
        "click_item", "purchase_item", (F.col("cps") * F.col("utility")).alias("weight")
    )


def whuom_left(counts: DataFrame, items: DataFrame) -> DataFrame:
    """The same matrix in its outer form: items without a utility count as zero and drop out after."""
    sold = items.select(F.col("item_id").alias("purchase_item"), "utility")
    joined = split_join(counts, sold, ["purchase_item"], ["click_item"], how="left")
    filled = joined.withColumn("utility", F.coalesce("utility", F.lit(0)))
    return filled.select(
        "click_item", "purchase_item", (F.col("cps") * F.col("utility")).alias("weight")
    ).filter(F.col("weight") > 0)


def whuom_log(counts: DataFrame, items: DataFrame, max_items: int | None = None) -> DataFrame:
    """Damped form ln(CPS) x utility; a pair seen in one session has weight zero and drops out."""
    return _weighted(counts.filter(F.col("cps") > 1), items, max_items).select(
        "click_item", "purchase_item", (F.log("cps") * F.col("utility").cast("double")).alias("weight")
    )


def profit_edges(
    counts: DataFrame, clicks: DataFrame, items: DataFrame, max_items: int | None = None
) -> DataFrame:
    """WHUOM weight and expected gain, P(Buy|Click) times utility, of every weighted pair."""
    # An amount of money: divided as a decimal, to six places.
    gain = (F.col("cps") * F.col("utility") / F.col("sessions")).cast("decimal(28,6)")
    return _weighted(_with_sessions(counts, clicks), items, max_items).select(
        "click_item", "purchase_item", (F.col("cps") * F.col("utility")).alias("weight"), gain.alias("gain")
    )


def purchases_of(purchases: DataFrame, items: DataFrame, max_items: int | None = None) -> DataFrame:
    """The purchases of the given items, of which each is listed once."""
    wanted = items.select("item_id")
    if is_small(max_items):
        return purchases.join(F.broadcast(wanted), "item_id", "left_semi")
    return split_join(purchases, wanted, ["item_id"], ["session_id"])


def utility_matrix(
    clicks: DataFrame, purchases: DataFrame, items: DataFrame, max_items: int | None = None
) -> DataFrame:
    """WHUOM straight from the events.

    Only purchases of ``items`` can get a weight, so the others are left out before the sessions
    are joined instead of after their pairs have been counted.
    """
    gainful = items.filter(F.col("utility") > 0)
    return whuom(cps(clicks, purchases_of(purchases, gainful, max_items)), gainful, max_items)
