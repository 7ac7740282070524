"""Row counts, popularity, quantiles and histograms of the input tables."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType
from pyspark.sql.window import Window as W

from yieldlens.functions.columns import equal_width_bin
from yieldlens.plans.checkpoints import use_checkpoints

# The sketch for a quantile errs by at most one in ACCURACY of all rows; the bracket leaves SLACK times as much on both
# sides. FEW values may be put in order in one place.
ACCURACY, SLACK, FEW = 10_000, 3, 5000


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its number of rows."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in tables.items()
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionAll(more)
    return out


def item_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("item_id").agg(F.count("*").alias("events"))


def top_items_by_count(events: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent items; the smaller id wins a tie."""
    return item_counts(events).orderBy(F.col("events").desc(), F.col("item_id").asc()).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Each value with its number of rows. What follows works on this, usually far smaller, table.

    The test on the count is always true; it keeps the count in every use, so that all uses share
    one scan and one shuffle.
    """
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    return values.groupBy("value").agg(F.count("*").alias("n")).filter(F.col("n") > 0)


def _as_double(value: Column, kind: DataType) -> Column:
    """A double that never falls where the value rises; NaN, the largest of all, counts as infinity."""
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(F.isnan(value), F.lit(math.inf)).otherwise(value.cast("double"))
    return value.cast("double")


def _order(value: object) -> tuple[bool, object]:
    nan = isinstance(value, float) and math.isnan(value)
    return nan, 0 if nan else value


def quantile(df: DataFrame, column: str, fraction: str = "0.95") -> DataFrame:
    """Exact quantile with linear interpolation, as one row with column ``quantile``; NULL without values.

    Two passes over the data, whatever they are. A mergeable sketch with a sure bound on the error of its ranks gives
    two values that the wanted ranks lie between. The second pass counts what lies below and above, and how often each
    value in between occurs; of those there are at most 2 * SLACK / ACCURACY of all rows. If they are FEW they are put in
    order on the spot, else by ranges over many tasks. Values are in Spark's order, infinities and NaN last.
    """
    place_of = Decimal(fraction)
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    kind, spark = values.schema["value"].dataType, df.sparkSession
    double = _as_double(F.col("value"), kind)
    around = [float(min(1, max(0, place_of + step * SLACK / Decimal(ACCURACY)))) for step in (-1, 1)]
    n, span = values.agg(F.count("*"), F.percentile_approx(double, around, ACCURACY)).first()
    if not n:
        return spark.range(1).select(F.lit(None).cast(kind).alias("quantile"))
    zone = F.when(double < span[0], -1).when(double > span[1], 1).otherwise(0)
    within = F.when(zone == 0, F.col("value"))
    counts = values.groupBy(zone.alias("zone"), within.alias("inside")).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    place = (n - 1) * place_of
    rank = int(place)
    if 2 * SLACK * n <= FEW * ACCURACY:
        found = _at_ranks(counts.collect(), rank)
    else:
        use_checkpoints(spark)
        found = _at_ranks(_near(counts.checkpoint(), rank), rank)
    low, high = (F.lit(v).cast(kind) for v in found)
    share = place - rank
    # Between equal values nothing is to be computed, which infinities would not stand.
    whole = not share or _order(found[0]) == _order(found[1])
    return spark.range(1).select((low if whole else low + (high - low) * F.lit(share)).alias("quantile"))


def _at_ranks(rows: list[Row], rank: int) -> tuple[object, object]:
    """The values at ``rank`` and behind it, from rows (n, low, high) that do not overlap: a value, or what lies below or above."""
    before, values = 0, []
    for row in sorted(rows, key=lambda r: (r.zone, _order(r.low))):
        # Of a stretch only the ends are known: its last value, and its first.
        for at in (rank, rank + 1):
            if before <= at < before + row.n:
                if at != before and at != before + row.n - 1 and _order(row.low) != _order(row.high):
                    raise AssertionError("the sketch's bound does not hold the rank")
                values.append(row.low if at == before else row.high)
        before += row.n
    return values[0], values[-1]


def _near(counts: DataFrame, rank: int) -> list[Row]:
    """``counts`` with every stretch of values far from ``rank`` as one row: values are dealt by ranges and summed there."""
    dealt = counts.repartitionByRange("zone", "inside").withColumn("part", F.spark_partition_id()).checkpoint()
    sums = (F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    parts = dealt.groupBy("part", "zone").agg(*sums).collect()
    before, near = 0, set()
    for row in sorted(parts, key=lambda r: (r.zone, r.part)):
        if before <= rank + 1 and rank < before + row.n:
            near.add((row.part, row.zone))
        before += row.n
    found, ahead = [], 0
    for row in sorted(parts, key=lambda r: (r.zone, r.part)):
        if (row.part, row.zone) not in near or row.zone:
            found.append(row)
        else:
            # One range, in order: only the rows at the ranks come back, the others as what is before and behind them.
            here = dealt.filter((F.col("part") == row.part) & (F.col("zone") == row.zone))
            until = F.sum("n").over(W.partitionBy("part").orderBy("inside")) + ahead
            side = F.when(until <= rank, -1).when(until - F.col("n") > rank + 1, 1).otherwise(0)
            marked = here.withColumn("until", until).withColumn("side", side)
            found += marked.groupBy(F.lit(0).alias("zone"), "side", F.when(F.col("side") == 0, F.col("inside"))).agg(*sums).collect()
        ahead += row.n
    return found


def trim_outliers(df: DataFrame, column: str = "price", fraction: str = "0.95") -> DataFrame:
    """Rows whose value lies strictly below the quantile."""
    return df.filter(F.col(column) < quantile(df, column, fraction).scalar())


def histogram(df: DataFrame, column: str = "price", bins: int = 20, fraction: str | None = "0.95") -> DataFrame:
    """Rows per equal-width bin, right-closed, over the values left by the trim; empty bins included."""
    counts = value_counts(df, column)
    if fraction is not None:
        # Tied to the count, the condition stays above the shared scan.
        below = F.col("value") < quantile(df, column, fraction).scalar()
        counts = counts.filter(F.when(F.col("n") > 0, below))
    low = counts.agg(F.min("value").alias("low")).scalar()
    high = counts.agg(F.max("value").alias("high")).scalar()
    filled = counts.groupBy(equal_width_bin(F.col("value"), low, high, bins).alias("bin")).agg(F.sum("n").alias("rows"))
    spark = df.sparkSession
    every = spark.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        F.col("bin").cast("bigint").alias("bin"), F.coalesce("rows", F.lit(0)).alias("rows")
    ).orderBy("bin")


def conversion(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    """Purchases per click, and the share of sessions that bought something."""
    both = clicks.select("session_id", F.lit(0).alias("bought")).unionAll(
        purchases.select("session_id", F.lit(1).alias("bought"))
    )
    sessions = both.groupBy("session_id").agg(F.count("*").alias("events"), F.sum("bought").alias("bought"))
    return sessions.agg(
        F.sum(F.col("events") - F.col("bought")).alias("clicks"),
        F.sum("bought").alias("purchases"),
        F.count("*").alias("sessions"),
        F.count_if(F.col("bought") > 0).alias("buying_sessions"),
    ).select(
        "*",
        F.try_divide("purchases", "clicks").alias("buy_click_ratio"),
        F.try_divide("buying_sessions", "sessions").alias("buying_session_ratio"),
    )


def popularity_share(events: DataFrame, top: str = "0.2") -> DataFrame:
    """What share of all events falls on the most frequent items, the best ``top`` part of them.

    Only how many items have which count matters, so items with equal counts are taken together.
    Distinct counts add up to no more than the events: N events give fewer than sqrt(2N) of them,
    few enough to be put in order by one task.
    """
    by_count = item_counts(events).groupBy("events").agg(F.count("*").alias("items"))
    above = W.orderBy(F.col("events").desc()).rowsBetween(W.unboundedPreceding, -1)
    taken = (
        by_count.withColumn("before", F.coalesce(F.sum("items").over(above), F.lit(0)))
        .withColumn("top_items", F.ceil(F.sum("items").over(W.partitionBy()) * F.lit(Decimal(top))))
        .withColumn("taken", F.greatest(F.lit(0), F.least("items", F.col("top_items") - F.col("before"))))
    )
    return taken.agg(
        F.sum("items").alias("items"),
        F.sum("taken").cast("bigint").alias("top_items"),
        F.sum(F.col("items") * F.col("events")).alias("events"),
        F.sum(F.col("taken") * F.col("events")).cast("bigint").alias("top_events"),
    ).select("*", F.try_divide("top_events", "events").alias("top_share"))
