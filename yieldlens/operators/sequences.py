"""Event sequences per session and the frequent patterns in them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.functions.columns import singletons
from yieldlens.operators.skew import hot_groups, is_small, ordered, semi_join, split_join
from yieldlens.plans.checkpoints import use_checkpoints

# Loaded clicks and purchases have nothing finer than time to order them by; the item breaks ties.
ORDER = ("ts", "item_id")
PART_ROWS = 100_000


def _lists(rows: DataFrame, keys: list[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct(*order, F.struct(*payload).alias("entry"))))
    return rows.groupBy(*keys).agg(F.transform(entries, lambda e: e["entry"]).alias("entries"))


def session_lists(
    events: DataFrame, order: Sequence[str], payload: Sequence[str], part_rows: int = PART_ROWS
) -> DataFrame:
    """The events of a session in order, as arrays of structs of the ``payload`` columns.

    Part n of a session holds its events from n * ``part_rows`` on, at most that many. So no array grows
    without bound, and what a session's rows are depends on its own events alone. The first ``order`` column
    is a timestamp. Events that agree on all of them follow by payload.
    """
    columns = list(dict.fromkeys([*order, *payload]))
    events = events.select("session_id", *columns)
    placed = ordered(events, "session_id", columns, hot_groups(events, "session_id"))
    part = F.floor((F.col("pos") - 1) / F.lit(part_rows)).cast("bigint")
    return _lists(placed.withColumn("part", part), ["session_id", "part"], ["pos"], payload)


def click_sequences(
    clicks: DataFrame, order: Sequence[str] = ORDER, part_rows: int = PART_ROWS
) -> DataFrame:
    """Clicked items of a session in order, plain and as a sequence of one-item itemsets."""
    items = F.col("entries.item_id")
    return session_lists(clicks, order, ["item_id"], part_rows).select(
        "session_id", "part", items.alias("items"), singletons(items).alias("sequence")
    )


def purchase_sequences(
    purchases: DataFrame, order: Sequence[str] = ORDER, part_rows: int = PART_ROWS
) -> DataFrame:
    """Purchases of a session in order, as (item, utility) pairs."""
    return session_lists(purchases, order, ["item_id", "utility"], part_rows).withColumnRenamed("entries", "purchases")


def occurrences(placed: DataFrame, split: bool) -> DataFrame:
    """Where each item of a session stands: ``session_id``, ``item_id``, and ``places`` in order.

    A row's places all lie within the same PART_ROWS places of the session, so no array grows without bound; ``before`` is
    the item's last place ahead of them, 0 if there is none. ``split`` says whether a session may have more places.
    """
    part = F.floor((F.col("pos") - 1) / F.lit(PART_ROWS)) if split else F.lit(0)
    listed = placed.groupBy("session_id", "item_id", part.alias("part")).agg(F.array_sort(F.collect_list("pos")).alias("places"))
    if not split:
        return listed.select("session_id", "item_id", "places", F.lit(0).cast("bigint").alias("before"))
    # One row per PART_ROWS places at most.
    along = W.partitionBy("session_id", "item_id").orderBy("part")
    return listed.select("session_id", "item_id", "places", F.coalesce(F.lag(F.get("places", F.size("places") - 1)).over(along), F.lit(0)).alias("before"))


def first_behind(places: Column, done: Column) -> Column:
    """The first of the ordered ``places`` behind ``done``; there must be one. Long arrays are searched by halving."""
    few = F.get(F.filter(places, lambda p: p > done), F.lit(0))

    def halved(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        behind = F.get(places, middle) > done
        narrower = F.struct(F.when(behind, span["low"]).otherwise(middle + 1).alias("low"), F.when(behind, middle).otherwise(span["high"]).alias("high"))
        return F.when(span["low"] < span["high"], narrower).otherwise(span)

    whole = F.struct(F.lit(0).alias("low"), (F.size(places) - 1).alias("high"))
    # PART_ROWS has 17 bits.
    found = F.aggregate(F.sequence(F.lit(0), F.lit(PART_ROWS.bit_length())), whole, halved)
    return F.when(F.size(places) <= 32, few).otherwise(F.get(places, found["low"]))


def frequent_sequences(
    events: DataFrame,
    min_support: float = 0.1,
    max_pattern_length: int = 5,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Item sequences found in at least ``min_support`` of the sessions, with the number of those.

    The answer is PrefixSpan's for sequences of one-item itemsets, grown level by level. Of a pattern in a
    session only the earliest place where it is complete matters: an item extends the pattern there if it
    occurs behind that place. So the state is one row per pattern and session, and what it is joined with is
    an index of one row per session and distinct item, whose ordered places are searched for the first behind
    the pattern: the work follows the distinct items of a session, not its events, and an extension is one row
    without any grouping. Items that no frequent pair joins to the pattern's items are not tried. Patterns and
    items of a hot session are spread over tasks. The loop fetches counts but no rows.
    """
    use_checkpoints(events.sparkSession)
    order = list(dict.fromkeys([*order, "item_id"]))
    present = events.select("session_id", "item_id").distinct()
    # The library's own rounding: the smallest whole number of sessions not below the share.
    least = math.ceil(min_support * present.select("session_id").distinct().count())

    # While it grows a sequence is a row of item columns, which group and join faster than arrays.
    def columns(length: int) -> list[str]:
        return [f"i{n}" for n in range(1, length + 1)]

    def frequent(state: DataFrame, length: int) -> DataFrame:
        counted = state.groupBy(*columns(length)).agg(F.count("*").alias("freq"))
        return counted.filter(F.col("freq") >= least).checkpoint()

    items = present.groupBy("item_id").agg(F.count("*").alias("freq")).filter(F.col("freq") >= least)
    items = items.select("item_id").checkpoint()
    rows = events.select("session_id", *order)
    kept = semi_join(rows, ["item_id"], items, items.count(), order)
    hot = hot_groups(kept, "session_id").checkpoint()
    split = not hot.isEmpty()
    # The places count frequent items only, which leaves their order as it is.
    placed = ordered(kept, "session_id", order, hot if split else None)
    index = occurrences(placed, split).checkpoint()
    state = index.filter("before = 0").select("session_id", F.col("item_id").alias("i1"), F.get("places", F.lit(0)).alias("done"))
    found = [frequent(state, 1)]
    pairs, few_pairs = None, False
    for length in range(2, max_pattern_length + 1):
        before = columns(length - 1)
        if not (size := found[-1].count()):
            break
        if length == 3:
            pairs, few_pairs = found[-1], is_small(size)
        kept = semi_join(state, before, found[-1].select(*before), size, ["session_id"])
        joined = split_join(index, kept, ["session_id"], ["item_id"], before) if split else index.join(kept, "session_id")
        # The one row of an item whose places begin before the first that is behind the pattern, and reach there.
        tried = joined.filter((F.col("before") <= F.col("done")) & (F.get("places", F.size("places") - 1) > F.col("done")))
        if few_pairs:
            for item in before:
                allowed = F.broadcast(pairs.select(F.col("i1").alias(item), F.col("i2").alias("item_id")))
                tried = tried.join(allowed, [item, "item_id"], "left_semi")
        state = tried.select(
            "session_id", *before, F.col("item_id").alias(f"i{length}"), first_behind(F.col("places"), F.col("done")).alias("done")
        )
        # The last level is read once, for its counts.
        state = state if length == max_pattern_length else state.checkpoint()
        found.append(frequent(state, length))
    out = None
    for length, level in enumerate(found, start=1):
        named = level.select(F.array(*[F.array(c) for c in columns(length)]).alias("sequence"), "freq")
        out = named if out is None else out.unionAll(named)
    return out
