"""High-utility sequential patterns of any length.

A pattern is a sequence of itemsets. In a session it is worth the most that any one of its matches
is worth, and over all sessions the sum of that. (A one-item pattern so takes the best of several
purchases in a session, whereas ``high_utility_items`` adds them up.)
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import Window as W

from yieldlens.functions.threshold import MinUtility
from yieldlens.operators.skew import earlier_max, hot_groups, is_hot, key_counts, never_hot, ordered, semi_join, split_join
from yieldlens.operators.utility import promising_items
from yieldlens.plans.checkpoints import use_checkpoints

# One bit of a long per item.
MAX_LENGTH = 60
AMOUNT = "decimal(38,6)"
DIGITS = 6


def _columns(length: int) -> list[str]:
    """The columns that hold a pattern of ``length`` items while it grows.

    ``i1`` .. ``iN`` are its items in order; bit n of ``shape`` says that item n+1 opens an itemset.
    Numbers group, join and sort much faster than nested arrays.
    """
    return ["shape", *[f"i{n}" for n in range(1, length + 1)]]


def _as_arrays(length: int) -> Column:
    """A pattern's columns as an array of itemsets: the items cut where ``shape`` says one opens."""
    places = range(1, length + 1)
    items = F.array(*[f"i{n}" for n in places])
    opened = [F.when(F.col("shape").bitwiseAND(F.lit(1 << (n - 1)).cast("bigint")) != 0, F.lit(n)) for n in places]
    opens = F.array_compact(F.array(*opened))

    def itemset(place: Column, number: Column) -> Column:
        end = F.coalesce(F.get(opens, number + 1), F.lit(length + 1))
        return F.slice(items, place, end - place)

    return F.transform(opens, itemset)


def _unit(amounts: DataFrame, total: Decimal | None) -> int | None:
    """The digits of a whole number of which all amounts ``u`` are made, if such numbers in a long hold what patterns add up to.

    No sum exceeds the total, and no bound the most of one item MAX_LENGTH times. Longs are added, compared and moved
    several times as fast as decimals.
    """
    kind = amounts.schema["u"].dataType
    if not isinstance(kind, DecimalType) or kind.scale > DIGITS:
        return None
    return kind.scale if (total or 0) * 10**kind.scale * MAX_LENGTH < 2**63 else None


def _in_units(amount: Column, digits: int | None) -> Column:
    """The amount as a whole number of units, or as it is without ``digits``."""
    return amount if digits is None else (amount * F.lit(10**digits)).cast("bigint")


def _amount(units: Column, digits: int | None) -> Column:
    """The amount that so many units make."""
    return units.cast(AMOUNT) if digits is None else (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(AMOUNT)


def _pattern_events(
    purchases: DataFrame, min_utility: MinUtility, order: Sequence[str], singletons: bool
) -> tuple[DataFrame, Column, bool, int | None]:
    """Purchases of promising items with their place and what the session still holds behind them.

    Also the threshold as a number, whether there is a hot session, and the digits of ``_unit``, in which amounts and
    threshold are given. The purchases are read once and stored; the items are found from them as they come, and only what is
    left of these is brought into order and stored.
    """
    places = [c for c in (order if singletons else order[:1]) if c != "item_id"]
    amount = F.when(F.col("utility") < 0, F.raise_error(F.lit("negative utility"))).otherwise(F.col("utility"))
    purchases = purchases.select("session_id", "item_id", *places, amount.alias("u")).checkpoint()
    sessions = key_counts(purchases, ["session_id"], F.sum("u").alias("total"))
    rows, most, total = sessions.agg(F.sum("hot_rows"), F.max("hot_rows"), F.sum("total")).first()
    if min_utility.share is not None:
        min_utility = MinUtility.of_amount((total or 0) * min_utility.share)
    digits = _unit(purchases, total)
    purchases = purchases.withColumn("u", _in_units(F.col("u"), digits))
    least = min_utility.amount if digits is None else min_utility.amount * 10**digits
    # So few rows of a session make no hot group, whatever is left of the table: all below groups by session and more.
    tame = never_hot(most)
    spent = purchases.withColumnRenamed("u", "utility")
    spent = spent.repartition("session_id") if tame else spent
    promising = promising_items(spent, MinUtility(amount=least), hot=is_hot(most, rows)).select("item_id").checkpoint()
    purchases = semi_join(purchases, ["item_id"], promising, promising.count(), ["session_id", *places])
    purchases = purchases.repartition("session_id") if tame else purchases
    if singletons:
        # Purchases alike in everything stay apart, as numbered copies.
        alike = purchases.groupBy("session_id", "item_id", *places, "u").agg(F.count("*").alias("copies"))
        events = alike.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
        total_order = [*dict.fromkeys([*order, "item_id"]), "u", "copy"]
    else:
        # Several purchases of an item in an itemset are one event.
        events = purchases.groupBy("session_id", "item_id", *places).agg(F.sum("u").alias("u"))
        total_order = [*places, "item_id"]
    hot = None if tame else hot_groups(events, "session_id").checkpoint()
    split = not tame and not hot.isEmpty()
    instant = None if singletons else places
    placed = ordered(events, "session_id", total_order, hot if split else None, "u", instant).select(
        "session_id", "block", "pos", "item_id", "u", "rest", "peak"
    )
    return placed.checkpoint(), F.lit(least), split, digits


def _gain(more: int, kind: str) -> Column:
    """The most that ``more`` further items can add to a match; NULL where nothing lies behind it.

    They cannot add more than all that lies behind, nor more than so many times the largest of it.
    The latter keeps the bound tight in long sessions.
    """
    return F.least(F.col("rest"), F.col("peak") * F.lit(more)).cast(kind)


def _latest_best(events: DataFrame) -> DataFrame:
    """Events worth more than every later one of the same item in the session.

    At the end of a pattern no other event of an item can be in the best match.
    """
    turned = events.withColumns({"back": -F.col("pos"), "block": -F.col("block")})
    marked = earlier_max(turned, ["session_id", "item_id"], "back", "u", split=True)
    best = marked.filter(F.col("earlier").isNull() | (F.col("u") > F.col("earlier")))
    return best.withColumn("block", -F.col("block")).select(events.columns)


def _worth(matches: DataFrame, pattern: list[str]) -> DataFrame:
    """Utility of each pattern, and the most that any of its extensions can reach.

    A match with nothing behind it, where ``gain`` is NULL, has no extension and adds nothing to the
    bound.
    """
    per_session = matches.groupBy("session_id", *pattern).agg(
        F.max("best").alias("best"), F.max(F.col("best") + F.col("gain")).alias("bound")
    )
    return per_session.groupBy(*pattern).agg(F.sum("best").alias("utility"), F.sum("bound").alias("bound"))


def _state(matches: DataFrame, pattern: list[str], singletons: bool, split: bool) -> DataFrame:
    """The matches that extensions can build on; ``record`` says which of them a later itemset can.

    A match that ends no earlier than another of the same pattern and session, and is worth no
    more, never leads to a better match by a later itemset. So only records of the running maximum
    serve for that, each for the places behind it up to ``until``, where the next record is.
    Widening the last itemset needs every match, at its own place ``since``.
    """
    group = ["session_id", *pattern]
    whole = W.partitionBy(*group)
    marked = (
        earlier_max(matches, group, "pos", "best", split)
        .withColumn("record", F.col("earlier").isNull() | (F.col("best") > F.col("earlier")))
        .drop("earlier", "block")
    )
    if singletons:
        marked = marked.filter("record").withColumn("until", F.lead("pos").over(whole.orderBy("pos")))
    else:
        # Records are few even in a hot session.
        following = F.lead("pos").over(whole.orderBy("pos"))
        ends = marked.filter("record").select(*group, "pos", following.alias("until"))
        marked = marked.join(ends, [*group, "pos"], "left")
    return marked.withColumnRenamed("pos", "since")


def _state_with_worth(matches: DataFrame, pattern: list[str], singletons: bool) -> DataFrame:
    """The same where no session is hot, and beside the last match of a pattern in a session, which ``top`` marks, what all tell.

    These are the most that one is worth (``top``), the most that an extension can reach (``bound``), and the place of the
    first (``first``). One sort serves all: by the session first, as rows come from the join that made them, and whose bytes
    tell most rows apart; no two matches of a pattern end at one place.
    """
    along = W.partitionBy("session_id", *pattern).orderBy("pos")
    before, until_here = (along.rowsBetween(W.unboundedPreceding, end) for end in (-1, 0))
    spec = f"OVER (PARTITION BY session_id, {', '.join(pattern)} ORDER BY pos)"
    marked = matches.withColumns(
        {
            "earlier": F.max("best").over(before),
            "ahead": F.max(F.col("best") + F.col("gain")).over(until_here),
            "first": F.min("pos").over(until_here),
            "last": F.lead("pos").over(along).isNull(),
        }
    ).withColumn("record", F.col("earlier").isNull() | (F.col("best") > F.col("earlier")))
    marked = marked.withColumn("until", F.expr(f"lead(if(record, pos, NULL)) IGNORE NULLS {spec}"))
    if singletons:
        marked = marked.filter("record OR last")
    told = {"top": F.greatest("earlier", "best"), "bound": F.col("ahead"), "first": F.col("first")}
    kept = [F.when(F.col("last"), value).alias(name) for name, value in told.items()]
    return marked.select(*pattern, "session_id", F.col("pos").alias("since"), "best", "gain", "record", "until", *kept)


def _worthy(state: DataFrame, last: DataFrame, least: Column, pattern: list[str], singletons: bool, split: bool) -> DataFrame:
    """Patterns with the next items that may pay: ``pattern`` and ``item_id``.

    What a pattern and an item can lead to in a session is at most what the pattern can lead to there, and nothing where
    the item does not occur from the first match on. Summed over sessions that bounds every pattern that goes on with the
    item, before any of its matches is made: this joins a pattern's sessions with their distinct items only.
    """
    if split:
        reach = state.groupBy(*pattern, "session_id").agg(
            F.max(F.col("best") + F.col("gain")).alias("bound"), F.min("since").alias("first")
        )
    else:
        reach = state.select(*pattern, "session_id", "bound", "first")
    reach = reach.filter("bound IS NOT NULL")
    both = split_join(reach, last, ["session_id"], pattern, ["item_id"]) if split else reach.join(last, "session_id")
    here = F.col("last") > F.col("first") if singletons else F.col("last") >= F.col("first")
    bounds = both.filter(here).groupBy(*pattern, "item_id").agg(F.sum("bound").alias("bound"))
    return bounds.filter(F.col("bound") >= least).select(*pattern, "item_id")


def _extended(
    state: DataFrame, events: DataFrame, worthy: DataFrame, length: int, more: int, singletons: bool, split: bool, kind: str
) -> DataFrame:
    """Matches of all patterns longer by one item: in a later itemset, or in the last one.

    ``more`` is the number of items that may still follow; only ``worthy`` pairs of pattern and item are made. Without
    a hot session one join by session does both, and what follows groups by session and more, so the matches need not
    be shuffled again.
    """
    pattern = _columns(length)
    serves = F.col("until").isNull() | (F.col("pos") <= F.col("until"))
    later = F.col("record") & (F.col("pos") > F.col("since")) & serves
    wider = (F.col("pos") == F.col("since")) & (F.col("item_id") > F.col(f"i{length}"))
    if not split:
        joined = events.join(state, "session_id").filter(later if singletons else later | wider)
    else:
        records = state.filter("record")
        useful = events if more else _latest_best(events)
        joined = split_join(useful, records, ["session_id"], ["pos", "item_id"], [*pattern, "since"]).filter(later)
        if not singletons:
            here = state.withColumn("pos", F.col("since"))
            beside = split_join(here, events, ["session_id", "pos"], pattern, ["item_id"]).filter(wider)
            joined = joined.unionByName(beside)
    joined = semi_join(joined, [*pattern, "item_id"], worthy, worthy.count(), ["session_id", "pos"])
    opened = F.col("shape").bitwiseOR(F.lit(1 << length).cast("bigint"))
    return joined.select(
        F.when(F.col("pos") > F.col("since"), opened).otherwise(F.col("shape")).alias("shape"),
        *pattern[1:],
        F.col("item_id").alias(f"i{length + 1}"),
        "session_id",
        "block",
        "pos",
        (F.col("best") + F.col("u")).cast(kind).alias("best"),
        _gain(more, kind).alias("gain"),
    )


def high_utility_sequences(
    purchases: DataFrame,
    min_utility: MinUtility,
    max_length: int = 3,
    order: Sequence[str] = ("ts", "item_id"),
    singletons: bool = True,
) -> DataFrame:
    """All patterns of up to ``max_length`` items whose utility reaches the threshold.

    With ``singletons`` every purchase is an itemset of its own, ordered by the ``order`` columns and
    then by item; otherwise purchases at the same time, the first of them, form one itemset.

    Patterns grow level by level. Which items a pattern may go on with is told by a bound that is summed
    before any match of the longer pattern is made. What those matches add up to tells which patterns are valuable
    and which are worth extending: those whose bound reaches the threshold, which loses nothing. Matches that may be
    extended are stored, as a checkpoint, and made only once; where a session is hot they are first only aggregated,
    and then made again for the latter patterns. Those of the last level are aggregated only.
    The loop fetches row counts but no rows.
    """
    if not 1 <= max_length <= MAX_LENGTH:
        raise ValueError(f"max_length must lie between 1 and {MAX_LENGTH}")
    use_checkpoints(purchases.sparkSession)
    purchases = purchases.select(*dict.fromkeys(["session_id", "item_id", *order, "utility"]))
    events, least, split, digits = _pattern_events(purchases, min_utility, order, singletons)
    kind = AMOUNT if digits is None else "bigint"
    matches = events.select(
        F.lit(1).cast("bigint").alias("shape"),
        F.col("item_id").alias("i1"),
        "session_id",
        "block",
        "pos",
        F.col("u").cast(kind).alias("best"),
        _gain(max_length - 1, kind).alias("gain"),
    )
    if split:
        last = events.groupBy("session_id", "item_id").agg(F.max("pos").alias("last")).checkpoint() if max_length > 1 else None
    else:
        last = events.select("session_id", "item_id", "pos").repartition("session_id")
        last = last.groupBy("session_id", "item_id").agg(F.max("pos").alias("last"))
    found = []
    for length in range(1, max_length + 1):
        pattern = _columns(length)
        if split or length == max_length:
            worth = _worth(matches, pattern).checkpoint()
        else:
            state = _state_with_worth(matches, pattern, singletons).checkpoint()
            tops = state.filter("top IS NOT NULL").groupBy(*pattern)
            worth = tops.agg(F.sum("top").alias("utility"), F.sum("bound").alias("bound")).checkpoint()
        valuable = worth.filter(F.col("utility") >= least)
        found.append(valuable.select(_as_arrays(length).alias("pattern"), _amount(F.col("utility"), digits).alias("utility")))
        live = worth.filter(F.col("bound") >= least).select(*pattern)
        if length == max_length or not (size := live.count()):
            break
        if split:
            kept = semi_join(matches, pattern, live, size, ["session_id", "pos"])
            state = _state(kept, pattern, singletons, split).checkpoint()
        else:
            state = semi_join(state, pattern, live, size, ["session_id", "since"])
        worthy = _worthy(state, last, least, pattern, singletons, split).checkpoint()
        state = state.drop("gain", "top", "bound", "first")
        matches = _extended(state, events, worthy, length, max_length - length - 1, singletons, split, kind)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out
