"""Joins, orderings and running values that stay balanced when one key holds much of the data.

A key is *hot* when its rows exceed both HOT_FLOOR and HOT_SHARE of the table. Row counts add up to
the size of the table, so fewer than 1 / HOT_SHARE keys can be hot, and the parts that hot keys are
cut into are fewer than twice that, however large the table is: that bound is what allows the lists
of hot keys and of their slices below to be broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.plans.checkpoints import use_checkpoints

HOT_FLOOR = 100_000
HOT_SHARE = 1e-5
# Broadcasts are used only for tables proven or counted to have no more rows than this.
BROADCAST_ROWS = 1_000_000
# Numbered copies of a row are made in two steps of at most so many.
COPIES = 10_000


def is_small(max_rows: int | None) -> bool:
    """Whether a table with this proven or counted bound on its rows may be broadcast."""
    return max_rows is not None and max_rows <= BROADCAST_ROWS


def key_counts(df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Rows per key as ``hot_rows``, with ``extra`` aggregates."""
    return df.groupBy(*keys).agg(F.count("*").alias("hot_rows"), *extra)


def hot_keys(counts: DataFrame) -> DataFrame:
    """The hot ones of ``key_counts`` with ``hot_parts``, the number of parts to cut each into."""
    limit = counts.agg(
        F.greatest(F.lit(HOT_FLOOR), F.ceil(F.coalesce(F.sum("hot_rows"), F.lit(0)) * F.lit(HOT_SHARE))).alias("limit")
    ).scalar()
    return (
        counts.filter(F.col("hot_rows") > limit)
        .withColumn("hot_parts", F.ceil(F.col("hot_rows") / limit).cast("int"))
        .drop("hot_rows")
    )


def is_hot(rows: int | None, total: int | None) -> bool:
    """Whether a key with so many rows of a table's total is hot."""
    return (rows or 0) > max(HOT_FLOOR, math.ceil((total or 0) * HOT_SHARE))


def never_hot(rows: int | None) -> bool:
    """Whether a key with so many rows is hot in no table at all."""
    return (rows or 0) <= HOT_FLOOR


def _salt(by: Sequence[str], parts: str) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(*by), F.col(parts)).cast("int"), F.lit(0))


def _every(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    right_by: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi-join in which a key that is hot on either side is spread over a grid of tasks.

    The left rows of a hot key are divided into rows of the grid by a hash of ``spread_by``, its right rows into columns
    by a hash of ``right_by``, and each goes to every cell of its row or column. So no cell gets more than about the limit
    from either side, and a row is copied only as often as the other side has limits full of rows. Every other key is
    joined as it is. The result is that of a plain join.

    Without ``right_by`` no key has many rows on the right, which is then not counted; only so ``how`` may be an outer,
    semi or anti join of the left. ``counts`` are the key counts of the left if the caller has them.
    """
    if right_by is not None and how != "inner":
        raise ValueError("a right side that is cut can only be joined inner")
    keys = list(keys)
    counts = key_counts(left, keys) if counts is None else counts
    hot = hot_keys(counts.select(*keys, "hot_rows"))
    if right_by is None:
        hot = F.broadcast(hot)
        salted = left.join(hot, keys, "left").withColumn("salt", _salt(spread_by, "hot_parts"))
        copies = right.join(hot, keys, "left").withColumn("salt", _every("hot_parts"))
        return salted.drop("hot_parts").join(copies.drop("hot_parts"), [*keys, "salt"], how).drop("salt")
    sides = (hot, F.col("hot_parts"), F.lit(1)), (hot_keys(key_counts(right, keys)), F.lit(1), F.col("hot_parts"))
    listed = [h.select(*keys, a.alias("hot_parts"), b.alias("hot_columns")) for h, a, b in sides]
    grid = listed[0].unionAll(listed[1]).groupBy(*keys)
    grid = F.broadcast(grid.agg(F.max("hot_parts").alias("hot_parts"), F.max("hot_columns").alias("hot_columns")))
    across = left.join(grid, keys, "left").withColumn("salt", _salt(spread_by, "hot_parts")).withColumn("column", _every("hot_columns"))
    down = right.join(grid, keys, "left").withColumn("column", _salt(right_by, "hot_columns")).withColumn("salt", _every("hot_parts"))
    cells = across.drop("hot_parts", "hot_columns").join(down.drop("hot_parts", "hot_columns"), [*keys, "salt", "column"])
    return cells.drop("salt", "column")


def semi_join(
    rows: DataFrame, keys: Sequence[str], wanted: DataFrame, size: int, spread_by: Sequence[str]
) -> DataFrame:
    """Rows whose key is in ``wanted``, a distinct list that was counted to have ``size`` rows."""
    if is_small(size):
        return rows.join(F.broadcast(wanted), list(keys), "left_semi")
    return split_join(rows, wanted, keys, spread_by)


def hot_groups(df: DataFrame, key: str) -> DataFrame:
    """The hot values of ``key`` with ``hot_parts``, for ``ordered``."""
    return hot_keys(key_counts(df, [key]))


def sliced(df: DataFrame, key: str, order: Sequence[str], hot: DataFrame) -> tuple[DataFrame, bool]:
    """Add ``block``: NULL in ordinary groups, the number of the slice in a hot group. Also whether there is any.

    Slices follow each other in the whole order, not in time alone: by the ``order`` columns, then by all others, then by
    a number for rows alike in everything. Spark's range bounds cut it at ranks, so a slice has about the rows of the
    limit also where a group has a burst, one instant, or no times at all. Bounds come from samples; the slices are
    therefore computed once and stored.
    """
    parts = hot.agg(F.sum("hot_parts")).first()[0]
    if not parts:
        return df.withColumn("block", F.lit(None).cast("int")), False
    use_checkpoints(df.sparkSession)
    marked = df.join(F.broadcast(hot), key, "left")
    rest = [c for c in df.columns if c != key and c not in order]
    alike = marked.filter("hot_parts IS NOT NULL").groupBy(*df.columns).agg(F.count("*").alias("copies"))
    step = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES)))
    numbers = F.sequence(F.col("step") * COPIES, F.least(F.col("step") * COPIES + COPIES, "copies") - 1)
    numbered = alike.withColumn("step", step).withColumn("copy", F.explode(numbers))
    ranged = numbered.repartitionByRange(parts, key, *order, *rest, "copy").select(*df.columns, F.spark_partition_id().alias("block"))
    cold = marked.filter("hot_parts IS NULL").select(*df.columns, F.lit(None).cast("int").alias("block"))
    return cold.unionAll(ranged.checkpoint()), True


def ordered(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    hot: DataFrame | None,
    amount: str | None = None,
    instant: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``block`` and ``pos``, the place of a row in its group, and what lies behind it.

    Rows follow each other by ``order``. Every row has a place of its own, or shares it with the rows
    that agree on the ``instant`` columns, a first part of the order. Given an ``amount``, ``rest`` is
    its sum and ``peak`` its maximum over the rows behind, for which the order has to be total; both
    are NULL for the last row. Hot groups, given by ``hot_groups``, are worked slice by slice (see
    ``sliced``); what lies in other slices comes from one small row per slice. ``hot`` is None where it
    is known that no group is hot; else it is computed here and now.
    """
    order = list(order)
    rows, split = (df.withColumn("block", F.lit(None).cast("int")), False) if hot is None else sliced(df, key, order, hot)
    part = W.partitionBy(key, "block") if split else W.partitionBy(key)
    place = F.row_number().over(part.orderBy(*order)) if instant is None else F.rank().over(part.orderBy(*instant))
    placed = rows.withColumn("pos", place.cast("bigint"))
    if amount is not None:
        behind = part.orderBy(*[F.col(c).desc() for c in order]).rowsBetween(W.unboundedPreceding, -1)
        placed = placed.withColumns({"rest": F.sum(amount).over(behind), "peak": F.max(amount).over(behind)})
    if not split:
        return placed
    # Few enough to be broadcast: as many as there are slices.
    outside = F.broadcast(_outside(placed.filter(F.col("block").isNotNull()), key, amount, instant))
    before = F.coalesce("rows_before", F.lit(0)) + F.col("pos")
    # What shares an instant with the slice before has the place where that instant began.
    place = before if instant is None else F.when((F.col("pos") == 1) & F.col("first_place").isNotNull(), F.col("first_place")).otherwise(before)
    placed = placed.join(outside, [key, "block"], "left").withColumn("pos", place)
    if amount is not None:
        both = F.coalesce("rest", F.lit(0)) + F.coalesce("sum_after", F.lit(0))
        placed = placed.withColumns(
            {
                "rest": F.when(F.coalesce("rest", "sum_after").isNotNull(), both),
                "peak": F.greatest("peak", "max_after"),
            }
        )
    return placed.drop("rows_before", "sum_after", "max_after", "first_place")


def _outside(placed: DataFrame, key: str, amount: str | None, instant: Sequence[str] | None) -> DataFrame:
    """For every slice what the others of its group add: rows before, sum and maximum after, the place of its first instant."""
    value = F.lit(0) if amount is None else F.col(amount)
    at = F.struct(*(instant or ["pos"]))
    slices = placed.groupBy(key, "block").agg(
        F.count("*").alias("slice_rows"),
        F.sum(value).alias("slice_sum"),
        F.max(value).alias("slice_max"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.max("pos").alias("last_pos"),
    )
    along = W.partitionBy(key).orderBy("block")
    until = along.rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(key).orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    known = slices.select(
        key,
        "block",
        F.coalesce(F.sum("slice_rows").over(until), F.lit(0)).alias("rows_before"),
        F.sum("slice_sum").over(back).alias("sum_after"),
        F.max("slice_max").over(back).alias("max_after"),
        "first_at",
        "last_at",
        "last_pos",
    )
    if instant is None:
        return known.drop("first_at", "last_at", "last_pos")
    # An instant that ends a slice begins in the first slice that it ends.
    began = known.groupBy(key, F.col("last_at").alias("first_at")).agg(F.min(F.col("rows_before") + F.col("last_pos")).alias("first_place"))
    return known.join(began, [key, "first_at"], "left").drop("first_at", "last_at", "last_pos")


def earlier_max(rows: DataFrame, group: Sequence[str], order: str, value: str, split: bool) -> DataFrame:
    """Add ``earlier``: the largest ``value`` before this row in its group, across ``block`` slices.

    ``split`` says whether any row has a slice number; without one no slices are told apart.
    """
    before = (W.unboundedPreceding, -1)
    if not split:
        return rows.withColumn("earlier", F.max(value).over(W.partitionBy(*group).orderBy(order).rowsBetween(*before)))
    inside = F.max(value).over(W.partitionBy(*group, "block").orderBy(order).rowsBetween(*before))
    outside = (
        rows.filter(F.col("block").isNotNull())
        .groupBy(*group, "block")
        .agg(F.max(value).alias("slice_max"))
        .withColumn("outside", F.max("slice_max").over(W.partitionBy(*group).orderBy("block").rowsBetween(*before)))
        .drop("slice_max")
    )
    return (
        rows.withColumn("inside", inside)
        .join(outside, [*group, "block"], "left")
        .withColumn("earlier", F.greatest("inside", "outside"))
        .drop("inside", "outside")
    )
