"""Column expressions shared by the operators. Every one stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# A price as loaded: nothing finer is rounded, it fails.
PRICE = "decimal(18,6)"

# What the category field of a click means.
OFFER_CODE = "S"
MISSING_CODE = "0"
FIRST_CATEGORY, LAST_CATEGORY = 1, 12


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def exact_price(text: Column | str) -> Column:
    """A price as an exact decimal; NULL where it is none. One that PRICE cannot hold fails rather than being rounded."""
    full = _col(text).try_cast("decimal(38,18)")
    price = full.try_cast(PRICE)
    lossy = full.isNotNull() & (price.isNull() | (price != full))
    return F.when(lossy, F.raise_error(F.concat(F.lit("price beyond "), F.lit(PRICE), F.lit(": "), _col(text).cast("string")))).otherwise(price)


def utility(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """Price times quantity as an exact amount, so that sums do not depend on row order.

    NULL only where one of both is. A product beyond the type fails, whatever the session's ANSI setting.
    """
    product = _col(price) * _col(quantity)
    beyond = _col(price).isNotNull() & _col(quantity).isNotNull() & product.isNull()
    return F.when(beyond, F.raise_error(F.lit("utility beyond its type"))).otherwise(product)


def event_time(text: Column | str) -> Column:
    """Timestamp of an ISO text, with or without milliseconds; NULL where it cannot be read."""
    return F.try_to_timestamp(_col(text))


def category_kind(category: Column | str = "category") -> Column:
    """offer, missing, category or brand; NULL for a text that is none of these."""
    code = F.trim(_col(category))
    number = code.try_cast("bigint")
    return (
        F.when(code == OFFER_CODE, "offer")
        .when(code == MISSING_CODE, "missing")
        .when(number.between(FIRST_CATEGORY, LAST_CATEGORY), "category")
        .when(number.isNotNull(), "brand")
    )


def singletons(items: Column | str) -> Column:
    """``[a, b]`` to ``[[a], [b]]``: every item an itemset of its own."""
    return F.transform(_col(items), lambda item: F.array(item))


def sequence_text(sequence: Column | str) -> Column:
    """``[[1], [2, 3]]`` to ``1>2+3``."""
    return F.array_join(
        F.transform(_col(sequence), lambda itemset: F.array_join(itemset.cast("array<string>"), "+")), ">"
    )


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based number of the right-closed bin holding ``value``; the minimum falls into bin 1.

    Where all values are equal there is no width to divide by and everything is in bin 1.
    """
    spread = (high - low).cast("double")
    place = F.ceil((value - low).cast("double") * F.lit(bins) / F.nullif(spread, F.lit(0.0)))
    return F.least(F.lit(bins), F.greatest(F.lit(1), F.coalesce(place, F.lit(1)))).cast("int")
