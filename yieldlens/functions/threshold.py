"""The minimum utility: a fixed amount, or a share of everything spent."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


@dataclass(frozen=True)
class MinUtility:
    """Exactly one of ``amount`` and ``share`` is set; both are exact numbers."""

    amount: Decimal | None = None
    share: Decimal | None = None

    @classmethod
    def of_amount(cls, amount: Decimal | float | int | str) -> MinUtility:
        return cls(amount=Decimal(str(amount)))

    @classmethod
    def of_share(cls, share: Decimal | float | str) -> MinUtility:
        value = Decimal(str(share))
        if not 0 < value <= 1:
            raise ValueError("share must lie in (0, 1]")
        return cls(share=value)

    def column(self, amounts: DataFrame, amount_column: str = "utility") -> Column:
        """The threshold as a column; a share becomes a scalar subquery over ``amounts``.

        ``amounts`` may be any table whose ``amount_column`` adds up to the total, so an aggregate
        that the query computes anyway serves, and Spark reuses its shuffle.
        """
        if self.share is None:
            return F.lit(self.amount)
        total, kind = F.sum(amount_column), amounts.schema[amount_column].dataType
        if isinstance(kind, DecimalType):
            # Room for the digits of the share behind those of the amounts, so that the product is exact.
            narrow = total.cast(DecimalType(26, kind.scale))
            total = F.when(total.isNotNull() & narrow.isNull(), F.raise_error(F.lit("total beyond its type"))).otherwise(narrow)
        return amounts.agg((total * F.lit(self.share)).alias("min_utility")).scalar()

    @property
    def max_items(self) -> int | None:
        """How many items can reach the threshold when no utility is negative.

        The utilities of all items add up to the total, so at most 1/share of them can each hold
        that share. A fixed amount gives no bound that is known before the data is read.
        """
        if self.share is None:
            return None
        return int((1 / self.share).to_integral_value(ROUND_FLOOR))
