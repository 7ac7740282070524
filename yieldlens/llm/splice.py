"""Replace stretches of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spliced(text: Column, cuts: Column) -> Column:
    """The text with every cut, array<struct<start, end, put>> in code points, replaced by its ``put``.

    Cuts are in order and apart; where there are none, or null, the text is as it was.
    """

    def end_before(i: Column) -> Column:
        return F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0))

    parts = F.transform(
        cuts,
        lambda c, i: F.concat(
            F.substring(text, (end_before(i) + 1).cast("int"), (c["start"] - end_before(i)).cast("int")), c["put"]
        ),
    )
    rest = F.substring(text, (end_before(F.size(cuts)) + 1).cast("int"), F.length(text))
    return F.when(F.coalesce(F.size(cuts), F.lit(0)) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)
