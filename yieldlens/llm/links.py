"""Connected components of a table of links, and the rows of the documents they name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldlens.llm.storage import Workspace


# Bits that tell which keys are wanted: 16 MB whatever the corpus, which is what is broadcast.
SLOTS = 1 << 27


def of_keys(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among those of ``wanted``, without moving the others.

    A bit per slot of the keys' hash tells most others where they lie; only what has its bit is joined.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
    bitmaps = F.broadcast(wanted.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(bits))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    likely = rows.join(bitmaps, F.bitmap_bucket_number(slot) == F.col("_bucket")).filter(F.getbit(byte, (place % 8).cast("int")) == 1)
    # Spark would push a semi join down to all rows.
    return likely.select(*rows.columns).join(wanted.select(key).distinct(), key).select(*rows.columns)


def components(links: DataFrame, space: Workspace, name: str = "links") -> DataFrame:
    """``node`` and ``component``, the smallest node that links lead to, for every node of a link (a, b).

    Rounds of two steps bring the links to stars around the smallest nodes: first every node passes its
    larger neighbours to its smallest one, then its smaller ones. Minima are combined before they are
    shuffled, so a node with very many links is no hot group; each round is a written table.
    """
    forth = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges, before, round_ = space.keep(forth, f"{name}-0"), None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, round_ = state, round_ + 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        next_ = stars.union(small.select("a", F.col("m").alias("b"))).distinct()
        edges = space.keep(next_, f"{name}-{round_}")
