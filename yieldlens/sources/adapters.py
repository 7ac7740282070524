"""Views of the test tables in the shape of click and purchase tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldlens.functions.columns import MONEY
from yieldlens.sources.tables import CLICK_KEYS, PURCHASE_KEYS, drop_incomplete, with_utility

FIRST_DAY = "2024-01-01"
CLICK_TYPES = ("click", "view")
PURCHASE_TYPE = "purchase"
EVENT_ORDER = ["ts", "event_id"]
LINE_ORDER = ["ts", "line", "item_id", "extended_price"]
STATE_ORDER = ["ts", "line", "part", "extended_price"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date"))
    return _table(spark, sf_dir, "events").withColumns(
        {
            "session_id": F.col("user_id") * 1000 + day,
            "ts": F.col("ts").cast("timestamp"),
            "item_id": F.get_json_object("props", "$.k").cast("bigint"),
        }
    )


def event_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and day; clicks and views count as clicks."""
    clicks = _events(spark, sf_dir).filter(F.col("event_type").isin(*CLICK_TYPES))
    return drop_incomplete(
        clicks.select("session_id", "ts", "event_id", "item_id", F.col("event_type").alias("category")), CLICK_KEYS
    )


def event_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events at quantity one."""
    purchases = _events(spark, sf_dir).filter(F.col("event_type") == PURCHASE_TYPE)
    return drop_incomplete(
        with_utility(
            purchases.select(
                "session_id",
                "ts",
                "event_id",
                "item_id",
                F.col("value").cast(MONEY).alias("price"),
                F.lit(1).cast("bigint").alias("quantity"),
            )
        ),
        PURCHASE_KEYS,
    )


def event_rows_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as clicks, with sign-ups lacking the session and errors lacking the item."""
    kind = F.col("event_type")
    return _events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.when(kind != "signup", F.col("session_id")).alias("session_id"),
        F.when(kind != "error", F.col("item_id")).alias("item_id"),
        kind.alias("category"),
    )


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a session with their type as the item."""
    return _events(spark, sf_dir).select("session_id", "ts", "event_id", F.col("event_type").alias("item_id"))


def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as purchases: an order is a session, a part an item at its retail price."""
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("extended_price"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )
    # Spark broadcasts the parts while they are small; beyond that it splits a part with many lines.
    return drop_incomplete(with_utility(lines.join(parts, "item_id")), PURCHASE_KEYS)


def order_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with return flag and line status as the item."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("extended_price"),
        F.concat("l_returnflag", "l_linestatus").alias("item_id"),
    )
