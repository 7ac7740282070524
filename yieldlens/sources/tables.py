"""Readers for click and purchase tables, and storage for the click-to-purchase matrix.

Columns in use throughout the package:

clicks      session_id long, ts timestamp, item_id long, category string
purchases   session_id long, ts timestamp, item_id long, price decimal, quantity long, utility decimal
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.window import Window as W

from yieldlens.functions.columns import event_time, exact_price, utility
from yieldlens.plans.checkpoints import use_checkpoints

# The time is read as text, since an unreadable one must not cost the row, and the price, since none may be rounded.
CLICK_FILE = "session_id bigint, ts string, item_id bigint, category string"
PURCHASE_FILE = "session_id bigint, ts string, item_id bigint, price string, quantity bigint"
MATRIX_FILE = "click_item bigint, purchase_item bigint, weight double"

# So many first rows may come to one task.
FEW_ROWS = 100_000

CLICK_KEYS = ["session_id", "item_id"]
PURCHASE_KEYS = ["session_id", "item_id", "utility"]


def _read(reader: DataFrameReader | DataStreamReader, path: str, schema: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        # Fields that do not fit their type become NULL, which is also how a header line drops out.
        return reader.schema(schema).csv(path, header=False, mode="PERMISSIVE")
    if isinstance(reader, DataStreamReader):
        return reader.schema(schema).format(fmt).load(path)
    # Other formats know their types.
    return reader.format(fmt).load(path)


def _timed(df: DataFrame) -> DataFrame:
    """Times as timestamps, where the file has them as text."""
    return df if dict(df.dtypes)["ts"].startswith("timestamp") else df.withColumn("ts", event_time("ts"))


def with_utility(purchases: DataFrame) -> DataFrame:
    return purchases.withColumn("utility", utility())


def drop_incomplete(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a value in every key column.

    Written as plain NULL tests, which joins and shared subplans recognise; ``dropna`` is opaque to them.
    """
    return df.filter(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def load_clicks(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Clicks of a headerless file, without rows that lack session or item."""
    return drop_incomplete(_timed(_read(spark.read, path, CLICK_FILE, fmt)), CLICK_KEYS)


def stream_clicks(spark: SparkSession, path: str, fmt: str = "csv", max_files: int | None = None) -> DataFrame:
    """The same for files that keep arriving in a folder."""
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    return drop_incomplete(_timed(_read(reader, path, CLICK_FILE, fmt)), CLICK_KEYS)


def load_purchases(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Purchases of a headerless file with their utility, without rows that lack session, item or utility."""
    return drop_incomplete(with_utility(_timed(typed_purchases(_read(spark.read, path, PURCHASE_FILE, fmt)))), PURCHASE_KEYS)


def typed_purchases(raw: DataFrame) -> DataFrame:
    """Purchases from a table of any column types: strict casts, NULL where a value is none of its type."""
    return raw.select(
        F.col("session_id").try_cast("bigint").alias("session_id"),
        F.col("ts"),
        F.col("item_id").try_cast("bigint").alias("item_id"),
        exact_price("price").alias("price"),
        F.col("quantity").try_cast("bigint").alias("quantity"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Some rows to look at, in no special order."""
    return df.limit(rows)


def first_rows(df: DataFrame, keys: list[str], rows: int | None) -> DataFrame:
    """The first ``rows`` rows by ``keys``, then by all other columns, or the whole table for None.

    A few rows are the best of each task's best. More would not fit one task: then the table is dealt by ranges of
    the whole order, the ranges are counted, and only within the range that holds the last row are rows told apart.
    """
    if rows is None:
        return df
    order = [*keys, *(c for c in df.columns if c not in keys)]
    if rows <= FEW_ROWS:
        return df.orderBy(*order).limit(rows)
    use_checkpoints(df.sparkSession)
    part, place = "part", "place"
    while {part, place} & set(df.columns):
        part, place = f"_{part}", f"_{place}"
    dealt = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).checkpoint()
    left, last = rows, -1
    # One number per range.
    for range_, n in sorted(tuple(r) for r in dealt.groupBy(part).count().collect()):
        last = range_
        if n >= left:
            break
        left -= n
    number = F.row_number().over(W.partitionBy(part).orderBy(*order))
    within = dealt.filter(F.col(part) == last).withColumn(place, number).filter(F.col(place) <= left)
    return dealt.filter(F.col(part) < last).select(*df.columns).unionAll(within.select(*df.columns))


def save_matrix(matrix: DataFrame, path: str) -> None:
    """Store a matrix as Parquet, written by the executors.

    Files hold ranges of clicked items and are sorted by them, so that a lookup reads few files and few
    of their row groups.
    """
    ranges = matrix.repartitionByRange("click_item", "purchase_item")
    ranges.sortWithinPartitions("click_item", "purchase_item").write.mode("overwrite").parquet(path)


def load_matrix(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a stored matrix: Parquet with its own types, or a CSV with a header line."""
    if fmt == "csv":
        return spark.read.schema(MATRIX_FILE).csv(path, header=True, enforceSchema=True)
    return spark.read.parquet(path).select("click_item", "purchase_item", "weight")
