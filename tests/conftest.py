from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    """Click and purchase tables from rows (session, second, item[, utility]); seconds order the events."""

    class Tables:
        @staticmethod
        def clicks(rows):
            df = spark.createDataFrame([tuple(r) for r in rows] or [], "session_id bigint, s bigint, item_id bigint")
            return df.selectExpr("session_id", "timestamp_seconds(s) AS ts", "s AS event_id", "item_id")

        @staticmethod
        def purchases(rows):
            rows = [(a, b, c, Decimal(str(d))) for a, b, c, d in rows]
            df = spark.createDataFrame(rows, "session_id bigint, s bigint, item_id bigint, utility decimal(18,2)")
            return df.selectExpr("session_id", "timestamp_seconds(s) AS ts", "s AS event_id", "item_id", "utility")

    return Tables


def pairs(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
