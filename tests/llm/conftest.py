from __future__ import annotations

import duckdb
import pytest

from check import TABLES
from tests.conftest import SMALL


@pytest.fixture(scope="session")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents, and some that are awkward: null, empty, blank, repeated, long, with odd white space."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    odd = [
        (9000, None, None, None, None),
        (9001, "", "en", "s", 0),
        (9002, " \n\t ", "en", "s", 4),
        (9003, "one two", "xx", "s", 7),
        (9004, "one\x0btwo\x0cthree\rfour\x1cfive\xa0six one two", None, "s", 30),
        (9005, "word " * 30_000, "en", "s", 150_000),
        (9006, "x" * 100_000, "en", "s", 100_000),
        (9007, "same line\nsame line\n\nsame line \n", "de", "s", 32),
        (9008, "日本語 テキスト 日本語 テキスト 日本語", "ja", "s", 20),
        (None, "no key", "en", "s", 6),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame([*rows, *odd, odd[3], rows[5]], schema)
