"""Hot keys: with the limit lowered to a few rows everything must come out as without it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.functions.columns import sequence_text
from yieldlens.functions.threshold import MinUtility
from yieldlens.operators import patterns, sequences, skew
from yieldlens.operators.skew import (
    BROADCAST_ROWS,
    earlier_max,
    hot_groups,
    hot_keys,
    is_small,
    key_counts,
    ordered,
    semi_join,
    split_join,
)



@pytest.fixture
def low(monkeypatch):
    """Make keys hot from a few rows on."""
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 900 rows belongs to key 7; the rest is spread thinly."""
    chance = random.Random(3)
    data = [
        (7 if n % 3 == 0 else 1000 + n // 4, chance.randrange(400), n, chance.randrange(6), n % 11)
        for n in range(900)
    ]
    df = spark.createDataFrame(data, "session_id bigint, s bigint, event_id bigint, item_id bigint, u bigint")
    return df.selectExpr(
        "session_id",
        "timestamp_seconds(nullif(s, 200)) AS ts",
        "event_id",
        "item_id",
        "CAST(u AS DECIMAL(18,2)) AS utility",
    )


def test_only_large_keys_are_hot(skewed, monkeypatch):
    counts = key_counts(skewed, ["session_id"])
    assert hot_keys(counts).count() == 0
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)
    assert [(r.session_id, r.hot_parts) for r in hot_keys(counts).collect()] == [(7, 60)]


def test_split_join_is_a_join(spark, skewed, low):
    few = spark.createDataFrame([(7, "a"), (7, "b"), (1001, "c"), (5, "d")], "session_id bigint, name string")
    plain = skewed.join(few, "session_id")
    split = split_join(skewed, few, ["session_id"], ["event_id"])
    assert split.columns == plain.columns and rows(split) == rows(plain)


@pytest.mark.parametrize("size", [3, BROADCAST_ROWS + 1])
def test_semi_join_by_either_way(spark, skewed, size, low):
    wanted = spark.createDataFrame([(0,), (3,), (77,)], "item_id bigint")
    got = semi_join(skewed, ["item_id"], wanted, size, ["event_id"])
    assert rows(got.select(skewed.columns)) == rows(skewed.filter(F.col("item_id").isin(0, 3)))


def test_broadcast_only_below_the_bound():
    assert is_small(0) and is_small(BROADCAST_ROWS)
    assert not is_small(BROADCAST_ROWS + 1) and not is_small(None)


@pytest.mark.parametrize("instant", [["ts", "event_id"], ["ts"]])
def test_places_and_rest_across_slices(skewed, instant, low):
    order = ["ts", "event_id"]
    whole = W.partitionBy("session_id")
    later = whole.orderBy(F.col("ts").desc(), F.col("event_id").desc()).rowsBetween(W.unboundedPreceding, -1)
    plain = skewed.select(
        "session_id", "event_id",
        F.rank().over(whole.orderBy(*instant)).cast("bigint").alias("pos"),
        F.sum("utility").over(later).cast("decimal(28,2)").alias("rest"),
        F.max("utility").over(later).alias("peak"),
    )
    hot = hot_groups(skewed, "session_id")
    for spans in (hot, None):
        got = ordered(skewed, "session_id", order, spans, "utility", instant if len(instant) == 1 else None)
        assert rows(
            got.select("session_id", "event_id", "pos", F.col("rest").cast("decimal(28,2)"), "peak")
        ) == rows(plain)
    blocks = ordered(skewed, "session_id", order, hot).filter("block IS NOT NULL")
    assert blocks.select("session_id").distinct().count() == 1 and blocks.select("block").distinct().count() > 20


KINDS = {
    "one instant": "timestamp_seconds(5)",
    "a burst and two strays": "timestamp_seconds(CASE WHEN id = 0 THEN 0 WHEN id = 1 THEN 1000000 ELSE 500000 + id % 3 END)",
    "no time at all": "CAST(NULL AS TIMESTAMP)",
    "evenly spread": "timestamp_seconds(id)",
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("copies", [1, 40])
def test_no_slice_is_much_larger_than_the_limit(spark, kind, copies, monkeypatch):
    monkeypatch.setattr(skew, "HOT_FLOOR", 50)
    monkeypatch.setattr(skew, "COPIES", 7)
    columns = ["1 AS session_id", f"{KINDS[kind]} AS ts", f"id % {1000 // copies} AS item_id"]
    df = spark.range(1000).selectExpr(*columns) if copies == 1 else spark.range(1000).selectExpr(columns[0], "timestamp_seconds(5) AS ts", columns[2])
    df = df.unionByName(spark.range(30).selectExpr("2 AS session_id", "timestamp_seconds(id) AS ts", "id AS item_id"))
    got = ordered(df, "session_id", ["ts", "item_id"], hot_groups(df, "session_id"))
    sizes = [r["count"] for r in got.filter("session_id = 1").groupBy("block").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 100 and len(sizes) >= 10
    assert got.filter("session_id = 2 AND block IS NULL").count() == 30
    assert sorted(r.pos for r in got.filter("session_id = 1").collect()) == list(range(1, 1001))
    # Rows that share an instant share its place, whatever slices they lie in.
    whole = W.partitionBy("session_id").orderBy("ts")
    plain = df.select("session_id", "ts", F.rank().over(whole).cast("bigint").alias("pos"))
    got = ordered(df, "session_id", ["ts", "item_id"], hot_groups(df, "session_id"), instant=["ts"])
    assert rows(got.select("session_id", "ts", "pos")) == rows(plain)


@pytest.mark.parametrize(("left", "right"), [(900, 900), (900, 3), (3, 900), (3, 3)])
def test_cells_of_a_join_are_bounded(spark, left, right, monkeypatch):
    """Hot on one side, on both, on none: no cell has many rows of either side, and copies are few."""
    monkeypatch.setattr(skew, "HOT_FLOOR", 100)
    few = [(100 + i, i) for i in range(40)]
    a = spark.createDataFrame([(1, i) for i in range(left)] + few, "k bigint, a bigint")
    b = spark.createDataFrame([(1, i) for i in range(right)] + few, "k bigint, b bigint")
    joined = split_join(a, b, ["k"], ["a"], ["b"])
    assert rows(joined) == rows(a.join(b, "k"))
    # The sides as they go into the last join.
    cells = {}
    plain_join = type(a).join

    def seen(self, other, on=None, how=None):
        if on == ["k", "salt", "column"]:
            for side, df in (("left", self), ("right", other)):
                cells[side] = [r["count"] for r in df.filter("k = 1").groupBy("k", "salt", "column").count().collect()]
        return plain_join(self, other, on, how)

    monkeypatch.setattr(type(a), "join", seen)
    split_join(a, b, ["k"], ["a"], ["b"])
    assert max(cells["left"]) <= 200 and max(cells["right"]) <= 200
    assert sum(cells["left"]) <= left * -(-right // 100) and sum(cells["right"]) <= right * -(-left // 100)


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi"])
def test_other_joins_of_a_hot_key(spark, skewed, low, how):
    wanted = spark.createDataFrame([(7, "x"), (1001, "y")], "session_id bigint, name string")
    split = split_join(skewed, wanted, ["session_id"], ["event_id"], how=how)
    assert rows(split) == rows(skewed.join(wanted, "session_id", how))
    with pytest.raises(ValueError):
        split_join(skewed, wanted, ["session_id"], ["event_id"], ["name"], how=how)


def test_earlier_max_across_slices(skewed, low):
    before = W.partitionBy("session_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    plain = skewed.select("session_id", "event_id", F.max("utility").over(before).alias("earlier"))
    sliced = ordered(skewed, "session_id", ["ts", "event_id"], hot_groups(skewed, "session_id"))
    for split in (True, False):
        got = earlier_max(sliced, ["session_id"], "pos", "utility", split)
        assert rows(got.select("session_id", "event_id", "earlier")) == rows(plain)


def test_long_sessions_continue_over_parts(skewed, monkeypatch):
    whole = {r.session_id: r["items"] for r in sequences.click_sequences(skewed).collect()}
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)
    parted = sequences.click_sequences(skewed, part_rows=16)
    joined: dict[int, list[int]] = {}
    for r in parted.orderBy("session_id", "part").collect():
        assert len(r["items"]) <= 16
        joined.setdefault(r.session_id, []).extend(r["items"])
    assert joined == whole and parted.filter("part > 0").count() > 10
    shape = sorted((r.session_id, r.part, len(r["items"])) for r in parted.collect())
    monkeypatch.setattr(skew, "HOT_FLOOR", 10**9)
    cold = sequences.click_sequences(skewed, part_rows=16).collect()
    assert shape == sorted((r.session_id, r.part, len(r["items"])) for r in cold)


def test_frequent_sequences_of_a_hot_session(skewed, monkeypatch):
    def mined():
        found = sequences.frequent_sequences(skewed, 0.02, 3)
        return rows(found.select(sequence_text("sequence"), "freq"))

    plain = mined()
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)
    assert mined() == plain and len(plain) > 20


@pytest.mark.parametrize("size", [1, 5, 32, 33, 1000])
def test_first_place_behind(spark, size):
    places = list(range(10, 10 + 3 * size, 3))
    df = spark.createDataFrame([(places, done) for done in range(places[-1])], "places array<bigint>, done bigint")
    for row in df.select("done", sequences.first_behind(F.col("places"), F.col("done")).alias("first")).collect():
        assert row["first"] == min(p for p in places if p > row.done)


def test_one_item_very_often(spark, monkeypatch):
    """Many repeats of one item are one row of places, or a few bounded ones."""
    monkeypatch.setattr(skew, "HOT_FLOOR", 500)
    monkeypatch.setattr(sequences, "PART_ROWS", 300)
    df = spark.range(10_000).selectExpr("1 AS session_id", "timestamp_seconds(id) AS ts", "IF(id % 2500 = 7, 2, 1) AS item_id")
    placed = ordered(df, "session_id", ["ts", "item_id"], hot_groups(df, "session_id"))
    index = sequences.occurrences(placed, True)
    assert index.agg(F.max(F.size("places"))).first()[0] <= 300 and index.count() <= 10_000 / 300 + 6
    found = sequences.frequent_sequences(df, 1.0, 3)
    names = {r.s for r in found.select(sequence_text("sequence").alias("s")).collect()}
    assert len(names) == 2 + 4 + 8


@pytest.mark.parametrize("singletons", [True, False])
def test_valuable_patterns_of_a_hot_session(skewed, singletons, monkeypatch):
    def mined():
        found = patterns.high_utility_sequences(skewed, MinUtility.of_share("0.02"), 3, singletons=singletons)
        return rows(found.select(sequence_text("pattern"), "utility"))

    plain = mined()
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)
    assert mined() == plain and len(plain) > 20
