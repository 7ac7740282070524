"""Small inputs with answers worked out by hand."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.ml.fpm import PrefixSpan
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import pairs
from yieldlens.functions.columns import category_kind, sequence_text, utility
from yieldlens.functions.threshold import MinUtility
from yieldlens.operators import matrix, patterns, recommend, sequences
from yieldlens.operators import utility as ut
from yieldlens.operators.skew import BROADCAST_ROWS

A, B = 214536502, 214536500
CLICKS = [(11, 1, A), (11, 2, B), (12, 1, A)]
BUYS = [(11, 3, A, 3000), (12, 3, A, 1500)]
AMOUNT = MinUtility.of_amount


def edges(df, value):
    return {(r.click_item, r.purchase_item): float(r[value]) for r in df.collect()}


def clicked(df):
    return matrix.session_items(df, "click_item")


def test_two_sessions_from_clicks_to_recommendations(tables):
    clicks, buys = tables.clicks(CLICKS), tables.purchases(BUYS)
    assert pairs(ut.item_utility(buys), "item_id", "utility") == {A: 4500}
    assert pairs(ut.swu(buys), "item_id", "swu") == {A: 4500}
    assert pairs(ut.session_utility(buys), "session_id", "utility") == {11: 3000, 12: 1500}
    counts = matrix.cps(clicks, buys)
    assert edges(counts, "cps") == {(A, A): 2, (B, A): 1}
    assert edges(matrix.cps_probability(counts, clicks), "probability") == {(A, A): 1, (B, A): 1}
    items = ut.high_utility_items(buys, AMOUNT(1000))
    weights = matrix.whuom(counts, items)
    assert edges(weights, "weight") == {(A, A): 9000, (B, A): 4500}
    assert edges(matrix.utility_matrix(clicks, buys, items), "weight") == {(A, A): 9000, (B, A): 4500}
    scores = recommend.score(clicked(clicks), weights)
    assert pairs(scores, "session_id", "score") == {11: 13500, 12: 9000}
    assert recommend.without_bought(scores, buys).count() == 0
    edges_with_gain = matrix.profit_edges(counts, clicks, items)
    assert pairs(recommend.expected_profit(clicked(clicks), edges_with_gain), "session_id", "expected_profit") == {
        11: 4500, 12: 4500
    }


@pytest.mark.parametrize(
    "least, merge, expected", [(2000, "max", 3000), (2000, "sum", 3000), (1000, "max", 3000), (1000, "sum", 4500)]
)
def test_two_shards_see_half_the_sessions(tables, least, merge, expected):
    found = ut.high_utility_items_by_shard(tables.purchases(BUYS), AMOUNT(least), 2, merge)
    assert pairs(found, "item_id", "utility") == {A: expected}


def test_weight_prefers_the_likely_item_to_the_dear_one(spark):
    counts = spark.createDataFrame(
        [(214536, 111222, 0.85), (214536, 999999, 0.10)], "click_item long, purchase_item long, cps double"
    )
    items = spark.createDataFrame([(111222, 1000.0), (999999, 5000.0)], "item_id long, utility double")
    weights = matrix.whuom(counts, items)
    assert edges(weights, "weight") == {(214536, 111222): 850, (214536, 999999): 500}
    seen = spark.createDataFrame([(1, 214536)], "session_id long, click_item long")
    assert recommend.recommend(seen, weights, 1).first().item_id == 111222


def test_items_without_utility_weigh_nothing(spark):
    counts = spark.createDataFrame([(1, 2, 3), (1, 3, 4), (1, 4, 1)], "click_item long, purchase_item long, cps long")
    items = spark.createDataFrame([(2, 10.0), (3, 0.0), (4, 5.0)], "item_id long, utility double")
    assert edges(matrix.whuom(counts, items), "weight") == {(1, 2): 30, (1, 4): 5}
    assert edges(matrix.whuom_left(counts, items), "weight") == {(1, 2): 30, (1, 4): 5}
    assert edges(matrix.whuom_log(counts, items), "weight") == {(1, 2): pytest.approx(10 * 1.0986122886681098)}


def test_swu_rule_can_drop_a_valuable_item_when_utilities_are_negative(tables):
    x, z = 1, 2
    buys = tables.purchases([(1, 1, x, 10), (1, 2, x, 7), (2, 1, x, 20), (2, 2, z, -15)])
    assert pairs(ut.item_utility(buys), "item_id", "utility") == {x: 37, z: -15}
    assert pairs(ut.session_utility(buys), "session_id", "utility") == {1: 17, 2: 5}
    assert pairs(ut.swu(buys), "item_id", "swu") == {x: 22, z: 5}
    assert ut.high_utility_items(buys, AMOUNT(30)).count() == 0
    assert pairs(ut.promising_items(buys, AMOUNT(20)), "item_id", "swu") == {x: 22}
    with pytest.raises(PySparkException, match="negative utility"):
        ut.high_utility_items(buys, AMOUNT(30), nonnegative=True).collect()
    with pytest.raises(PySparkException, match="negative utility"):
        patterns.high_utility_sequences(buys, AMOUNT(1), 2).collect()


def test_thresholds_include_their_own_value(tables):
    buys = tables.purchases([(1, 1, 1, 6000), (2, 1, 2, 2000), (3, 1, 3, 5500), (4, 1, 4, 4000), (5, 1, 5, 5000)])
    assert set(pairs(ut.promising_items(buys, AMOUNT(5000)), "item_id", "swu")) == {1, 3, 5}
    assert set(pairs(ut.high_utility_items(buys, AMOUNT(5000)), "item_id", "utility")) == {1, 3, 5}


GROWTH = [(1, 1, 1, 5), (1, 2, 2, 3), (1, 3, 1, 2), (1, 4, 3, 4), (2, 1, 2, 6), (2, 2, 1, 1), (2, 3, 3, 2)]


def mined(df, least, length, **how):
    found = patterns.high_utility_sequences(df, AMOUNT(least), length, **how)
    return {r.p: int(r.utility) for r in found.select(sequence_text("pattern").alias("p"), "utility").collect()}


def test_growth_of_patterns(tables):
    buys = tables.purchases(GROWTH)
    every = {
        "1": 6, "2": 9, "3": 6, "1>1": 7, "1>2": 8, "1>3": 12, "2>1": 12, "2>3": 15, "1>1>3": 11,
        "1>2>1": 10, "1>2>3": 12, "2>1>3": 18, "1>2>1>3": 14,
    }
    assert mined(buys, 1, 4) == every
    assert mined(buys, 12, 4) == {p: u for p, u in every.items() if u >= 12}
    assert mined(buys, 12, 2) == {"1>3": 12, "2>1": 12, "2>3": 15}
    assert pairs(ut.item_utility(buys), "item_id", "utility") == {1: 8, 2: 9, 3: 6}


def test_purchases_at_one_instant_form_an_itemset(tables):
    buys = tables.purchases([(1, 1, 2, 4), (1, 1, 1, 3), (1, 1, 1, 2), (1, 2, 1, 7)])
    assert mined(buys, 1, 3, order=["ts"], singletons=False) == {
        "1": 7, "2": 4, "1+2": 9, "1>1": 12, "2>1": 11, "1+2>1": 16
    }


def test_equal_scores_rank_by_item_and_strangers_get_nothing(spark):
    weights = spark.createDataFrame([(1, 8, 5.0), (1, 7, 5.0)], "click_item long, purchase_item long, weight double")
    seen = spark.createDataFrame([(1, 1), (2, 99)], "session_id long, click_item long")
    ranked = recommend.recommend(seen, weights, 2)
    assert [(r.session_id, r["rank"], r.item_id) for r in ranked.orderBy("rank").collect()] == [(1, 1, 7), (1, 2, 8)]
    assert [r.item_id for r in recommend.recommend(seen, weights, 1).collect()] == [7]
    lists = recommend.as_lists(ranked).collect()
    assert [(r.session_id, r["items"], r.scores) for r in lists] == [(1, [7, 8], [5.0, 5.0])]


def test_repeated_clicks_count_as_given(spark):
    weights = spark.createDataFrame([(1, 7, 5.0)], "click_item long, purchase_item long, weight double")
    seen = spark.createDataFrame([(1, 1), (1, 1)], "session_id long, click_item long")
    assert recommend.score(seen, weights).first().score == 10


def test_nothing_qualifies_gives_typed_empty_tables(tables):
    clicks, none = tables.clicks(CLICKS), tables.purchases([])
    items = ut.high_utility_items(none, AMOUNT(1000))
    assert items.columns == ["item_id", "utility"] and items.count() == 0
    relative = ut.high_utility_items(none, MinUtility.of_share("0.01"), nonnegative=True)
    assert relative.dtypes == [("item_id", "bigint"), ("utility", "decimal(28,2)")] and relative.count() == 0
    weights = matrix.utility_matrix(clicks, none, items)
    ranked = recommend.recommend(clicked(clicks), weights)
    assert ranked.columns == ["session_id", "rank", "item_id", "score"] and ranked.count() == 0
    assert recommend.as_lists(ranked).count() == 0
    found = patterns.high_utility_sequences(none, AMOUNT(1), 3)
    assert found.dtypes[0] == ("pattern", "array<array<bigint>>") and found.count() == 0
    assert sequences.frequent_sequences(tables.clicks([]), 0.5, 3).count() == 0
    assert sequences.click_sequences(tables.clicks([])).count() == 0


def test_utility_is_price_times_quantity(spark):
    df = spark.createDataFrame([(Decimal("1500.00"), 2)], "price decimal(18,2), quantity long")
    assert df.select(utility().alias("u")).first().u == Decimal("3000.00")


def test_category_kinds(spark):
    codes = ["S", "0", "1", "12", "13", "1234567890", "x", None]
    df = spark.createDataFrame([(c,) for c in codes], "category string")
    assert [r.k for r in df.select(category_kind().alias("k")).collect()] == [
        "offer", "missing", "category", "category", "brand", "brand", None, None
    ]


def test_threshold_bounds():
    assert MinUtility.of_share("0.01").max_items == 100
    assert MinUtility.of_share("0.3").max_items == 3
    assert MinUtility.of_amount(5).max_items is None
    with pytest.raises(ValueError):
        MinUtility.of_share("0")


def test_click_only_sessions_learn_from_buyers(tables):
    clicks, buys = tables.clicks([*CLICKS, (13, 1, B)]), tables.purchases(BUYS)
    weights = matrix.utility_matrix(clicks, buys, ut.high_utility_items(buys, AMOUNT(1000)))
    found = recommend.recommend(recommend.click_only(clicks, buys), weights)
    assert [(r.session_id, r.item_id, int(r.score)) for r in found.collect()] == [(13, A, 4500)]


@pytest.mark.parametrize("rows", [None, 2, BROADCAST_ROWS + 1])
def test_scores_do_not_depend_on_the_way_of_joining(tables, rows):
    clicks, buys = tables.clicks(CLICKS), tables.purchases(BUYS)
    weights = matrix.utility_matrix(clicks, buys, ut.high_utility_items(buys, AMOUNT(1000)))
    assert pairs(recommend.score(clicked(clicks), weights, rows), "session_id", "score") == {11: 13500, 12: 9000}


def test_held_out_sessions_do_not_teach_themselves(tables):
    clicks, buys = tables.clicks(CLICKS), tables.purchases(BUYS)
    found = recommend.recommend_held_out(clicks, buys, MinUtility.of_share("0.01"), folds=2)
    # Session 12 (fold 0) learns from 11 and session 11 (fold 1) from 12, whose clicks know only A.
    assert {(r.session_id, r.item_id, int(r.score)) for r in found.collect()} == {(12, A, 3000), (11, A, 1500)}
    with pytest.raises(ValueError):
        recommend.recommend_held_out(clicks, buys, AMOUNT(1))


def test_sequences_follow_time(tables):
    clicks = tables.clicks([(1, 9, 30), (1, 3, 10), (1, 5, 20), (2, 1, 7)])
    rows = {r.session_id: (r.part, r["items"], r.sequence) for r in sequences.click_sequences(clicks).collect()}
    assert rows == {1: (0, [10, 20, 30], [[10], [20], [30]]), 2: (0, [7], [[7]])}
    buys = tables.purchases([(1, 2, 5, 7), (1, 1, 6, 8)])
    first = sequences.purchase_sequences(buys).first()
    assert [(p.item_id, int(p.utility)) for p in first.purchases] == [(6, 8), (5, 7)]


def test_equal_events_stay_apart(tables):
    buys = tables.purchases([(1, 1, 4, 3), (1, 1, 4, 3), (1, 1, 2, 1)])
    assert mined(buys, 1, 3) == {"2": 1, "4": 3, "2>4": 4, "4>4": 6, "2>4>4": 7}
    clicks = buys.drop("utility", "event_id")
    found = sequences.frequent_sequences(clicks, 0.5, 3)
    shown = {r.s: r.freq for r in found.select(sequence_text("sequence").alias("s"), "freq").collect()}
    assert shown == {"2": 1, "4": 1, "2>4": 1, "4>4": 1, "2>4>4": 1}
    assert sequences.click_sequences(clicks).first()["items"] == [2, 4, 4]


def test_library_miner_agrees_with_the_distributed_one(tables):
    clicks = tables.clicks([(s, i, (s * i * 7) % 5) for s in range(1, 30) for i in range(1, 3 + s % 5)])
    ours = sequences.frequent_sequences(clicks, 0.1, 4)
    library = PrefixSpan(minSupport=0.1, maxPatternLength=4)
    theirs = library.findFrequentSequentialPatterns(sequences.click_sequences(clicks).select("sequence"))
    shown = [
        {(r.s, r.freq) for r in df.select(sequence_text("sequence").alias("s"), F.col("freq")).collect()}
        for df in (ours, theirs)
    ]
    assert shown[0] == shown[1] and len(shown[0]) > 20
