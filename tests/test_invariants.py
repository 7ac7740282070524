"""Properties that must hold on any table, and brute force on tiny ones."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import pairs
from yieldlens.functions.columns import sequence_text
from yieldlens.functions.threshold import MinUtility
from yieldlens.operators import matrix, patterns, profile, recommend, sequences
from yieldlens.operators import utility as ut

SEEDS = [1, 2]
AMOUNT = MinUtility.of_amount


def random_rows(seed, sessions=12, longest=6, items=4):
    chance = random.Random(seed)
    return [
        (s, n if chance.random() < 0.7 else max(0, n - 1), chance.randint(1, items), chance.randint(0, 9))
        for s in range(sessions)
        for n in range(chance.randint(1, longest))
    ]


def unique_times(rows):
    """The same events at distinct times."""
    return [(s, n, item, u) for n, (s, _, item, u) in enumerate(rows)]


@pytest.fixture(scope="module", params=SEEDS)
def rows(request):
    return random_rows(request.param)


def brute_force(rows, longest, itemsets):
    """Best match of every pattern per session, summed, by trying all choices of events."""
    total = {}
    for session in {r[0] for r in rows}:
        merged = {}
        for s, t, item, u in rows:
            if s == session:
                merged[t, item] = merged.get((t, item), 0) + u
        events = sorted(merged.items())
        best = {}
        for size in range(1, longest + 1):
            for chosen in itertools.combinations(events, size):
                places = [t for (t, _), _ in chosen]
                if not itemsets and len(set(places)) < size:
                    continue
                text = "".join(
                    ("" if n == 0 else "+" if places[n] == places[n - 1] else ">") + str(item)
                    for n, ((_, item), _) in enumerate(chosen)
                )
                best[text] = max(best.get(text, 0), sum(u for _, u in chosen))
        for text, value in best.items():
            total[text] = total.get(text, 0) + value
    return total


@pytest.mark.parametrize("least", [1, 12, 25])
def test_patterns_against_brute_force(tables, rows, least):
    events = unique_times(rows)
    found = patterns.high_utility_sequences(tables.purchases(events), AMOUNT(least), 4)
    got = {r.p: int(r.utility) for r in found.select(sequence_text("pattern").alias("p"), "utility").collect()}
    assert got == {p: u for p, u in brute_force(events, 4, False).items() if u >= least}


@pytest.mark.parametrize("least", [1, 20])
def test_itemset_patterns_against_brute_force(tables, rows, least):
    found = patterns.high_utility_sequences(tables.purchases(rows), AMOUNT(least), 3, ["ts"], singletons=False)
    got = {r.p: int(r.utility) for r in found.select(sequence_text("pattern").alias("p"), "utility").collect()}
    assert got == {p: u for p, u in brute_force(rows, 3, True).items() if u >= least}


def test_frequent_sequences_against_brute_force(tables, rows):
    events = unique_times(rows)
    found = sequences.frequent_sequences(tables.clicks([r[:3] for r in events]), 0.25, 4)
    got = {r.p: r.freq for r in found.select(sequence_text("sequence").alias("p"), "freq").collect()}
    held = {}
    for session in {r[0] for r in events}:
        mine = [r[2] for r in sorted(events, key=lambda r: r[1]) if r[0] == session]
        for size in range(1, 5):
            for chosen in set(itertools.combinations(mine, size)):
                held.setdefault(">".join(map(str, chosen)), set()).add(session)
    least = 0.25 * len({r[0] for r in events})
    assert got == {p: len(s) for p, s in held.items() if len(s) >= least}


def test_shards_and_bounds(tables, rows):
    buys = tables.purchases(unique_times(rows))
    spent = pairs(ut.item_utility(buys), "item_id", "utility")
    weighted = pairs(ut.swu(buys), "item_id", "swu")
    assert all(spent[i] <= weighted[i] for i in spent)
    assert weighted == pairs(ut.promising_items(buys, AMOUNT(0)), "item_id", "swu")
    assert weighted == pairs(ut.promising_items(buys, AMOUNT(0), hot=False), "item_id", "swu")
    total = sum(spent.values())
    exact = pairs(ut.high_utility_items(buys, AMOUNT(20)), "item_id", "utility")
    assert exact == {i: u for i, u in spent.items() if u >= 20}
    assert exact == pairs(ut.high_utility_items(buys, AMOUNT(20), nonnegative=True), "item_id", "utility")
    share = MinUtility.of_share(str(20 / float(total))[:8])
    assert set(pairs(ut.high_utility_items(buys, share, nonnegative=True), "item_id", "utility")) >= set(exact)
    assert set(pairs(ut.high_utility_items(buys, AMOUNT(40)), "item_id", "utility")) <= set(exact)
    one = pairs(ut.high_utility_items_by_shard(buys, AMOUNT(20), 1), "item_id", "utility")
    assert one == exact
    for shards in (2, 3):
        most = pairs(ut.high_utility_items_by_shard(buys, AMOUNT(5), shards, "max"), "item_id", "utility")
        summed = pairs(ut.high_utility_items_by_shard(buys, AMOUNT(5), shards, "sum"), "item_id", "utility")
        assert all(most[i] <= summed[i] <= spent[i] for i in most)


def test_top_k_is_a_prefix_and_partitioning_does_not_matter(spark, tables, rows):
    buys = tables.purchases(unique_times(rows))
    clicks = tables.clicks([(s, t, 1 + (item * 3 + t) % 5) for s, t, item, _ in unique_times(rows)])

    def ranked(k, clicks=clicks, buys=buys):
        weights = matrix.utility_matrix(clicks, buys, ut.high_utility_items(buys, AMOUNT(5)))
        return {tuple(r) for r in recommend.recommend(matrix.session_items(clicks, "click_item"), weights, k).collect()}

    three, two = ranked(3), ranked(2)
    assert two == {r for r in three if r[1] <= 2} and three
    assert ranked(3, clicks.repartition(7), buys.repartition(5)) == three
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        assert ranked(3) == three
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_both_matrix_forms_agree(tables, rows):
    buys = tables.purchases(unique_times(rows))
    clicks = tables.clicks([(s, t, 1 + (item * 3 + t) % 5) for s, t, item, _ in unique_times(rows)])
    items = ut.high_utility_items(buys, AMOUNT(15))
    counts = matrix.cps(clicks, buys)
    built = matrix.whuom(counts, items), matrix.whuom_left(counts, items), matrix.utility_matrix(clicks, buys, items)
    forms = [
        sorted(map(tuple, df.select("click_item", "purchase_item", F.col("weight").cast("double")).collect()))
        for df in built
    ]
    assert forms[0] == forms[1] == forms[2]


@pytest.mark.parametrize("values", [[5], [5, 5, 5], [1, 2], list(range(1, 400)), [1] * 50 + [10**9]])
@pytest.mark.parametrize("fraction", ["0", "0.5", "0.95", "1"])
def test_quantile_interpolates(spark, values, fraction):
    df = spark.createDataFrame([(v,) for v in values], "v bigint").selectExpr("CAST(v AS DECIMAL(18,2)) AS price")
    got = float(profile.quantile(df, "price", fraction).first()[0])
    place = (len(values) - 1) * float(fraction)
    low = int(place)
    want = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("fraction", ["0", "0.2", "0.5", "0.951", "1"])
@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantile_by_ranges(spark, fraction, accuracy, monkeypatch):
    """Never more than a few values are put in order, also where they crowd together or lie far apart."""
    monkeypatch.setattr(profile, "FEW", 1)
    monkeypatch.setattr(profile, "ACCURACY", accuracy)
    choose = random.Random(1)
    values = sorted([choose.random() for _ in range(300)] + [1e9 + choose.random() for _ in range(300)] + [5.0] * 40 + [-3.5])
    df = spark.createDataFrame([(v,) for v in values], "price double")
    got = profile.quantile(df, "price", fraction).first()[0]
    place = (len(values) - 1) * float(fraction)
    low = int(place + 1e-9)
    assert got == pytest.approx(values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low), rel=1e-9)
    assert profile.quantile(df.limit(0), "price", fraction).first()[0] is None


@pytest.mark.parametrize("few", [1, 5000])
@pytest.mark.parametrize("fraction", ["0", "0.5", "0.9", "0.999", "1"])
def test_quantile_with_values_beyond_numbers(spark, fraction, few, monkeypatch):
    """Infinities lie at the ends, NaN behind them, and nothing is divided by their distance."""
    monkeypatch.setattr(profile, "FEW", few)
    values = [float("-inf")] * 3 + [v / 8 for v in range(6000)] + [float("inf")] * 2 + [float("nan")] * 2
    df = spark.createDataFrame([(v,) for v in reversed(values)], "price double").repartition(4)
    began = time.monotonic()
    got = profile.quantile(df, "price", fraction).first()[0]
    place = (len(values) - 1) * float(fraction)
    low, share = int(place), place - int(place)
    want = values[low] if share < 1e-9 else values[low] + (values[low + 1] - values[low]) * share
    assert got == pytest.approx(want, nan_ok=True) and time.monotonic() - began < 30


def test_quantile_of_values_that_a_double_can_not_tell(spark):
    df = spark.range(1000).selectExpr("CAST(id + 12345678901234567890123 AS DECIMAL(38,0)) AS price")
    assert int(profile.quantile(df, "price", "1").first()[0]) == 12345678901234567890123 + 999
    assert int(profile.quantile(df, "price", "0").first()[0]) == 12345678901234567890123


def test_quantile_reads_its_input_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(3000).selectExpr("CAST(id AS DOUBLE) AS price").mapInArrow(count, "price double")
    assert profile.quantile(df, "price", "0.5").first()[0] == 1499.5 and read.value == 6000


def test_histogram_of_one_value_and_empty_bins(spark):
    same = spark.createDataFrame([(5,)] * 4, "v bigint").selectExpr("CAST(v AS DECIMAL(18,2)) AS price")
    bins = {r.bin: r["rows"] for r in profile.histogram(same, fraction=None).collect()}
    assert bins == {1: 4} | {b: 0 for b in range(2, 21)}
    few = spark.createDataFrame([(0,), (5,), (10,), (20,)], "v bigint").selectExpr("CAST(v AS DECIMAL(18,2)) AS price")
    bins = {r.bin: r["rows"] for r in profile.histogram(few, bins=4, fraction=None).collect()}
    assert bins == {1: 2, 2: 1, 3: 0, 4: 1}


def test_popularity_takes_whole_items(tables):
    clicks = tables.clicks([(s, s, item) for item, n in enumerate([6, 2, 2, 1, 1]) for s in range(n)])
    row = profile.popularity_share(clicks, "0.4").first()
    assert (row["items"], row.top_items, row.events, row.top_events) == (5, 2, 12, 8)


@pytest.mark.parametrize("seed", range(3))
def test_top_unseen_is_the_top_of_what_was_not_bought(spark, tables, seed):
    draw = random.Random(seed)
    rows = [(s, i, float(draw.randint(1, 4))) for s in range(12) for i in range(draw.randint(0, 15))]
    scores = spark.createDataFrame([*rows, (None, 1, 2.0), (None, 2, 3.0)], "session_id bigint, item_id bigint, score double")
    buys = tables.purchases([(s, 1, draw.randint(0, 20), 1) for s in range(2, 14) for _ in range(draw.randint(0, 12))])
    wanted = recommend.top_items(recommend.without_bought(scores, buys), 3)
    assert sorted(map(str, recommend.top_unseen(scores, buys, 3).collect())) == sorted(map(str, wanted.collect()))


def test_top_unseen_shuffles_few_scores_again(spark, tables):
    scores = spark.range(40_000).selectExpr("id % 20 AS session_id", "id AS item_id", "CAST(id AS DOUBLE) AS score")
    scores = scores.repartition(4, "session_id")
    found = recommend.top_unseen(scores, tables.purchases([(1, 1, 39_981, 1)]), 2)
    assert {r.item_id for r in found.collect() if r.session_id == 1} == {39_961, 39_941}
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Ranked before anything of the scores is dealt by session and item.
    dealt = plan.index("hashpartitioning(session_id#", plan.index("LeftAnti")) if "Exchange hashpartitioning(session_id" in plan else plan.index("LeftAnti")
    assert "(rank#" in plan[dealt:]
