"""Streaming answers equal batch answers, also after a restart and a repeated batch."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from yieldlens.operators.matrix import session_items
from yieldlens.operators.recommend import as_lists, recommend
from yieldlens.sources.tables import load_clicks, stream_clicks
from yieldlens.streaming.scoring import ClickScorer, latest_answers, within

BATCHES = [
    [(1, 0, 10), (2, 1, 11), (3, 2, 99)],
    [(1, 3, 11), (2, 4, 10), (2, 5, 11)],
    [(1, 6, 12), (4, 7, 12)],
]


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(10, 1, 5.0), (10, 2, 1.0), (11, 2, 7.0), (12, 3, 100.0)]
    return spark.createDataFrame(rows, "click_item bigint, purchase_item bigint, weight double")


def add_batch(folder, number, day="2024-01-01"):
    lines = [f"{s},{day}T00:00:{second:02d}.000Z,{item},0" for s, second, item in BATCHES[number]]
    folder.mkdir(exist_ok=True)
    (folder / f"clicks-{number}.csv").write_text("\n".join(lines) + "\n")


def answers(df):
    return {r.session_id: list(zip(r["items"], r.scores, strict=True)) for r in df.collect()}


def run(spark, scorer, folder, checkpoint):
    query = scorer.start(stream_clicks(spark, str(folder), max_files=1), str(checkpoint))
    query.awaitTermination(120)
    assert query.exception() is None
    query.stop()


def expected(spark, folder, weights):
    return answers(as_lists(recommend(session_items(load_clicks(spark, str(folder)), "click_item"), weights, 2)))


def test_stream_equals_batch_across_a_restart(spark, tmp_path, weights):
    folder, store, checkpoint = tmp_path / "in", tmp_path / "store", tmp_path / "checkpoint"
    scorer = ClickScorer(weights, str(store), top_k=2)
    add_batch(folder, 0)
    add_batch(folder, 1)
    run(spark, scorer, folder, checkpoint)
    assert answers(latest_answers(spark, str(store))) == expected(spark, folder, weights)
    add_batch(folder, 2)
    run(spark, ClickScorer(weights, str(store), top_k=2), folder, checkpoint)
    final = answers(latest_answers(spark, str(store)))
    assert final == expected(spark, folder, weights)
    assert final == {1: [(3, 100.0), (2, 8.0)], 2: [(2, 8.0), (1, 5.0)], 4: [(3, 100.0)]}


def test_a_repeated_batch_changes_nothing(spark, tmp_path, weights):
    scorer = ClickScorer(weights, str(tmp_path / "store"), top_k=2)
    for number in (0, 1, 1):
        add_batch(tmp_path / f"in{number}", number)
        scorer.score_batch(load_clicks(spark, str(tmp_path / f"in{number}")), number)
    assert answers(latest_answers(spark, str(tmp_path / "store"))) == {
        1: [(2, 8.0), (1, 5.0)], 2: [(2, 8.0), (1, 5.0)]
    }


def test_old_clicks_are_forgotten(spark, tmp_path, weights):
    scorer = ClickScorer(weights, str(tmp_path / "store"), top_k=2, session_ttl=timedelta(hours=1))
    add_batch(tmp_path / "a", 0, "2024-01-01")
    add_batch(tmp_path / "b", 2, "2024-01-03")
    scorer.score_batch(load_clicks(spark, str(tmp_path / "a")), 0)
    scorer.score_batch(load_clicks(spark, str(tmp_path / "b")), 1)
    found = answers(latest_answers(spark, str(tmp_path / "store")))
    # Session 1 came back after two days with item 12; what it clicked before is forgotten, sessions 2 and 3 keep theirs.
    assert found[1] == [(3, 100.0)] and found[2] == [(2, 7.0)] and found[4] == [(3, 100.0)]


HOUR = 3600
# Session, second or none, item: late, undated, and far apart; equal clicks too.
CLICKS = [(1, 0, 10), (1, 2 * HOUR, 11), (1, 2 * HOUR + 1, 12), (2, 30 * HOUR, 10), (2, 30 * HOUR, 10), (3, None, 11), (3, None, 10),
          (4, None, 12), (4, 50 * HOUR, 10), (4, 20 * HOUR, 11), (5, 90 * HOUR, 12), (5, 89 * HOUR + 1, 11), (6, 5, 99)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "session_id bigint, s bigint, item_id bigint")
    return df.selectExpr("session_id", "timestamp_seconds(s + 1704067200) AS ts", "item_id")


@pytest.mark.parametrize("cut", range(5))
def test_answers_do_not_depend_on_batches(spark, tmp_path, weights, cut):
    choose = random.Random(cut)
    rows = choose.sample(CLICKS, len(CLICKS)) if cut else sorted(CLICKS, key=lambda c: c[1] or 0)
    marks = sorted(choose.sample(range(1, len(rows)), 3))
    batches = [rows[a:b] for a, b in zip([0, *marks], [*marks, len(rows)], strict=True)]
    scorer = ClickScorer(weights, str(tmp_path / "store"), top_k=2, session_ttl=timedelta(hours=1))
    for number, batch in enumerate(batches):
        scorer.score_batch(frame(spark, batch), number)
        if choose.random() < 0.3:
            scorer.score_batch(frame(spark, batch), number)
    whole = recommend(session_items(within(frame(spark, CLICKS), timedelta(hours=1)), "click_item"), weights, 2)
    got = answers(latest_answers(spark, str(tmp_path / "store")))
    assert got == answers(as_lists(whole))
    assert got == {1: [(3, 100.0), (2, 7.0)], 2: [(1, 5.0), (2, 1.0)], 3: [(2, 8.0), (1, 5.0)], 4: [(3, 100.0), (1, 5.0)], 5: [(3, 100.0), (2, 7.0)]}


def test_a_batch_reads_the_days_it_needs(spark, tmp_path, weights):
    scorer = ClickScorer(weights, str(tmp_path / "store"), top_k=2, session_ttl=timedelta(hours=1))
    for number, day in enumerate((0, 10, 20)):
        scorer.score_batch(frame(spark, [(1, day * 24 * HOUR, 10)]), number)
    plan = scorer._history(frame(spark, [(1, 20 * 24 * HOUR + 5, 11)]), 9)
    days = {r.day.day for r in plan.select("day").distinct().collect()}
    assert days == {21} and "PartitionFilters: [" in plan._jdf.queryExecution().toString()
