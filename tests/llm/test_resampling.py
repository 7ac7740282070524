"""The sample: which rows, from which models, by which scores."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from yieldlens.llm import resampling as rs


def prose(choose, bad: bool):
    good, ugly = [f"g{i}" for i in range(50)], [f"u{i}" for i in range(50)]
    return " ".join(choose.choices(good + (ugly * 3 if bad else []), k=choose.randint(40, 120)))


@pytest.fixture(scope="module")
def corpus(spark):
    choose = random.Random(1)
    rows = [(i, prose(choose, i % 4 == 0), "x") for i in range(800)]
    target = [(i,) for i, *_ in rows if i % 4 and i % 3 == 0]
    docs = spark.createDataFrame([*rows, (9000, None, "x"), (9001, "", "x"), (None, "g1 g2", "x"), rows[1], rows[1]], "doc_id long, text string, id string")
    return docs, spark.createDataFrame([*target, target[0], (None,), (777_777,)], "doc_id long")


def test_what_looks_like_the_target_is_kept(corpus):
    docs, target = corpus
    kept = {r.doc_id for r in rs.resampled(docs, target, rs.Sampling(share=0.75)).collect()}
    held_out = [i for i in range(800) if i % 3]
    assert np.mean([i in kept for i in held_out if i % 4]) > 0.95 and np.mean([i in kept for i in held_out if i % 4 == 0]) < 0.1


def test_ratios_are_those_of_counted_words(spark, corpus):
    docs, target = corpus
    chosen = {r.doc_id for r in target.collect()}
    rows = docs.collect()
    sampling = rs.Sampling(prior=(5.0,))
    marked = spark.createDataFrame([(r.text or "", r.doc_id in chosen and r.doc_id is not None) for r in rows], "text string, wanted boolean")
    ratios = rs.log_ratios(marked, "wanted", sampling)
    raw = Counter(w for r in rows for w in (r.text or "").split())
    good = Counter(w for r in rows if r.doc_id in chosen and r.doc_id is not None for w in (r.text or "").split())
    scale = sum(raw.values()) / sum(good.values())
    got = {round(float(x), 4) for x in ratios if x}
    assert got == {round(math.log((good[w] * scale + 5) / (raw[w] + 5)), 4) for w in raw} - {0.0}


def test_share_ties_and_no_target(spark, corpus):
    docs, target = corpus
    n = docs.count()
    for share in (0.0, 0.1, 0.5, 1.0):
        assert rs.resampled(docs, target, rs.Sampling(share=share)).count() in range(math.ceil(share * n), math.ceil(share * n) + 3)
    even = rs.resampled(docs, target.limit(0), rs.Sampling(share=0.5)).collect()
    assert {r.log_weight for r in even} == {0.0} and len(even) >= n // 2
    assert rs.resampled(docs.limit(0), target).count() == 0
    assert rs.resampled(docs, target).columns == ["doc_id", "log_weight", "score"]


def test_a_seed_draws_the_same_rows(corpus):
    docs, target = corpus
    draw = lambda seed, df: sorted((r.doc_id or -1, r.score) for r in rs.resampled(df, target.limit(0), rs.Sampling(share=0.3, seed=seed)).collect())
    assert draw(1, docs) == draw(1, docs.repartition(7)) != draw(2, docs)


def test_threshold_is_the_kth_largest(spark):
    choose = random.Random(2)
    values = [choose.gauss(0, 1) * 10 ** choose.randint(-6, 6) for _ in range(3000)] + [1.5] * 40
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for k in (1, 2, 500, 1500, 3039, 3040, 99999):
        assert rs.threshold(df, "s", k) == sorted(values, reverse=True)[min(k, len(values)) - 1]
    assert rs.threshold(df, "s", 0) is None and rs.threshold(df.limit(0), "s", 3) is None


def test_gumbel_is_gumbel(spark):
    from pyspark.sql import functions as F

    values = np.array([r[0] for r in spark.range(20_000).select(rs.gumbel(F.col("id"), 3)).collect()])
    assert abs(values.mean() - 0.5772) < 0.05 and abs(values.std() - math.pi / math.sqrt(6)) < 0.05
