"""Hard negatives of the R-tree against a scan of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.llm import rtree
from yieldlens.llm.rtree import Best, Mining, Tree

SCHEMA = "vec_id bigint, label int, vector array<bigint>"


def brute(rows, mining=Mining(), every=5):
    usable = [(i, c, v) for i, c, v in rows if i is not None and c is not None and v is not None and None not in v]
    dot = lambda v, w: sum(a * b for a, b in zip(v, w, strict=False))
    out = []
    for anchor, label, vector in (r for r in usable if r[0] % every == 0):
        scored = sorted((-dot(vector, v), i, c) for i, c, v in usable if i != anchor)
        for score, positive, _ in [s for s in scored if s[2] == label][: mining.positives]:
            low, high = -mining.low * score, -mining.high * score
            fits = [s for s in scored if s[2] != label and low <= -100 * s[0] <= high][: mining.negatives]
            out += [(anchor, positive, k, i, -score, -s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **how):
    return sorted(tuple(r) for r in rtree.hard_negatives(df, F.col("vec_id") % 5 == 0, **how).collect())


def made(n, width, most, seed, labels=4):
    draw = random.Random(seed)
    return [(i, draw.randrange(labels), [draw.randint(-most // 3, most) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("tile", [16, 50, 8192])
def test_small_numbers_with_many_ties(spark, monkeypatch, tile):
    monkeypatch.setattr(rtree, "TILE", tile)
    monkeypatch.setattr(rtree, "ASKED", 7)
    rows = made(150, 3, 6, 1)
    # Many equal vectors, which are one place of the order.
    rows += [(1000 + i, i % 3, [2, 2, 1]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit(1)).withColumn("kind", F.lit("x"))
    assert mined(df) == brute(rows)


def test_other_windows(spark):
    rows = made(120, 4, 40, 2)
    mining = Mining(positives=2, negatives=7, low=10, high=100)
    assert mined(spark.createDataFrame(rows, SCHEMA), mining=mining) == brute(rows, mining)


def test_awkward_rows(spark):
    rows = made(60, 3, 9, 4, labels=2)
    rows += [(None, 1, [1, 2, 3]), (100, None, [1, 2, 3]), (105, 1, None), (110, 1, [1, None, 3]), (115, 1, []), (120, 0, [5]), (125, 77, [9, 9, 9])]
    # A key twice: rows of their own, never partners.
    rows += [(130, 0, [7, 7, 7]), (130, 1, [6, 7, 8]), (31, 1, [4, 4, 4]), (31, 1, [4, 4, 4])]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("size", [10**3, 10**6, 2**29])
def test_sums_are_exact(spark, size):
    # Beyond what 32 and 64 bit floats hold.
    draw = random.Random(size)
    rows = [(i, i % 2, [size + draw.randint(0, 3) for _ in range(4)]) for i in range(40)]
    found = mined(spark.createDataFrame(rows, SCHEMA), mining=Mining(low=50, high=100))
    assert found and found == brute(rows, Mining(low=50, high=100))


def test_nothing_to_mine(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(5, 1, [1])], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, 1, [1]), (2, 2, [1])], SCHEMA)) == []


def test_boxes_bound_their_rows_and_prune(monkeypatch):
    monkeypatch.setattr(rtree, "LEAF", 4)
    monkeypatch.setattr(rtree, "FANOUT", 3)
    monkeypatch.setattr(rtree, "AT_ONCE", 1)
    draw = np.random.Generator(np.random.PCG64(2))
    centres = draw.integers(-500, 500, (20, 6))
    vectors = (centres[draw.integers(0, 20, 400)] + draw.integers(-9, 9, (400, 6))).astype(np.int64)
    tree = Tree(np.arange(400), draw.integers(0, 3, 400), vectors)
    assert sorted(tree.ids.tolist()) == list(range(400)) and len(tree.children[-1]) <= 3
    asked = draw.integers(-300, 300, (5, 6))
    for lower, upper, vector in tree.bounds(asked):
        scores = (tree.vectors @ vector.astype(np.int64)).tolist()
        for leaf in range(tree.leaves):
            assert all(lower[leaf] <= s <= upper[leaf] for s in scores[leaf * 4 : leaf * 4 + 4])
        for box, children in enumerate(tree.children):
            assert all(lower[box] <= lower[c] and upper[c] <= upper[box] for c in children)
        best, seen = Best(5), []
        monkeypatch.setattr(Best, "offer", lambda self, ids, s, plain=Best.offer: (seen.append(len(ids)), plain(self, ids, s)))
        tree.search(vector, lower, upper, None, None, [best])
        monkeypatch.undo()
        monkeypatch.setattr(rtree, "LEAF", 4)
        monkeypatch.setattr(rtree, "AT_ONCE", 1)
        wanted = sorted((-s, i) for i, s in zip(tree.ids.tolist(), scores, strict=True))[:5]
        assert best.rows == wanted and sum(seen) < 200
