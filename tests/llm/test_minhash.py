"""Circulant MinHash against all pairs of whole sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from yieldlens.llm import minhash
from yieldlens.llm.links import of_keys
from yieldlens.llm.minhash import Bands


def sets(rows, width):
    """The union of the shingles of all rows of a key."""
    out = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(width, len(words))
        out.setdefault(key, []).append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset())
    return out


def brute(rows, width, per_cent):
    of = {k: v for k, v in sets(rows, width).items() if k is not None}
    parent = {k: k for k in of}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(of)
    for i, x in enumerate(keys):
        for y in keys[:i]:
            if any(a and b and 100 * len(a & b) >= per_cent * len(a | b) for a in of[x] for b in of[y]):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def check(df, width, per_cent, rows=None):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()] if rows is None else rows
    found = minhash.near_duplicates(df, Bands(width=width, per_cent=per_cent)).collect()
    wanted, sizes = brute(rows, width, per_cent), sets(rows, width)
    assert len(found) == len(rows)
    for row in found:
        assert row.n_shingles in {len(s) for s in sizes[row.doc_id]}
        assert row.component_id == wanted.get(row.doc_id)
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)


@pytest.mark.parametrize(("width", "per_cent"), [(2, 80), (5, 80)])
def test_documents(documents, width, per_cent):
    check(documents.withColumnsRenamed({"lang": "bucket", "source": "component"}), width, per_cent)


@pytest.mark.parametrize("cell", [2_000, 7])
def test_groups_of_near_copies_and_chains(spark, cell, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", cell)
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(120)]
    rows = []
    # A large group around one text, a chain in which each text is like the one before only, and a shared passage.
    for i in range(150):
        text = list(base)
        for _ in range(draw.randint(0, 7)):
            text[draw.randrange(len(text))] = "edit" + str(draw.randrange(10**6))
        rows.append((1000 + i, " ".join(text)))
    chain = [draw.choice(words) for _ in range(100)]
    for i in range(25):
        chain = chain[4:] + [f"link{i}{k}" for k in range(4)]
        rows.append((500 - i, " ".join(chain)))
    for i in range(60):
        rows.append((3000 + i, " ".join(base[:60] + [f"own{i}x{k}" for k in range(40)])))
    # Exact copies, two sets under one key, and a key that joins two groups.
    rows += [(7, rows[0][1]), (7, rows[160][1]), (8, rows[0][1]), (None, rows[0][1]), (9, ""), (9, None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {}
    for r in minhash.near_duplicates(df, Bands(width=2)).collect():
        found.setdefault(r.doc_id, set()).add(r.component_id)
    wanted = brute(rows, 2, 80)
    assert {k: v for k, v in found.items() if k is not None} == {k: {v} for k, v in wanted.items()}
    assert found[None] == {None}


def test_coordinates_agree_as_often_as_sets_are_alike():
    draw = np.random.Generator(np.random.PCG64(1))
    bands = Bands()
    for share in (0.5, 0.8, 0.95):
        agree = []
        for _ in range(40):
            common, rest = int(300 * share), 300 - int(300 * share)
            both = draw.integers(0, 2**63, common + rest, np.uint64)
            a, b = both[: common + rest // 2], np.append(both[:common], both[common + rest // 2 :])
            agree.append((minhash.signature(a, bands) == minhash.signature(b, bands)).mean())
        assert abs(np.mean(agree) - share) < 0.02


def test_sketches_agree_enough():
    bands = Bands()
    assert 340 < minhash.least_agreeing(bands) < 0.71 * 504
    draw = np.random.Generator(np.random.PCG64(7))
    least = 504
    for _ in range(300):
        both = draw.integers(0, 2**63, 250, np.uint64)
        a, b = (minhash.signature(s, bands).astype(np.uint8) for s in (both[:225], np.append(both[:200], both[225:])))
        least = min(least, int((a == b).sum()))
    # 200 of 250 in common.
    assert least >= minhash.least_agreeing(bands) + 10


def test_two_permutations_give_every_coordinate():
    bands = Bands(rows=2, bands=5, places=6)
    first, second = minhash.permutations(bands)
    assert sorted(first.tolist()) == list(range(64)) == sorted(second[:64].tolist())
    shingles = np.array([3, 77, 1000, 77], np.uint64)
    wanted = [min(int(second[:64][(int(first[x % 64]) + k) % 64]) for x in shingles.tolist()) for k in range(10)]
    assert minhash.signature(shingles, bands).tolist() == wanted


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    found = minhash.near_duplicates(empty)
    assert found.collect() == [] and dict(found.dtypes)["component_id"] == "int"


def test_rows_of_keys_are_found_where_they_lie(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in [*range(-500, 500), 7, 7, None]], "id bigint, text string")
    wanted = spark.createDataFrame([(i,) for i in [*range(-499, 500, 13), 10**12]], "id bigint")
    found = sorted(r.id for r in of_keys(rows, "id", wanted).collect())
    assert found == sorted([*range(-499, 500, 13)] + [7] * 2 * (7 in range(-499, 500, 13)))
    assert of_keys(rows, "id", wanted.limit(0)).count() == 0


def test_pairs_of_a_group_grow_no_faster_than_the_group(spark):
    """Near copies that no link joins: each has other words in its own places of one text, so sketches agree and no sets are alike enough."""
    bands, pairs = Bands(width=2), []
    words = [f"w{i}" for i in range(1_300)]
    for size in (20, 60):
        draw = random.Random(size)
        texts = [" ".join(w if draw.random() > 0.038 else f"x{k}-{i}" for i, w in enumerate(words)) for k in range(size)]
        sets_ = [minhash.shingle_set(next(minhash.word_hashes(iter([pa.RecordBatch.from_arrays([pa.array([0]), pa.array([t])], names=["id", "text"])])))[1][0], 2) for t in texts]
        rows = [(1, size, k, len(s), len(s), k, minhash.signature(s, bands).astype(np.uint8).tobytes()) for k, s in enumerate(sets_)]
        schema = "bucket bigint, members bigint, id bigint, low bigint, high bigint, component bigint, sketch binary"
        pairs.append(minhash._agreeing(spark.createDataFrame([(*r[:6], bytearray(r[6])) for r in rows], schema), bands).count())
    assert 10 < pairs[0] < 20 and 30 < pairs[1] < 60


def test_rows_of_a_bucket_move_once(spark):
    rows = spark.createDataFrame([(7, 1, 3), (7, 2, 4), (7, 2, 5), (8, 1, 3), (9, 4, 1), (9, 4, 2)], "bucket bigint, id bigint, n bigint")
    met = minhash._met(rows, "id")
    assert sorted(tuple(r) for r in met.select("bucket", "id", "n", "members").collect()) == [(7, 1, 3, 3), (7, 2, 4, 3), (7, 2, 5, 3)]
    plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan
