"""Benchmark passages: pieces and Myers' distance against plain dynamic programming."""

from __future__ import annotations

import random

import numpy as np
import pytest

from yieldlens.llm import contamination as c

LETTERS = "abcdé "


def distances(pattern: str, text: str) -> list[int]:
    column, out = list(range(len(pattern) + 1)), []
    for t in text:
        above, column[0] = column[0], 0
        for i, p in enumerate(pattern, 1):
            above, column[i] = column[i], min(above + (p != t), column[i] + 1, column[i - 1] + 1)
        out.append(column[-1])
    return out


def edited(choose: random.Random, text: str, edits: int) -> str:
    for _ in range(edits):
        i, kind = choose.randrange(len(text)), choose.randrange(3)
        text = text[:i] + (choose.choice("xyz") if kind else "") + text[i + (kind != 1) :]
    return text


def test_myers_is_the_distance_of_the_table():
    choose = random.Random(1)
    for _ in range(300):
        pattern = "".join(choose.choices(LETTERS, k=choose.randint(1, 90)))
        text = "".join(choose.choices(LETTERS, k=choose.randint(0, 60)))
        assert c.myers(pattern, text) == distances(pattern, text)


def words(choose: random.Random, n: int) -> str:
    return " ".join("".join(choose.choices("abcdefghijé", k=choose.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def cases():
    choose = random.Random(7)
    items = [(i, words(choose, choose.randint(6, 40))) for i in range(10)]
    texts = []
    for i in range(60):
        number, item = choose.choice(items)
        normal = c.normal_text(item)
        inside = edited(choose, normal, choose.randint(0, c.errors_allowed(len(normal)) + 4))
        inside = choose.choice([inside, inside.upper(), inside.replace(" ", "%%% "), inside.replace(" ", "\n– ")])
        texts.append(words(choose, choose.randint(0, 30)) + ". " + inside * (i % 3 != 0) + " " + words(choose, choose.randint(0, 30)))
    return items, texts + ["", " ", "é", "a" * 50]


def test_every_passage_is_found_and_nothing_else(spark, cases):
    items, texts = cases
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, items[0][1], None), (999, None, None)], "doc_id long, text string, item string")
    bench = spark.createDataFrame([*items, (100, None), (101, "too short"), (102, "")], "item_id long, text string")
    rows = c.contaminated(docs, bench).collect()
    found = {(r.doc_id, r.item_id): r for r in rows}
    assert (None, 0) in found and 999 not in {r.doc_id for r in rows}
    for d, text in enumerate(texts):
        normal = c.normal_text(text)
        for i, item in items:
            pattern = c.normal_text(item)
            best = min(distances(pattern, normal), default=len(pattern))
            assert ((d, i) in found) == (best <= c.errors_allowed(len(pattern))), (d, i, best)
            if (d, i) in found:
                r = found[d, i]
                assert r.errors == best
                cut = c.normal_text(text[r.start : r.end])
                assert abs(len(cut) - len(pattern)) <= c.errors_allowed(len(pattern))
                assert min(distances(pattern, cut)) == best


def test_blocks_and_small_slices_change_nothing(spark, cases, monkeypatch):
    items, texts = cases
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, c.contaminated(docs, bench).collect()))
    monkeypatch.setattr(c, "BLOCK_PIECES", 20)
    monkeypatch.setattr(c, "SLICE_BYTES", 100)
    assert sorted(map(tuple, c.contaminated(docs, bench).collect())) == whole


def test_no_rows_and_clean_documents(spark, cases):
    items, texts = cases
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert c.contaminated(docs, none).count() == 0
    assert c.contaminated(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    bench = spark.createDataFrame(items, "item_id long, text string")
    held = {r.doc_id for r in c.contaminated(docs, bench).collect()}
    kept = c.clean_documents(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(len(texts))) - held


def test_grams_tell_places():
    data = np.frombuffer(b"abcdefghijklabcdefghij", np.uint8)
    grams = c._grams(data)
    assert len(grams) == len(data) - c.GRAM + 1 and grams[0] == grams[12] and len(set(grams.tolist())) == len(grams) - 1


def test_rows_are_judged_by_their_own_text(spark, cases):
    """Keys that are null or shared, and columns called like the operator's own."""
    items, _ = cases
    bad = items[0][1]
    rows = [(None, bad), (None, "a clean text"), (None, None), (5, bad), (5, "another clean text"), (6, "clean"), (6, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _held", "2 AS _hash", "3 AS hash", "4 AS key")
    kept = c.clean_documents(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((k or 0, t or "") for k, t in rows if t != bad)
