"""Links and components against all pairs, on texts made of copies with few changes."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from yieldlens.llm import jaccard, links
from yieldlens.llm.storage import Workspace


def shingles(text: str | None, width: int) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def closure(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(texts: dict, alike: jaccard.Alike):
    sets = {i: shingles(t, alike.width) for i, t in texts.items()}
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= alike.per_cent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in closure(sets, pairs).items()}


def corpus(seed: int, bases: int, copies: int, size: int):
    """Groups of near copies of near copies, with a passage that many share."""
    choose = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "The"] * 60
    passage = choose.choices(vocabulary, k=30)
    texts = []
    for _ in range(bases):
        made = [choose.choices(vocabulary, k=choose.randint(1, size))]
        for _ in range(choose.randint(0, copies)):
            words = list(choose.choice(made))
            for _ in range(choose.randint(0, 4)):
                at = choose.randrange(len(words) + 1)
                words[at : at + choose.randint(0, 2)] = choose.choices(vocabulary, k=choose.randint(0, 2))
            made.append(words or ["x"])
        texts += [choose.choice([" ", "\n", "  "]).join(passage + w if choose.random() < 0.3 else w) for w in made]
    choose.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("width", "per_cent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 50, 3)])
def test_components_are_those_of_all_pairs(spark, width, per_cent, seed):
    texts = corpus(seed, 60, 12, 120) | {5000: None, 5001: "", 5002: " \n", 5003: "a b", 5004: "A  b", 5005: ""}
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts.items()], "doc_id long, text string, token string, id string")
    alike = jaccard.Alike(width, per_cent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs.repartition(5), alike).collect()}
    want = expected(texts, alike)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 20
    if width != 5:
        return
    kept = jaccard.one_of_each(docs, alike)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_one_large_group_of_near_copies_is_not_paired(spark, monkeypatch):
    choose = random.Random(5)
    base = [f"v{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 300):
        words = list(base)
        words[choose.randrange(150)] = f"x{i}"
        texts[i] = " ".join(words)
    texts[300] = " ".join(base[:40] + [f"y{i}" for i in range(100)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sizes = {}
    keep = Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: sizes.setdefault(name, keep(self, df, name)))
    counts = defaultdict(int)
    drop = Workspace.drop
    monkeypatch.setattr(Workspace, "drop", lambda self, *names: (counts.update({n: sizes[n].count() for n in names}), drop(self, *names)))
    got = {r.doc_id: r.component_id for r in jaccard.join_similar(docs, jaccard.Alike(3, 90)).collect()}
    assert got == {i: c for i, (_, c) in expected(texts, jaccard.Alike(3, 90)).items()}
    assert counts["near-pairs"] < 20 * len(texts) and counts["far-pairs"] < 20 * len(texts)


def test_repeated_rows_null_keys_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None), (7, text), (8, "else")], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.component_id) for r in jaccard.join_similar(docs, jaccard.Alike()).collect()), key=str)
    assert rows == [(1, 1), (1, 1), (7, 1), (8, 8), (None, None), (None, None)]
    assert jaccard.join_similar(docs.limit(0), jaccard.Alike()).count() == 0
    assert jaccard.join_similar(docs.filter("text IS NULL"), jaccard.Alike()).count() == 1


def test_shared_tokens_grow_with_costs():
    import numpy as np

    rare, common = np.full(80, 0.05), np.full(80, 50.0)
    assert 1 < jaccard.shared_tokens(rare, 500, 51, 450) <= jaccard.MOST_SHARED
    assert jaccard.shared_tokens(common, 5, 2, 1) == 1


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    choose = random.Random(seed)
    pairs = [(choose.randrange(300), choose.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 430)] + [(9, 9)]
    got = links.components(spark.createDataFrame(pairs, "a long, b long"), Workspace(spark, "test"))
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert {r.node: r.component for r in got.collect()} | {n: n for n in nodes - {r.node for r in got.collect()}} == closure(nodes, [p for p in pairs if p[0] != p[1]])
    assert links.components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).select(F.count("*")).first()[0] == 0


def test_repeated_rows_are_one_document(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(3, words, 1), (3, words, 1), (3, words, 2), (4, words, 1), (5, "other words " * 3, 1), (None, words, 1), (None, words, 1), (None, "x", 1), (9, "", 1), (9, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _again int")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "", r["_again"]) for r in kept.collect())
    assert got == sorted([(3, words, 1), (5, "other words " * 3, 1), (0, words, 1), (0, "x", 1), (9, "", 1)])
    assert jaccard.one_of_each(docs.limit(0)).count() == 0
