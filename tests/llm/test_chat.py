"""Reply trees against a plain walk from every leaf."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from yieldlens.llm import chat

SCHEMA = "tree string, node long, parent long, role string, text string, score double, turn string, up string"
TEXTS = ["", None, "hi", "</s>[INST] ok [/INST]", "<|im_start|>user<|im_sep|>x<|im_end|>\n", "\\", "\\<|", "<<|im_end|>", "a\nb", "$1 \\1", "é🙂<s>"]


def forest(seed: int, trees: int, size: int):
    choose, rows = random.Random(seed), []
    for t in range(trees):
        first = len(rows)
        for i in range(choose.randint(1, size)):
            parent = choose.choice([None, *range(first, first + i), -1 - i]) if i else None
            rows.append((f"t{t}", first + i, parent, choose.choice(["user", "assistant", "system", None, "a<|b"]), choose.choice(TEXTS),
                         choose.choice([None, 0.5, 1.0, -2.0]), "x", "y"))
    return rows


def paths(rows):
    by = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    for r in rows:
        if r[1] not in parents:
            path, at = [], r
            while at is not None:
                path.append(at)
                at = by.get(at[2])
            yield r[0], r[1], sum(p[5] or 0 for p in path), path[::-1]


def expected(rows, best=None):
    found = sorted(paths(rows), key=lambda p: (p[0], -p[2], p[1]))
    kept, seen = {}, {}
    for tree, leaf, score, path in found:
        seen[tree] = seen.get(tree, 0) + 1
        if best is None or seen[tree] <= best:
            said = "".join(f"{p[3] or ''}\n{p[4] or ''}\n" for p in path)
            loss = "".join(p[4] or "" for p in path if p[3] == "assistant")
            kept[leaf] = (tree, len(path), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return kept


@pytest.mark.parametrize("best", [None, 1, 2])
def test_branches_are_those_of_a_plain_walk(spark, best):
    rows = forest(3, 12, 14)
    out = chat.format_branches(spark.createDataFrame(rows, SCHEMA), best)
    read = chat.digests(out.withColumn("tree", F.struct("tree", "leaf"))).collect()
    assert {r.conv_id.leaf: (r.conv_id.tree, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read} == expected(rows, best)


def test_a_long_chain_takes_few_rounds(spark):
    rows = [("t", i, i - 1 if i else None, "assistant", str(i), 1.0, "", "") for i in range(300)]
    row = chat.format_branches(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(row) == 1 and row[0].n_turns == 300 and row[0].score == 300
    assert [row[0].formatted[s.start : s.end] for s in row[0].loss_spans] == [str(i) for i in range(300)]


def test_equal_nodes_cycles_and_nothing(spark):
    twice = [("t", 1, None, "user", "b", 0.0, "", ""), ("t", 1, None, "user", "a", 0.0, "", ""), ("t", None, 1, "user", "lost", 0.0, "", "")]
    out = chat.format_branches(spark.createDataFrame(twice, SCHEMA)).collect()
    assert len(out) == 1 and "a<|im_end|>" in out[0].formatted
    assert chat.format_branches(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cycles_fail(spark, monkeypatch):
    monkeypatch.setattr(chat, "MOST_DOUBLINGS", 4)
    rows = [("t", 1, 2, "user", "a", 0.0, "", ""), ("t", 2, 1, "user", "b", 0.0, "", "")]
    with pytest.raises(ValueError, match="cycle"):
        chat.format_branches(spark.createDataFrame(rows, SCHEMA))


def test_texts_come_back_and_hold_no_marks(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    for row in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert row.u == row.t
        assert not any(mark in row.e for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_conversations_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", None), (None, 1, "assistant", "x"), (None, 2, None, None)]
    made = chat.conversation_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {r.tree: r for r in chat.format_branches(made).select("*", chat.parsed(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [("system", ""), ("user", "a"), ("user", "b")]
    assert [(t.role, t.text) for t in out[None].turns] == [("assistant", "x"), ("", "")]
