"""Counts of the quality rules against plain Python, and what the verdicts do."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from yieldlens.llm import oracles
from yieldlens.llm import quality as ql

WORD = r"[^\x20\x09-\x0D]+"


def counts(text: str):
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(documents):
    out = ql.quality_verdicts(documents).collect()
    given = documents.collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in out), key=key) == sorted(((r.doc_id, *counts(r.text or "")) for r in given), key=key)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_classes_add_up(documents):
    got = ql.features(documents, "f").select("text", "f.*").collect()
    for r in got:
        text = "".join(re.findall(WORD, r.text or ""))
        plain = [sum(a <= c <= b for c in text) for a, b in ("az", "AZ", "09")]
        assert r.classes[:3] == plain and sum(r.classes) == len(text) and r.classes[5] == sum(not "!" <= c <= "~" for c in text)


def test_distance(spark):
    rows = [([1.0, 0.0], [0.0, 1.0], 1.0), ([0.5, 0.5], [0.5, 0.5], 0.0), ([0.25, 0.75], [0.5, 0.5], None)]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>, d double")
    for r in df.withColumn("got", ql.jensen_shannon(F.col("p"), F.col("q"))).collect():
        m = [(a + b) / 2 for a, b in zip(r.p, r.q, strict=True)]
        kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m, strict=True) if a)  # noqa: E731, B023
        assert r.got == pytest.approx(math.sqrt((kl(r.p) + kl(r.q)) / 2)) and (r.d is None or r.got == pytest.approx(r.d))


def test_good_documents_keep_their_columns(documents):
    more = documents.withColumns({"_quality": F.lit(1), "_quality_0": F.lit(2), "kept": F.lit(3)})
    good = ql.good_documents(more)
    assert good.columns == more.columns
    kept = Counter(r.doc_id for r in ql.quality_verdicts(documents).filter("kept").collect())
    assert Counter(r.doc_id for r in good.collect()) == kept and kept


def test_junk_goes_and_prose_stays(documents):
    verdict = {r.doc_id: r for r in ql.quality_verdicts(documents).collect()}
    judged = [r for r in documents.collect() if r.doc_id in verdict and verdict[r.doc_id].n_words >= 150]
    junk = [r for r in judged if len(re.findall(r"[%&$#*]{3}|(?<!\S)\|(?!\S)", r.text)) > 0.3 * len(r.text.split())]
    prose = [r for r in judged if r.lang in ql.COMMON_WORDS and not re.search(r"[%&$#*|!]{2}|\|", r.text) and not verdict[r.doc_id].base_failed]
    assert junk and not any(verdict[r.doc_id].kept for r in junk)
    assert len(prose) > 50 and all(verdict[r.doc_id].kept for r in prose)


def test_nothing(documents):
    assert ql.quality_verdicts(documents.limit(0)).count() == 0
    assert ql.good_documents(documents.limit(0)).count() == 0


def test_code_and_sql_have_one_rule(spark):
    """Rare languages, other scripts, and documents of 50 to 99 words."""
    choose = random.Random(4)

    def prose(n, letters):
        return " ".join("".join(choose.choice(letters) for _ in range(choose.randint(2, 9))) for _ in range(n))

    latin, greek = "etaoinshrdlucmfw", "αβγδεζηθικλμνξοπ"
    junk = " ".join(f"|{i}#%&$*" for i in range(80))
    common = " ".join(f"the of and to a in is that it {prose(9, latin)}" for _ in range(4))
    rows = [(i, f"{common} {prose(n, latin)}", "en") for i, n in enumerate(range(10, 60))]
    # Alone, the junk of a rare language would be its measure.
    rows += [(100, prose(70, latin), "zz"), (101, junk * 20, "zz"), (102, prose(60, greek), "el"), (103, junk, "el"), (104, prose(60, latin), None)]
    rows += [(200 + i, prose(60 + i, latin), "en") for i in range(3)] + [(300 + i, f"| {i} " * 3 + prose(60, "0123456789|"), "en") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    mine = {r.doc_id: r.kept for r in ql.quality_verdicts(df).collect()}
    db = duckdb.connect()
    db.register("made", df.toPandas())
    theirs = dict(db.execute(f"WITH {oracles.quality('made')} SELECT doc_id, kept FROM verdicts").fetchall())
    assert mine == theirs
    assert mine[100] and not mine[101] and mine[102] and not mine[103] and mine[104]
    assert all(mine[i] for i in range(50)) and not any(mine[300 + i] for i in range(3))


def test_rare_languages_are_judged(spark):
    """What stands beside a language in others does not change its verdicts."""
    words = "array_join(transform(sequence(1, {n}), i -> {word}), ' ')"
    plain = words.format(n=60, word="translate(cast(id * 1000 + i * 7919 AS string), '0123456789', 'etaoinshrd')")
    signs = words.format(n=55, word="concat('|#', cast(i AS string), '%$&*')")
    rare = spark.range(20).selectExpr("id AS doc_id", f"CASE WHEN id = 0 THEN {signs} ELSE {plain} END AS text", "'qq' AS lang")
    beside = spark.range(100, 160).selectExpr("id AS doc_id", f"{words.format(n=15000, word="concat('w', cast(id * 20000 + i AS string))")} AS text", "'en' AS lang")
    size = lambda df: df.agg(F.sum(F.length(F.translate("text", " ", "")))).first()[0]
    assert size(rare) < 0.001 * size(beside)
    both = {r.doc_id: r.kept for r in ql.quality_verdicts(rare.union(beside)).filter("doc_id < 100").collect()}
    alone = {r.doc_id: r.kept for r in ql.quality_verdicts(rare).collect()}
    assert both == alone == {i: i != 0 for i in range(20)}
