"""Every stage against plain Python over the whole small documents."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.conftest import SMALL
from tests.llm.test_contamination import distances
from tests.llm.test_jaccard import expected
from tests.llm.test_packing import checked
from tests.llm.test_secrets import base
from yieldlens.llm import contamination as c
from yieldlens.llm.oracles import quality


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage, and those of the last; the documents hold some cases put there."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    prose = next(r for r in docs.orderBy("doc_id").collect() if r.lang == "en" and 200 < len(r.text.split()) < 400 and "|" not in r.text and "%" not in r.text)
    words = prose.text.split(" ")
    other = " ".join(reversed(words))
    planted = [
        (90_001, " ".join([*words[:-1], "changed"]), "en", "p", 0),
        (90_002, f"{other} {item[:50]}x{item[51:]}", "en", "p", 0),
        (90_003, f'{" ".join(words[1::2] + words[::2])} token = "0123456789abcdef0123456789abcdef" end', "en", "p", 0),
        (90_004, None, None, None, None),
        (90_005, "", "en", "p", 0),
    ]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    rows = []
    for name, stage in pipeline.STAGES:
        rows.append(docs.collect())
        stage(spark, docs, SMALL).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
    return [*rows, docs.collect()], docs.columns


def test_quality_rules(stages, db):
    import pandas as pd

    before, after = stages[0][0], stages[0][1]
    frame = pd.DataFrame([r.asDict() for r in before])
    db.register("planted", frame)
    kept = {x for (x,) in db.execute(f"WITH {quality('planted')} SELECT doc_id FROM verdicts WHERE kept").fetchall()}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept) and {90_001, 90_002, 90_003} <= kept


def test_near_duplicates(stages):
    before, after = stages[0][1], stages[0][2]
    found = expected({r.doc_id: r.text for r in before}, pipeline.ALIKE)
    assert Counter(after) == Counter(r for r in before if found[r.doc_id][1] == r.doc_id)
    assert 90_001 not in {r.doc_id for r in after} and {90_002, 90_003} <= {r.doc_id for r in after}


def test_decontamination(spark, stages):
    before, after = stages[0][2], stages[0][3]
    items = [c.normal_text(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after}
    assert Counter(after) == Counter(r for r in before if r.doc_id in left) and 90_002 not in left and 90_003 in left
    for r in before:
        text = c.normal_text(r.text)
        inside = any(i in text for i in items)
        assert not (inside and r.doc_id in left)
        if r.doc_id not in left and not inside:
            assert any(min(distances(i, text)) <= c.errors_allowed(len(i)) for i in items)


def test_secret_scans(stages):
    before, after = stages[0][3], {r.doc_id: r for r in stages[0][4]}
    assert len(before) == len(after)
    for r in before:
        new = after[r.doc_id]
        assert (new.text != r.text) == bool(base(r.text)) and not base(new.text) and new.n_chars == len(new.text)
        assert (new.lang, new.source) == (r.lang, r.source)
    assert re.search(r' \[SECRET\]" end$', after[90_003].text)


def test_packing(stages):
    before, after = stages[0][4], stages[0][5]
    library = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    sums = Counter()
    for r in after:
        sums[r.doc_id] += r.length
    texts = {r.doc_id: np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4") for r in before}
    assert sums == {k: len(v) for k, v in texts.items()}
    assert all(zlib.crc32(texts[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in after)
    assert checked(after, pipeline.LENGTH) <= 1.03 * sum(sums.values()) / pipeline.LENGTH + 1


def test_stages_keep_the_columns_and_run_is_all_of_them(spark, stages):
    rows = pipeline.run(spark, SMALL).collect()
    assert rows and set(rows[0].asDict()) == set(stages[1]) and checked(rows, pipeline.LENGTH)
    assert all(set(r[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for r in stages[0][1:5])
