"""Pieces against the tokenizer itself; packing is whole, gapless and tight, whatever the blocks."""

from __future__ import annotations

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from yieldlens.llm import packing

FILE = "byte_bpe_50k.json"


def checked(rows, length):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by)


@pytest.mark.parametrize("end_id", [2, None])
def test_pieces_of_documents(documents, end_id):
    library = Tokenizer.from_file(public_tokenizers.path(FILE))
    rows = packing.pack_documents(documents, FILE, 1024, end_id).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for d in documents.collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id])
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)] if ids else []
        if bounds and len(ids) <= 1024:
            bounds = [0, len(ids)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want[d.doc_id].append((i, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert checked(rows, 1024) <= 1.02 * sum(r.length for r in rows) / 1024 + 1


@pytest.mark.parametrize("block", [7, 100, 50_000])
@pytest.mark.parametrize("sizes", ["mixed", "large", "equal", "one"])
def test_rounds(spark, monkeypatch, block, sizes):
    monkeypatch.setattr(packing, "BLOCK", block)
    choose = random.Random(3)
    draw = {"mixed": lambda: choose.randint(1, 100), "large": lambda: choose.randint(51, 100), "equal": lambda: 60, "one": lambda: 1}[sizes]
    items = [(i, draw(), "x", "y") for i in range(700)] + [(0, 5, "x", "y")] * 2
    df = spark.createDataFrame(items, "doc_id long, length long, fill string, open string").repartition(6)
    rows = packing.pack(df.drop("fill", "open"), 100).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted(i[:2] for i in items)
    bins, least = checked(rows, 100), -(-sum(i[1] for i in items) // 100)
    if sizes in ("large", "equal"):
        least = sum(i[1] > 50 for i in items)
    assert bins <= least * {7: 1.2, 100: 1.06, 50_000: 1.06}[block] + 1


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fill = packing.best_fit(np.array([50, 70, 30, 50, 20, 10]), 100)
    assert fill.tolist() == [100, 100, 30] and bins.tolist()[1] == bins.tolist()[2] == 0 and offsets.tolist()[2] == 70


def test_wrong_lengths_fail_and_nothing_packs_to_nothing(spark):
    for wrong in (0, 101, None):
        with pytest.raises(PySparkException, match="length not within"):
            packing.pack(spark.createDataFrame([(1, wrong)], "doc_id long, length long"), 100).collect()
    assert packing.pack(spark.createDataFrame([], "doc_id long, length long"), 100).count() == 0
