"""Counts of tokens through Spark against the libraries."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from yieldlens.llm import token_counts as tc


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts(documents, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    docs = documents.withColumn("n_tokens", F.lit("clash"))
    if name.startswith("word"):
        docs = docs.filter("doc_id IS NULL OR doc_id > 8000 OR doc_id < 20")
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(docs, name).collect())
    want = Counter((r.doc_id, len((r.text or "").encode()), n := count(r.text or ""), n > 4096) for r in docs.collect())
    assert got == want


def test_an_absolute_path_and_nothing(documents):
    name = public_tokenizers.path("piece_bpe_32k.model")
    assert tc.token_counts(documents.limit(0), name).count() == 0
    assert tc.token_counts(documents.limit(3), name).schema.names == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_slices_by_bytes():
    texts = ["a" * n for n in (5, 5, 50, 1, 1, 1, 0, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["k", "t"])
    parts = [p.column(1).to_pylist() for p in tc.by_bytes(batch, 12)]
    assert sum(parts, []) == texts and all(len(p) == 1 or sum(map(len, p)) <= 12 for p in parts)
    assert list(tc.by_bytes(batch.slice(0, 0), 12)) == []
