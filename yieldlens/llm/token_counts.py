"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldlens.llm.vocabulary import counter

BATCH_BYTES = 1 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 4096
) -> DataFrame:
    """One row per document: ``key``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Arrow batches are cut again into batches of about equal bytes, so neither many short nor a few
    long texts make a batch large, and long texts are encoded in windows that start where no token
    can reach across. Only lengths leave the function.

    A null text counts as empty (0 bytes, 0 tokens); a null key is kept; repeated rows give a row
    each; other columns are not read; no documents give no rows.
    """
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = counter(tokenizer)
        for whole in batches:
            for batch in by_bytes(whole):
                tokens = lengths(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pc.cast(pc.binary_length(batch.column(1)), pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array([n > limit for n in tokens], pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(count, schema)


def by_bytes(batch: pa.RecordBatch, size: int = BATCH_BYTES, column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold about ``size`` bytes; a longer text is a slice of its own."""
    ends = pc.cumulative_sum(pc.cast(pc.binary_length(batch.column(column)), pa.int64())).to_numpy(zero_copy_only=False)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(ends.searchsorted(before + size, "right")))
        yield batch.slice(start, end - start)
        start = end
