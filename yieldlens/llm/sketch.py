"""Arrays of counters that every task fills and that are added up chunk by chunk."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 15


def chunks(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The chunks that hold a count, packed; their length is a multiple of CHUNK."""
    for chunk in range(len(counts) // CHUNK):
        part = counts[chunk * CHUNK : (chunk + 1) * CHUNK]
        if part.any():
            yield chunk, zlib.compress(part.astype(np.uint32).tobytes(), 1)


def total(packed: DataFrame, cells: int) -> np.ndarray:
    """The sum of all ``chunk``, ``counts`` rows. Tasks add up chunks; the driver gets ``cells`` numbers, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                into = sums.setdefault(chunk, np.zeros(CHUNK, np.uint64))
                into += np.frombuffer(zlib.decompress(part), np.uint32)
        for chunk, into in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([into.tobytes()], pa.binary())], names=["chunk", "counts"]
            )

    counts = np.zeros(cells, np.uint64)
    dealt = packed.select("chunk", "counts").repartition(min(64, cells // CHUNK), "chunk")
    for row in dealt.mapInArrow(add, "chunk int, counts binary").toLocalIterator():
        counts[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.uint64)
    return counts
