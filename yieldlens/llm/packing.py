"""Pack documents into sequences of a fixed length by repeated best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldlens.llm.storage import Workspace
from yieldlens.llm.token_counts import by_bytes
from yieldlens.llm.vocabulary import encoder

# Bins that are packed together in one task; about 100 bytes each.
BLOCK = 50_000
# Free tokens up to which a bin counts as nearly full, by round; in later rounds the last one holds.
SLACK = (0, 4, 16, 32)
# A round that brings fewer bins together than this share ends the rounds.
LEAST_GAIN = 0.02

_PLACES = "sequence_id bigint, offset bigint, fill int, open boolean"


def pieces(
    docs: DataFrame, tokenizer: str, length: int, end_id: int | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The token pieces of every document: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document's ids are those of its whole text, then ``end_id``. One longer than ``length`` is cut
    into pieces of that length of which the first takes what is left over. A null text is empty;
    without ``end_id`` an empty document has no piece.
    """
    fields = [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    schema = T.StructType([docs.schema[key], *fields])
    closing = b"" if end_id is None else end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for whole in batches:
            for batch in by_bytes(whole, 4 << 20):
                rows, out = [], []
                for row, value in enumerate(batch.column(1)):
                    ids = encode(value.as_py()) + closing
                    n = len(ids) // 4
                    bounds = [0, *range(n % length or length, n, length), n] if n else []
                    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        rows.append(row)
                        out.append((i, a, b - a, zlib.crc32(memoryview(ids)[4 * a : 4 * b])))
                columns = zip(*out, strict=True) if out else [[], [], [], []]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ],
                    names=schema.names,
                )

    return docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in decreasing order: the bin and offset of every item, and the fill of every bin.

    Bins lie in lists by their free space; the bits of one integer tell which lists have bins, so the
    tightest bin for an item is its lowest set bit.
    """
    bin_of, offset, fill = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    free: list[list[int]] = [[] for _ in range(length + 1)]
    bits = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = bits >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = free[room].pop()
            if not free[room]:
                bits &= ~(1 << room)
        else:
            room, bin_ = length, len(fill)
            fill.append(0)
        bin_of[item], offset[item] = bin_, fill[bin_]
        fill[bin_] += size
        if room > size:
            free[room - size].append(bin_)
            bits |= 1 << (room - size)
    return bin_of, offset, np.array(fill, np.int64)


def _packed(columns: list[str], length: int, round_: int, slack: int, close_all: bool):
    """A function for mapInArrow: pack the bins of a partition, block by block."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept, n = [], 0
        for batch in batches:
            kept.append(batch)
            n += batch.num_rows
            # After the first round the pieces of a bin must stay together: the partition is one block.
            if round_ == 0 and n >= BLOCK:
                yield pa.Table.from_batches(kept)
                kept, n = [], 0
        if n:
            yield pa.Table.from_batches(kept)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Round, partition and number make the names of sequences distinct.
        next_id = (round_ << 56) | (TaskContext.get().partitionId() << 32)
        for table in blocks(batches):
            sizes = table["length"].to_numpy()
            if round_:
                old = table["sequence_id"].to_numpy()
                _, first, item = np.unique(old, return_index=True, return_inverse=True)
                bins, offsets, fill = best_fit(table["fill"].to_numpy()[first], length)
                bin_of, offset = bins[item], offsets[item] + table["offset"].to_numpy()
            else:
                bin_of, offset, fill = best_fit(sizes, length)
            open_ = (fill < length - slack) & (not close_all)
            out = table.select(columns)
            for name, values, kind in (
                ("sequence_id", next_id + bin_of, pa.int64()),
                ("offset", offset, pa.int64()),
                ("fill", fill[bin_of], pa.int32()),
                ("open", open_[bin_of], pa.bool_()),
            ):
                out = out.append_column(name, pa.array(values, kind))
            next_id += len(fill)
            yield from out.to_batches()

    return pack


def pack(items: DataFrame, length: int, rounds: int = 8) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items with a ``length`` of 1 to ``length`` tokens.

    Every partition packs its items by best fit and lets go of nearly full bins. The others, as items
    with their content, are dealt over as many tasks as hold ``BLOCK`` bins each and packed again, with
    a larger slack; the tree ends when one task has had all open bins, or when a round brings hardly
    any together, which then holds for every further one. No task sees more than a block of bins, and
    nothing but counts reaches the driver.

    Equal items are items each. Items without a length or beyond the limit fail. No items give no rows.
    """
    columns = items.columns
    space = Workspace(items.sparkSession, "packing")
    schema = T.StructType(items.schema.fields + T.StructType.fromDDL(_PLACES).fields)
    right = F.col("length").between(1, length)
    checked = items.withColumn(
        "length", F.when(right, F.col("length")).otherwise(F.raise_error(F.lit(f"length not within 1 and {length}")))
    )
    done = []
    left = space.keep(checked.mapInArrow(_packed(columns, length, 0, SLACK[0], False), schema), "round-0")
    before = None
    for round_ in range(1, rounds + 1):
        done.append(left.filter(~F.col("open")))
        open_ = left.filter("open")
        n = open_.filter("offset = 0").count()
        if n == 0:
            break
        tasks = -(-n // BLOCK)
        futile = before is not None and n > (1 - LEAST_GAIN) * before
        if futile or round_ == rounds:
            done.append(open_)
            break
        slack = SLACK[min(round_, len(SLACK) - 1)]
        dealt = open_.repartition(tasks, "sequence_id")
        left = space.keep(dealt.mapInArrow(_packed(columns, length, round_, slack, tasks == 1), schema), f"round-{round_}")
        before = n
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(*columns, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    end_id: int | None = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokenise documents, cut long ones and pack the pieces: see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer, length, end_id, key, text), length)
