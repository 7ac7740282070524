"""Passages of benchmark items in documents, allowing for edits.

An item may differ from a passage by a share of its length. Split into one piece more than errors are
allowed, at least one piece must stand in the passage unchanged; around every such hit, Myers' bit-parallel
algorithm looks for the whole item. Both sides are compared as lower-case letters and digits with single
blanks between, so layout, punctuation and symbols strewn in do not hide a passage.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldlens.llm.storage import Workspace, unused
from yieldlens.llm.token_counts import by_bytes

# Errors allowed per hundred characters, and the shortest item, in normalised characters, that is looked for.
ERRORS_PER_CENT, LEAST_CHARS = 6, 20
# Bytes of a piece that are hashed; the limits above make no piece shorter.
GRAM = 10
# Items that one pass over the documents looks for: so many pieces (about 20 MB with their hashes).
BLOCK_PIECES = 100_000
# Work arrays are some 50 times as large.
SLICE_BYTES = 512 << 10

_P = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.full(256, 32, np.uint8)
for _first, _last in ((48, 57), (97, 122), (128, 255)):
    _KEPT[_first : _last + 1] = np.arange(_first, _last + 1)


def _lower(text: str) -> str:
    small = text.lower()
    # Lower case may take more characters; places must stay what they are.
    return small if len(small) == len(text) else "".join(s if len(s := c.lower()) == 1 else c for c in text)


def _normal(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case UTF-8 with everything but letters and digits as single blanks, and where each byte was."""
    kept = _KEPT[data]
    if len(data) > 2:
        # General punctuation: three bytes from E2 80 or E2 81 on.
        at = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81)))
        for i in range(3):
            kept[at + i] = 32
    blank = kept == 32
    stays = ~blank
    stays[1:] |= ~blank[:-1]
    places = np.flatnonzero(stays)
    return kept[places], places


def normal_text(text: str) -> str:
    return _normal(np.frombuffer(_lower(text).encode(), np.uint8))[0].tobytes().decode().strip()


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place on, by doubling."""
    if len(data) < GRAM:
        return np.empty(0, np.uint64)
    power = lambda n: np.uint64(pow(int(_P), n, 1 << 64))
    one = data.astype(np.uint64)
    one += np.uint64(1)
    two = one[1:] * power(1)
    two += one[:-1]
    four = two[2:] * power(2)
    four += two[:-2]
    eight = four[4:] * power(4)
    eight += four[:-4]
    ten = two[8 : len(data) - 1] * power(8)
    ten += eight[: len(data) - 9]
    ten ^= ten >> np.uint64(29)
    ten *= np.uint64(0xBF58476D1CE4E5B9)
    return ten


def errors_allowed(chars: int) -> int:
    return chars * ERRORS_PER_CENT // 100


class Patterns:
    """Items with their pieces, found by the hash of each piece's first bytes."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items = items
        self.pieces: list[tuple[int, int, bytes]] = []
        for number, (_, text) in enumerate(items):
            parts = errors_allowed(len(text)) + 1
            bounds = [len(text) * i // parts for i in range(parts + 1)]
            self.pieces += [(number, a, text[a:b].encode()) for a, b in zip(bounds, bounds[1:], strict=False)]
        hashes = np.array([_grams(np.frombuffer(p[:GRAM], np.uint8))[0] for _, _, p in self.pieces], np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.shift = np.uint64(64 - max(16, (len(hashes) * 64).bit_length()))
        self.marked = np.zeros(1 << (64 - int(self.shift)), bool)
        self.marked[hashes >> self.shift] = True

    def hits(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Place and piece of every exact hit."""
        grams = _grams(data)
        places = np.flatnonzero(self.marked[grams >> self.shift])
        low = np.searchsorted(self.hashes, grams[places], "left")
        high = np.searchsorted(self.hashes, grams[places], "right")
        for place, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
            for i in self.order[a:b].tolist():
                piece = self.pieces[i][2]
                if data[place : place + len(piece)].tobytes() == piece:
                    yield place, i


def myers(pattern: str, text: str) -> list[int]:
    """For every place of the text, the least edit distance of the pattern to what ends there.

    One integer holds a column of the distance table as differences of plus and minus one.
    """
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    every, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score, scores = every, 0, len(pattern), []
    for c in text:
        equal = masks.get(c, 0)
        up = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        grows, falls = minus | (every & ~(across | plus)), plus & across
        score += bool(grows & top) - bool(falls & top)
        grows, falls = (grows << 1) & every, (falls << 1) & every
        plus = falls | (every & ~(up | grows))
        minus = grows & up
        scores.append(score)
    return scores


def occurrences(pattern: str, text: str, most: int) -> list[tuple[int, int, int]]:
    """Start, end and errors of the best match in every run of ends with at most ``most`` errors."""
    scores, found, i = myers(pattern, text), [], 0
    while i < len(scores):
        if scores[i] > most:
            i += 1
            continue
        j = i
        while j < len(scores) and scores[j] <= most:
            j += 1
        end = min(range(i, j), key=lambda e: scores[e])
        back = myers(pattern[::-1], text[max(0, end + 1 - len(pattern) - most) : end + 1][::-1])
        length = min(range(len(back)), key=lambda e: (back[e], abs(e + 1 - len(pattern)))) + 1
        found.append((end + 1 - length, end + 1, scores[end]))
        i = j
    return found


def _matches(patterns: Patterns, hits: list[tuple[int, int]], data: bytes) -> Iterator[tuple[int, int, int, int]]:
    """Item, start, end (bytes of the normalised text) and errors, from the hits in one document."""
    text = data.decode()
    plain = len(text) == len(data)
    windows = defaultdict(list)
    for place, i in hits:
        item, offset, _ = patterns.pieces[i]
        size = len(patterns.items[item][1])
        start = (place if plain else len(data[:place].decode())) - offset
        most = errors_allowed(size)
        windows[item].append((max(0, start - most), start + size + most))
    for item, spans in windows.items():
        pattern, merged = patterns.items[item][1], []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            for start, end, errors in occurrences(pattern, text[a:b], errors_allowed(len(pattern))):
                bounds = (a + start, a + end)
                yield item, *(bounds if plain else (len(text[:x].encode()) for x in bounds)), errors


# The block that this worker searched last.
_BLOCKS: dict[str, Patterns] = {}


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per passage: ``key``, ``item``, ``start`` and ``end`` (code points of the text), ``errors``.

    Every document is searched whole for every item of LEAST_CHARS normalised characters or more; shorter or null
    ones, too short to mean anything, are not looked for. Items are taken from the benchmark in blocks of bounded
    size, with a pass over the documents for each. Null texts hold no passage; null keys are kept; repeated
    documents or items give rows each; other columns are not read; without documents or items there are no rows.
    """
    spark = docs.sparkSession
    fields = [docs.schema[key], T.StructField("item", benchmark.schema[item].dataType)]
    numbers = [T.StructField(n, T.LongType()) for n in ("start", "end", "errors")]
    schema = T.StructType([*fields, *numbers])
    names = [*schema.names]
    source = docs.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    kind = benchmark.select(item).limit(0).toArrow().schema.field(0).type

    def search(block) -> DataFrame:
        sent, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if name not in _BLOCKS:
                _BLOCKS.clear()
                _BLOCKS[name] = Patterns(sent.value)
            patterns = _BLOCKS[name]
            for whole in batches:
                for batch in by_bytes(whole, SLICE_BYTES):
                    rows, out = [], []
                    for row, *match in _search_slice(patterns, batch.column(1).to_pylist()):
                        rows.append(row)
                        out.append((patterns.items[match[0]][0], *match[1:]))
                    columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
                    arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays], names=names)

        return source.mapInArrow(find, schema)

    result = spark.createDataFrame([], schema)
    for block in _blocks(benchmark.select(item, item_text)):
        result = result.unionByName(search(block))
    return result.withColumnRenamed("item", item)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    block, pieces = [], 0
    for name, text in benchmark.toLocalIterator():
        text = normal_text(text or "")
        if len(text) < LEAST_CHARS:
            continue
        block.append((name, text))
        pieces += errors_allowed(len(text)) + 1
        if pieces >= BLOCK_PIECES:
            yield block
            block, pieces = [], 0
    if block:
        yield block


def _search_slice(patterns: Patterns, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    lowered = [_lower(t).encode() for t in texts]
    data, places = _normal(np.frombuffer(b"\0".join(lowered), np.uint8))
    starts = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    bounds = np.searchsorted(places, starts)
    by_row = defaultdict(list)
    for place, piece in patterns.hits(data):
        row = int(np.searchsorted(bounds, place, "right")) - 1
        # A hit over the blank between two texts is none.
        if place + len(patterns.pieces[piece][2]) <= bounds[row + 1]:
            by_row[row].append((place - int(bounds[row]), piece))
    for row, hits in by_row.items():
        begin, end = int(bounds[row]), int(bounds[row + 1])
        for item, a, b, errors in _matches(patterns, hits, data[begin:end].tobytes()):
            first = int(places[begin + a]) - int(starts[row])
            last = int(places[begin + b - 1]) - int(starts[row])
            yield row, item, len(lowered[row][:first].decode(errors="ignore")), len(lowered[row][: last + 1].decode(errors="ignore")), errors


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns.

    Every row is judged by its own text, also where rows share a key or have none: what is joined back is the key with a
    hash of the text. Null and empty texts hold no passage and stay; repeated rows stay or go together; without
    documents there are none, and without items all stay.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    asked = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(body).alias("hash")).alias("row"), body.alias("body"))
    found = contaminated(asked, benchmark, "row", "body")
    named, hashed = unused("_held", docs.columns), unused("_hash", docs.columns)
    # Stored first: its size decides how it is joined.
    space = Workspace(docs.sparkSession, "contamination")
    held = space.keep(found.select(F.col("row.key").alias(named), F.col("row.hash").alias(hashed)).distinct(), "held")
    return docs.join(held, docs[key].eqNullSafe(F.col(named)) & (F.xxhash64(body) == F.col(hashed)), "left_anti")
