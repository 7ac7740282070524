"""Word shingles of whole texts as sets of 64-bit hashes, computed on byte arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from yieldlens.llm.token_counts import by_bytes

BATCH_BYTES = 1 << 20
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = np.random.Generator(np.random.PCG64(20_240_117)).integers(0, 2**64, 256, np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word: a public 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; words end at white space and at ``breaks`` (places of text starts)."""
    inside = ~_SPACES[data]
    starting = inside.copy()
    starting[1:] &= ~inside[:-1]
    at_break = breaks[(breaks < len(data))]
    starting[at_break] = inside[at_break]
    starts = np.flatnonzero(starting)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    # Bytes outside words count nothing, so a word may be summed up to the start of the next.
    place = np.zeros(len(data), np.int64)
    place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    powers = np.cumprod(np.full(int(place.max()) + 1, _FACTOR, np.uint64))
    values = _CODES[_LOWER[data]] * powers[place] * inside
    return _mixed(np.add.reduceat(values, starts)), starts


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` words, in order."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    whole = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        whole = _mixed(whole + words[i : len(words) - width + 1 + i])
    return whole


def shingle_set(words: np.ndarray, width: int, places: bool = False):
    """Sorted distinct shingles of a text's word hashes; of fewer words than the width, the sequence as one.

    With ``places`` also where each shingle comes first.
    """
    found = grams(words, min(width, len(words))) if len(words) else words
    return np.unique(found, return_index=True) if places else np.unique(found)


def shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Keys (first column) and shingle sets of the texts (second column), slice by slice."""
    for keys, texts in word_hashes(batches):
        yield keys, [shingle_set(words, width) for words in texts]


def word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """First column, and the hashes of each text's words in order (second column), slice by slice.

    Words are what stands between ASCII white space, with A to Z as lower case.
    """
    for whole in batches:
        for batch in by_bytes(whole, BATCH_BYTES):
            texts = batch.column(1).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            ends = ends - ends[0]
            hashes, starts = [], []
            # A text longer than a slice is hashed in parts that begin with white space.
            at = 0
            while at < len(data):
                to = min(len(data), at + BATCH_BYTES)
                if to < len(data):
                    gap = np.flatnonzero(_SPACES[data[to : to + BATCH_BYTES]])
                    to = to + int(gap[0]) if len(gap) else len(data)
                some, first = _word_hashes(data[at:to], ends[(ends >= at) & (ends < to)] - at)
                hashes.append(some)
                starts.append(first + at)
                at = to
            words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            bounds = np.searchsorted(np.concatenate(starts), ends) if starts else np.zeros(len(ends), np.int64)
            yield batch.column(0), [words[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
