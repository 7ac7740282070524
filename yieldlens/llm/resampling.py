"""Sample documents that look like a target: importance weights from two hashed n-gram models, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldlens.llm.shingles import grams, word_hashes
from yieldlens.llm.sketch import chunks, total
from yieldlens.llm.storage import Workspace

# Buckets of each order of n-grams; the models are this large whatever the corpus.
BUCKETS = 1 << 20
# Bins in which the threshold of the sample is looked for, and how often a bin is cut up again.
BINS, MOST_ROUNDS = 4096, 12


@dataclass(frozen=True)
class Sampling:
    """How the models are smoothed and what is sampled.

    ``prior`` has, for n-grams of one word, two words and so on, the occurrences in the raw text that
    the target model is given beforehand in the raw text's proportions: buckets with few occurrences tell little.
    ``share`` of the rows is kept. ``weight`` times the mean log ratio of a document's n-grams is its log weight,
    with ``damp`` n-grams of ratio one added so that short texts do not go to extremes. The target model is
    fitted on ``most_target`` documents at most, drawn evenly from the target; the raw one always on all.
    """

    share: float = 0.8
    prior: tuple[float, ...] = (5.0, 100.0)
    weight: float = 200.0
    damp: int = 20
    seed: int = 1
    most_target: int = 50_000


def _buckets(words: np.ndarray, order: int) -> np.ndarray:
    return (grams(words, order) & np.uint64(BUCKETS - 1)).astype(np.int64) + (order - 1) * BUCKETS


def log_ratios(docs: DataFrame, target: str, sampling: Sampling) -> np.ndarray:
    """Log ratio of the target to the raw model for every bucket, from all documents.

    ``docs`` has ``text`` and the boolean ``target``; rows of the target count in both models.
    """
    orders = len(sampling.prior)
    cells = 2 * orders * BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for flags, words in word_hashes(batches):
            for order in range(1, orders + 1):
                found = [_buckets(w, order) for w in words]
                chosen = [f + orders * BUCKETS for f, flag in zip(found, flags.to_pylist(), strict=True) if flag]
                if found:
                    counts += np.bincount(np.concatenate(found + chosen), minlength=cells).astype(np.uint32)
        rows = list(chunks(counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], names=["chunk", "counts"]
        )

    sums = total(docs.select(target, "text").mapInArrow(count, "chunk int, counts binary"), cells).astype(np.float64)
    raw, wanted = sums[: orders * BUCKETS].reshape(orders, -1), sums[orders * BUCKETS :].reshape(orders, -1)
    prior = np.array(sampling.prior)[:, None]
    scale = raw.sum(1, keepdims=True) / np.maximum(wanted.sum(1, keepdims=True), 1)
    ratios = np.log((wanted * scale + prior) / (raw + prior))
    # Without a target there is nothing to prefer.
    return np.where(wanted.sum(1, keepdims=True) > 0, ratios, 0).astype(np.float32).reshape(-1)


def log_weights(docs: DataFrame, ratios: np.ndarray, sampling: Sampling) -> DataFrame:
    """``id`` and ``log_weight`` of every row of ``docs`` (id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, log_weight double"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for keys, words in word_hashes(batches):
            weights = []
            for w in words:
                found = [_buckets(w, order) for order in range(1, len(sampling.prior) + 1)]
                weights.append(sum(float(table[f].sum(dtype=np.float64)) / (len(f) + sampling.damp) for f in found) * sampling.weight)
            yield pa.RecordBatch.from_arrays([keys, pa.array(weights, pa.float64())], names=["id", "log_weight"])

    return docs.select("id", "text").mapInArrow(weigh, schema)


def gumbel(key: Column, seed: int) -> Column:
    """A standard Gumbel variate that depends on the key and the seed alone."""
    even = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(even))


def threshold(scores: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest score: the histogram's bin that holds it is cut up again until it is one value."""
    low, high, n = scores.agg(F.min(column), F.max(column), F.count(column)).first()
    if n == 0 or k <= 0:
        return None
    above, k = 0, min(k, n)
    for _ in range(MOST_ROUNDS):
        inside = scores.filter(F.col(column).between(low, high))
        if low == high:
            return low
        place = F.least(F.floor((F.col(column) - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r.bin):
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n
    return low


def resampled(
    docs: DataFrame, target: DataFrame, sampling: Sampling = Sampling(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The sample: ``key``, ``log_weight`` and ``score`` of the rows with the largest scores.

    ``target`` has, as ``key``, the documents of the target; they count in both models, as do all others in the
    raw one. A score is the log weight plus a Gumbel variate of the key, so the sample is drawn without
    replacement in proportion to the weights. ceil(share * rows) rows are drawn, and all that tie with the last.

    A null or empty text has log weight 0; rows with one key share its variate and each take part; a null key
    takes part and is never of the target; with an empty target all weights are 0; other columns are not
    read; no documents give no rows.
    """
    space = Workspace(docs.sparkSession, "resampling")
    source = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    wanted = target.select(F.col(key).alias("id")).filter("id IS NOT NULL").distinct()
    # So few that they can be sent to the texts, whatever the corpus.
    wanted = wanted.orderBy(F.xxhash64(F.lit(sampling.seed), "id"), "id").limit(sampling.most_target)
    marked = source.join(F.broadcast(wanted.withColumn("wanted", F.lit(True))), "id", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    weights = log_weights(source, log_ratios(marked, "wanted", sampling), sampling)
    scores = space.keep(weights.withColumn("score", F.col("log_weight") + gumbel(F.col("id"), sampling.seed)), "scores")
    n = scores.count()
    least = threshold(scores, "score", -int(-sampling.share * n // 1))
    kept = scores.filter(F.col("score") >= F.lit(least)) if least is not None else scores.limit(0)
    return kept.select(F.col("id").alias(key), "log_weight", "score")
