"""Documents whose sets of word shingles are alike, found by circulant MinHash.

Shingles are dealt over D places. One permutation scatters the places; a second one, shifted round by 0, 1, 2, ...,
orders them for the first, second, third, ... coordinate of the signature, which is the least rank that a place of the
set has. So two permutations give all coordinates, and the ranks that a shingle has in all of them stand side by side
in one table. Bands of coordinates make buckets. What shares a bucket is compared by whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.llm.links import components, of_keys
from yieldlens.llm.shingles import set_id, shingle_set, shingle_sets, word_hashes
from yieldlens.llm.storage import Workspace

# Sets whose buckets a task has given are left out when they come again; as many are remembered.
REMEMBERED = 50_000
# Rows of a bucket that meet in one place; a larger bucket is dealt over a grid of such cells.
CELL = 2_000
# Shingles of the sets that meet in one place.
CELL_SHINGLES = 4_000_000
# Sketches may agree in so many standard deviations fewer coordinates than a pair that is just alike enough does.
DEVIATIONS = 6
# Shingles whose ranks are looked up at once.
CHUNK = 512


@dataclass(frozen=True)
class Bands:
    """Documents link when per_cent * union <= 100 * intersection of their shingles of ``width`` words.

    A pair that is just alike enough shares no bucket with probability (1 - 0.8 ** rows) ** bands: 4e-8 here.
    """

    width: int = 5
    per_cent: int = 80
    rows: int = 7
    bands: int = 72
    # Two to this power is the number of places that shingles are dealt over.
    places: int = 20
    seed: int = 2_024


@lru_cache(maxsize=2)
def permutations(bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second one, continued from its start for as many places as there are shifts."""
    draw = np.random.Generator(np.random.PCG64(bands.seed))
    first, second = (draw.permutation(1 << bands.places).astype(np.uint32) for _ in range(2))
    return first, np.append(second, second[: bands.rows * bands.bands])


def signature(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The least rank under every shift of the second permutation."""
    first, second = permutations(bands)
    at = first[shingles & np.uint64((1 << bands.places) - 1)]
    shifted = np.lib.stride_tricks.sliding_window_view(second, bands.rows * bands.bands)
    least = np.full(bands.rows * bands.bands, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(at), CHUNK):
        np.minimum(least, shifted[at[start : start + CHUNK]].min(0), out=least)
    return least


def buckets(least: np.ndarray, bands: Bands) -> np.ndarray:
    """One hash per band, of the band and its coordinates. A band takes coordinates that lie far apart."""
    mixed = np.arange(bands.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for row in least.reshape(bands.rows, bands.bands).astype(np.uint64):
        mixed = (mixed ^ row) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def summaries(docs: DataFrame, bands: Bands) -> DataFrame:
    """``id``, ``n``, ``set_id`` and ``buckets`` of every row of ``docs`` (id, text).

    Of equal sets within a task only the first has buckets, and none without shingles or id.
    """
    schema = "id bigint, n bigint, set_id binary, buckets array<bigint>"

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for keys, texts in word_hashes(batches):
            sizes, names, found = [], [], []
            for key, words in zip(keys.to_pylist(), texts, strict=True):
                shingles = shingle_set(words, bands.width)
                name = set_id(shingles) if len(shingles) else None
                sizes.append(len(shingles))
                names.append(name)
                new = name is not None and key is not None and name not in seen
                found.append(buckets(signature(shingles, bands), bands) if new else None)
                if new:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "n", "set_id", "buckets"],
            )

    return docs.mapInArrow(summarise, schema)


def _met(rows: DataFrame, kind: str) -> DataFrame:
    """The rows of buckets that hold more than one ``kind``, with ``members``, how many rows the bucket has.

    Rows move once, to their bucket, whatever their number.
    """
    bucket = W.partitionBy("bucket")
    told = {"lowest": F.min(kind).over(bucket), "highest": F.max(kind).over(bucket), "members": F.count("*").over(bucket)}
    return rows.withColumns(told).filter("lowest < highest").drop("lowest", "highest")


def sketches(docs: DataFrame, bands: Bands) -> DataFrame:
    """``id`` and ``sketch`` of ``docs`` (id, text): the low byte of every coordinate of the signature."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sets in shingle_sets(batches, bands.width):
            # The low byte of a rank tells as little as possible of the least ranks' size.
            found = [signature(s, bands).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.binary())], names=["id", "sketch"])

    return docs.mapInArrow(sketch, "id bigint, sketch binary")


def least_agreeing(bands: Bands) -> int:
    """Coordinates in which two sets that are just alike enough agree, less some standard deviations."""
    n, share = bands.rows * bands.bands, bands.per_cent / 100
    return int(n * share - DEVIATIONS * (n * share * (1 - share)) ** 0.5)


def _cells(rows: DataFrame, name: str, parts: Column) -> DataFrame:
    """Rows of every ``name`` as a grid of ``parts`` by ``parts``: each comes to the cells of its ``own`` part with every other.

    Cells of two parts, marked ``across``, hold the rows of both. What comes together is sorted by ``cell`` and ``name``.
    """
    own = rows.withColumn("parts", parts.cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64(name, F.least("own", "other"), F.greatest("own", "other"))
    dealt = other.select(cell.alias("cell"), (F.col("own") != F.col("other")).alias("across"), "own", *rows.columns)
    return dealt.repartition("cell").sortWithinPartitions("cell", name)


def _each_cell(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """The rows of every cell of ``_cells``, one after another."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        names = np.column_stack([batch["cell"].to_numpy(), batch[name].to_numpy()])
        edges = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), len(names)]
        for x, y in zip(edges, edges[1:], strict=False):
            part = batch.slice(x, y - x)
            if not part.num_rows:
                continue
            if kept and not (kept[0]["cell"][0] == part["cell"][0] and kept[0][name][0] == part[name][0]):
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(part)
    if kept:
        yield pa.Table.from_batches(kept)


def _sketch_matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(table.num_rows, -1)


def _pairs(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids, the smaller first."""
    if found:
        both = np.sort(np.array(found, np.int64), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _agreeing(rows: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b) that join what may be linked: rows of one bucket, of different component and fitting size, whose
    sketches agree as alike sets' do.

    ``rows`` have bucket, members, id, low, high, component and sketch. A cell gives no pair of rows that its pairs before
    have joined already, so it has fewer pairs than rows, however many agree.
    """
    dealt = _cells(rows, "bucket", F.ceil(F.col("members") / F.lit(CELL)))
    least, per_cent = least_agreeing(bands), bands.per_cent

    def joined(table: pa.Table) -> Iterator[tuple[int, int]]:
        ids, low, high, component, own = (table[c].to_numpy() for c in ("id", "low", "high", "component", "own"))
        matrix, across, group = _sketch_matrix(table), table["across"][0].as_py(), np.arange(table.num_rows)
        for i in range(len(ids) - 1):
            behind = slice(i + 1, None)
            fits = (component[behind] != component[i]) & (100 * high[behind] >= per_cent * low[i]) & (100 * high[i] >= per_cent * low[behind])
            fits &= group[behind] != group[i]
            if across:
                fits &= own[behind] != own[i]
            at = np.flatnonzero(fits) + i + 1
            if len(at):
                at = at[(matrix[at] == matrix[i]).sum(1) >= least]
                joins, first = np.unique(group[at], return_index=True)
                yield from ((ids[i], ids[j]) for j in at[first])
                group[np.isin(group, joins)] = group[i]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _each_cell(batches, "bucket"):
            yield from _pairs(list(joined(table)))

    return dealt.mapInArrow(found, "a bigint, b bigint").distinct()


def _linked(rows: DataFrame, docs: DataFrame, bands: Bands, space: Workspace) -> DataFrame:
    """Links (a, b) of whole sets between different components, as many as join all that are linked.

    ``rows`` are those of ``_agreeing``. What their pairs join is one cluster; all its documents meet, each with its set
    once, or on a grid of cells where a cluster is large. There all those whose sketches agree are compared in
    place by whole sets, unless links before have joined them already.
    """
    clusters = components(_agreeing(rows, bands), space, "clusters")
    about = rows.groupBy("id").agg(F.first("component").alias("component"), F.max("high").alias("high"))
    about = space.keep(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")).join(about, "id"), "clustered")
    # Cells by rows and by shingles.
    large = F.greatest(F.ceil(F.count("*") / F.lit(CELL)), F.ceil(F.sum("high") / F.lit(CELL_SHINGLES)))
    sizes = about.groupBy("cluster").agg(large.alias("cells"))
    sets = space.keep(_sets(of_keys(docs, "id", about), bands, sketched=True), "clustered-sets")
    whole = sets.join(about.drop("high").join(sizes, "cluster"), "id")
    dealt = _cells(whole, "cluster", F.col("cells"))
    least, per_cent = least_agreeing(bands), bands.per_cent

    def joined(table: pa.Table) -> Iterator[tuple[int, int]]:
        ids, own = table["id"].to_numpy(), table["own"].to_numpy()
        _, group = np.unique(table["component"].to_numpy(), return_inverse=True)
        matrix, across = _sketch_matrix(table), table["across"][0].as_py()
        tokens = table["tokens"].combine_chunks()
        values, ends = tokens.flatten().to_numpy(), np.append(0, np.cumsum(tokens.value_lengths().to_numpy()))
        sets = [values[x:y] for x, y in zip(ends, ends[1:], strict=False)]
        n = np.diff(ends)
        for i in range(len(ids) - 1):
            behind = slice(i + 1, None)
            fits = (group[behind] != group[i]) & (100 * n[behind] >= per_cent * n[i]) & (100 * n[i] >= per_cent * n[behind])
            if across:
                fits &= own[behind] != own[i]
            at = np.flatnonzero(fits) + i + 1
            if not len(at):
                continue
            for j in at[(matrix[at] == matrix[i]).sum(1) >= least].tolist():
                if group[j] == group[i]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= per_cent * (n[i] + n[j] - common):
                    yield ids[i], ids[j]
                    group[group == group[j]] = group[i]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _each_cell(batches, "cluster"):
            yield from _pairs(list(joined(table)))

    return space.keep(dealt.mapInArrow(found, "a bigint, b bigint").distinct(), "far-links")


def _sets(docs: DataFrame, bands: Bands, sketched: bool = False) -> DataFrame:
    """``id`` and ``tokens``, the whole set, of ``docs`` (id, text) with words; ``sketched`` adds ``sketch``."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sets in shingle_sets(batches, bands.width):
            for at in range(0, len(sets), 500):
                part = sets[at : at + 500]
                ends = pa.array(np.cumsum([0, *map(len, part)]), pa.int32())
                arrays = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(part).view(np.int64)))
                columns = {"id": keys.slice(at, 500), "tokens": arrays}
                if sketched:
                    columns["sketch"] = pa.array([signature(s, bands).astype(np.uint8).tobytes() for s in part], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return docs.mapInArrow(whole, "id bigint, tokens array<bigint>" + ", sketch binary" * sketched).filter(F.size("tokens") > 0)


def _verified(pairs: DataFrame, docs: DataFrame, bands: Bands, space: Workspace, name: str) -> DataFrame:
    """Of the pairs (a, b) those whose whole sets are alike. Texts are read again; only sets that are needed move."""
    pairs = space.keep(pairs, f"{name}-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # Rows that share an id count as one document: their tokens are put together.
    sets = space.keep(_sets(of_keys(docs, "id", wanted), bands), f"{name}-sets")
    side = lambda s: sets.select(F.col("id").alias(s), F.col("tokens").alias(f"tokens_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.size(F.array_intersect("tokens_a", "tokens_b")))
    union = F.size("tokens_a") + F.size("tokens_b") - F.col("common")
    links = space.keep(both.filter(100 * F.col("common") >= bands.per_cent * union).select("a", "b").distinct(), f"{name}-links")
    space.drop(f"{name}-pairs", f"{name}-sets")
    return links


def near_duplicates(docs: DataFrame, bands: Bands = Bands(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``class_id``, ``component_id`` and ``kept``.

    A class holds the documents of equal sets, and a component those that links lead to; each is named by its smallest
    key, and that document is the one ``kept``. A null or empty text, or one without words, has 0 shingles, no class
    (null) and is its own component. Keys must be integers. Rows with one key count as one document when links are
    followed, and each gets a row. A null key links with nothing, its component is null and it is kept. Other columns
    are not read; no documents give no rows.

    Only one document of a class has buckets. Each is first compared with one other only, of those that lead its buckets
    the one that meets most others; groups of near copies are joined by that without being paired among themselves.
    What is left are members of a bucket whose components still differ. Of those, what pairs with fitting sizes and sketches
    join is one cluster, within which such pairs are compared in place: a link that shares a bucket is lost with the
    probability of DEVIATIONS standard deviations, one in a thousand million.
    """
    space = Workspace(docs.sparkSession, "minhash")
    source = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    seen = space.keep(summaries(source, bands), "summaries")
    named = seen.filter("set_id IS NOT NULL AND id IS NOT NULL").groupBy("set_id")
    classes = space.keep(named.agg(F.min("id").alias("class_id"), F.count("*").alias("copies")).filter("copies > 1"), "classes")
    alone = F.when(F.col("set_id").isNotNull(), F.col("id"))
    # A row without key is in a class, too, but never the one that names it.
    joined = seen.join(classes.select("set_id", "class_id").hint("merge"), "set_id", "left").withColumn("class_id", F.coalesce("class_id", alone))
    members = space.keep(joined.select("id", "n", "class_id"), "members")
    # Different sets under one key are one document.
    own = members.filter("class_id IS NOT NULL").select("id", "class_id")
    several = own.groupBy("id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).filter("a < b").select("id", "a")
    several = own.join(several, "id").filter("class_id > a").select("a", F.col("class_id").alias("b")).distinct()
    given = joined.filter("buckets IS NOT NULL").select("class_id", "n", F.explode("buckets").alias("bucket"))
    # Several tasks may have given a class's buckets; a key with several sets is one document with the buckets of all.
    rows = _met(given.withColumnRenamed("class_id", "id"), "id").groupBy("bucket", "id").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.first("members").alias("members"))
    rows = space.keep(rows, "rows")
    space.drop("summaries")
    # What meets many others in many buckets is what near copies were made from.
    weights = rows.groupBy("id").agg(F.sum("members").alias("weight"))
    rows = space.keep(rows.drop("members").join(weights, "id"), "weighted")
    space.drop("rows")

    def fit(x: str, y: str) -> Column:
        return (100 * F.col(f"{x}high") >= bands.per_cent * F.col(f"{y}low")) & (100 * F.col(f"{y}high") >= bands.per_cent * F.col(f"{x}low"))

    led = rows.groupBy("bucket").agg(F.max(F.struct("weight", -F.col("id"), "id", "low", "high")).alias("c"))
    leaders = led.select("bucket", *[F.col(f"c.{c}").alias(f"c_{c}") for c in ("weight", "id", "low", "high")])
    near = rows.join(leaders, "bucket").filter((F.col("id") != F.col("c_id")) & fit("", "c_"))
    chosen = near.groupBy("id").agg(F.max(F.struct("c_weight", -F.col("c_id"), "c_id")).alias("c"))
    pairs = chosen.select(F.least("id", "c.c_id").alias("a"), F.greatest("id", "c.c_id").alias("b")).distinct()
    links = space.keep(several, "several").unionByName(_verified(pairs, source, bands, space, "near"))
    component = components(links, space, "near-components").withColumnRenamed("component", "joined").withColumnRenamed("node", "id")
    apart = rows.join(component, "id", "left").withColumn("component", F.coalesce("joined", "id")).drop("joined", "weight")
    apart = space.keep(_met(apart, "component"), "apart")
    drawn = of_keys(source, "id", apart.select("id").distinct())
    far = space.keep(apart.join(sketches(drawn, bands), "id"), "far")
    links = links.unionByName(_linked(far, source, bands, space))
    linked = components(links, space, "components").withColumnRenamed("node", "class_id")
    space.drop("apart", "weighted")

    result = members.join(linked, "class_id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class_id", "id"))
    kind = docs.schema[key].dataType
    return result.select(
        F.col("id").cast(kind).alias(key),
        F.col("n").alias("n_shingles"),
        F.col("class_id").cast(kind).alias("class_id"),
        component.cast(kind).alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
