"""Hard negatives by inner product: an R-tree packed by sort-tile-recursive, searched best first.

Vectors are sorted by their widest coordinate and cut into slabs, these by the next and cut into tiles; both are
Spark's sorts. Within a tile the same goes on down to leaves, and boxes of leaves, boxes of those, and so on make the
tree. A box holds the least and the largest value of every coordinate, so the product with a vector lies, coordinate by
coordinate, in an interval. A queue opens the box with the highest bound first; a box is left out if its interval lies
outside the scores that are asked for, or strictly below the k-th best score found: ties go to the smaller id, so equal
scores still count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.llm.storage import Workspace

# Vectors of a tile, of a leaf, and boxes of a box. Anchors that are sent together.
TILE, LEAF, FANOUT, ASKED = 8_192, 64, 8, 256
# Tiles that one task packs, at most about.
SLAB_TILES = 64
# Coordinates that tiles are cut by within a task, and leaves that are opened together.
SORTED_BY, AT_ONCE = 4, 8


@dataclass(frozen=True)
class Mining:
    """A negative's score is from ``low`` to ``high`` per cent of the positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def _exact_type(*sides: np.ndarray) -> type:
    """The fastest type in which all sums of products of the sides' rows are exact integers."""
    # No sum of products is larger than the product of the lengths.
    most = float(np.prod([max(1.0, np.sqrt((side.astype(np.float64) ** 2).sum(1).max(initial=0))) for side in sides]))
    if most >= 2**62:
        raise ValueError("scores do not fit 64 bits")
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


def str_order(vectors: np.ndarray, by: np.ndarray, leaf: int) -> np.ndarray:
    """Rows in the order of sort-tile-recursive over the coordinates ``by``: neighbours make leaves."""

    def sort(rows: np.ndarray, k: int) -> list[np.ndarray]:
        rows = rows[np.argsort(vectors[rows, by[k]], kind="stable")]
        leaves = -(-len(rows) // leaf)
        if k + 1 == len(by) or leaves <= 1:
            return [rows]
        slabs = int(np.ceil(leaves ** (1 / (len(by) - k))))
        size = -(-leaves // slabs) * leaf
        return [part for at in range(0, len(rows), size) for part in sort(rows[at : at + size], k + 1)]

    return np.concatenate(sort(np.arange(len(vectors)), 0)) if len(vectors) and len(by) else np.arange(len(vectors))


class Tree:
    """Boxes over a tile's vectors. Leaves come first, then the boxes over them, the root last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        spread = vectors.astype(np.float64).var(0) if len(vectors) else np.zeros(0)
        by = np.argsort(-spread, kind="stable")[:SORTED_BY]
        # Rows of a label stand together, so that whole boxes can be told by label.
        order = [rows[str_order(vectors[rows], by, LEAF)] for rows in (np.flatnonzero(labels == label) for label in np.unique(labels))]
        order = np.concatenate(order)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        starts = np.arange(0, len(order), LEAF)
        edges = [np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts)]
        kinds = [np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)]
        levels, first = [(*edges, *kinds)], [starts]
        while len(first[-1]) > 1:
            starts = np.arange(0, len(first[-1]), FANOUT)
            low, high, least, most = levels[-1]
            levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))
            first.append(starts)
        self.leaves = len(levels[0][0])
        self.low, self.high, self.least, self.most = (np.concatenate(x) for x in zip(*levels, strict=True))
        self.children: list[range] = [range(0)] * self.leaves
        below = 0
        for under, over in zip(levels, levels[1:], strict=False):
            n = len(under[0])
            self.children += [range(below + i * FANOUT, below + min(n, (i + 1) * FANOUT)) for i in range(len(over[0]))]
            below += n

        self.root_corner = np.maximum(np.abs(self.low[-1:]), np.abs(self.high[-1:]))
        self.least, self.most = self.least.tolist(), self.most.tolist()
        self.cast: dict[type, tuple[np.ndarray, ...]] = {}

    def bounds(self, asked: np.ndarray) -> Iterator[tuple[list, list, np.ndarray]]:
        """For every asked vector: lower and upper bound of its product with each box, and the vector in the tree's type.

        Per coordinate the product lies between those with the box's two ends, so the signs of the vector choose them.
        """
        kind = _exact_type(asked, self.root_corner)
        if kind not in self.cast:
            self.cast[kind] = tuple(x.astype(kind) for x in (self.vectors, self.low, self.high))
        _, low, high = self.cast[kind]
        asked = asked.astype(kind)
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        lower, upper = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        for i in range(len(asked)):
            yield lower[i].tolist(), upper[i].tolist(), asked[i]

    def search(self, vector: np.ndarray, lower: list, upper: list, same: int | None, other: int | None, windows: list["Best"]) -> None:
        """Offer every window the rows that can be among its best: of the label ``same``, or of any but ``other``."""

        def wanted(box: int) -> bool:
            if same is not None and not self.least[box] <= same <= self.most[box]:
                return False
            if other is not None and self.least[box] == self.most[box] == other:
                return False
            return any(w.low <= upper[box] and lower[box] <= w.high and w.kth <= upper[box] for w in windows)

        root = len(self.children) - 1
        queue = [(-upper[root], root)] if root >= 0 and wanted(root) else []
        while queue:
            leaves = []
            while queue and len(leaves) < AT_ONCE:
                _, box = heapq.heappop(queue)
                # The k-th best may have risen since the box was put in.
                if not wanted(box):
                    continue
                if box < self.leaves:
                    leaves.append(box)
                else:
                    for child in self.children[box]:
                        if wanted(child):
                            heapq.heappush(queue, (-upper[child], child))
            if not leaves:
                return
            rows = np.concatenate([np.arange(leaf * LEAF, min(len(self.ids), (leaf + 1) * LEAF)) for leaf in leaves])
            rows = rows[self.labels[rows] == same] if same is not None else rows[self.labels[rows] != other]
            scores = (self.cast[vector.dtype.type][0][rows] @ vector).astype(np.int64)
            for window in windows:
                window.offer(self.ids[rows], scores)


class Best:
    """The k rows with the highest scores from ``low`` to ``high``, the smaller id first where they tie."""

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf, without: int | None = None):
        self.k, self.low, self.high, self.without = k, low, high, without
        self.kth = -np.inf
        self.rows: list[tuple[int, int]] = []

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= max(self.low, self.kth)) & (scores <= self.high)
        if self.without is not None:
            fits &= ids != self.without
        if not fits.any():
            return
        found = sorted(zip((-scores[fits]).tolist(), ids[fits].tolist(), strict=True))[: self.k]
        self.rows = sorted(self.rows + found)[: self.k]
        if len(self.rows) == self.k:
            self.kth = -self.rows[-1][0]


def _widest(vectors: DataFrame) -> list[int]:
    """The coordinates with the largest variance, widest first."""
    spread = vectors.select(F.posexplode("vector")).groupBy("pos").agg(F.var_pop("col").alias("v"))
    return [r.pos for r in spread.orderBy(F.desc("v"), "pos").limit(2).collect()] or [0]


# A packed table of vectors: a tile, or a block of anchors with their positives.
_PACKED = "rows int, width int, ids binary, labels binary, vectors binary"
_NUMBERS = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _bytes(batch: pa.RecordBatch | pa.Table, width: int) -> list[list]:
    """The columns of _PACKED for rows (id, label, vector)."""
    columns = [batch[c].combine_chunks() if isinstance(batch, pa.Table) else batch[c] for c in ("id", "label", "vector")]
    flat = columns[2].flatten().to_numpy(zero_copy_only=False)
    return [[batch.num_rows], [width], *([c.astype(np.int64).tobytes()] for c in (columns[0].to_numpy(), columns[1].to_numpy(), flat))]


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, flat = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "vectors"))
    return ids, labels, flat.reshape(row["rows"], row["width"])


def _cells(rows: int) -> int:
    """The number of full tiles: so many cells share the tiles."""
    return max(1, -(-rows // TILE))


def tiles(vectors: DataFrame, rows: int, width: int) -> DataFrame:
    """Tiles of ``vectors`` (id, label, vector), ``rows`` in number, in the order of sort-tile-recursive: a packed row each, with its ``cell``.

    Equal vectors are told apart by a hash of the id, so any number of them is cut like other rows.
    """
    cells = _cells(rows)
    slabs = max(int(np.ceil(cells**0.5)), -(-cells // SLAB_TILES))
    of_slab = -(-cells // slabs)
    widest = _widest(vectors)
    place, tie = (lambda i: F.get("vector", F.lit(widest[min(i, len(widest) - 1)]))), F.xxhash64("id")
    ordered = vectors.repartitionByRange(slabs, place(0), tie).sortWithinPartitions(place(1), tie)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, kept, n = TaskContext.get().partitionId() * of_slab, [], 0

        def packed(table: pa.Table) -> pa.RecordBatch:
            columns = [[tile % cells], *_bytes(table, width)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32(), *_NUMBERS], strict=True)], names=["cell", *names])

        for batch in batches:
            kept.append(batch)
            n += batch.num_rows
            while n >= TILE:
                table = pa.Table.from_batches(kept)
                yield packed(table.slice(0, TILE))
                kept, n, tile = table.slice(TILE).to_batches(), n - TILE, tile + 1
        if n:
            yield packed(pa.Table.from_batches(kept))

    names = ["rows", "width", "ids", "labels", "vectors"]
    return ordered.select("id", "label", "vector").mapInArrow(pack, f"cell int, {_PACKED}")


def _blocks(anchors: DataFrame, width: int) -> DataFrame:
    """Anchors (ask, id, label, vector, wanted) in packed rows of at most ASKED; ``wanted`` has the scores of their positives."""
    kind = pa.list_(pa.list_(pa.int64()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ASKED):
                part = batch.slice(at, ASKED)
                columns = [*_bytes(part, width), [part["ask"].to_pylist()], [part["wanted"].to_pylist()]]
                kinds = [*_NUMBERS, pa.list_(pa.int64()), kind]
                names = ["rows", "width", "ids", "labels", "vectors", "asks", "wanted"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return anchors.mapInArrow(pack, f"{_PACKED}, asks array<bigint>, wanted array<array<bigint>>")


def _found(index: DataFrame, blocks: DataFrame, cells: int, mining: Mining, negatives: bool) -> DataFrame:
    """``ask``, ``nth`` (of the positives), ``id`` and ``score``: the best that each tile has for each anchor.

    Every cell gets its tiles, then every block of anchors, which stream past the trees: a stated set of queries
    against all rows, in blocks.
    """
    sent = blocks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    both = index.withColumn("kind", F.lit(0)).unionByName(sent.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    dealt = both.repartition(cells, "cell").sortWithinPartitions("cell", "kind")

    def windows(anchor: int, scores: list[int]) -> list[Best]:
        if not negatives:
            return [Best(mining.positives, without=anchor)]
        # Least and largest whole scores within the per cents.
        return [Best(mining.negatives, -(-mining.low * s // 100), mining.high * s // 100, anchor) for s in scores]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, trees = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["cell"] != cell:
                    cell, trees = row["cell"], []
                if row["kind"] == 0:
                    trees.append(Tree(*_read(row)))
                    continue
                ids, labels, vectors = _read(row)
                out: list[tuple[int, int, int, int]] = []
                for tree in trees:
                    for i, (lower, upper, vector) in enumerate(tree.bounds(vectors)):
                        best = windows(int(ids[i]), row["wanted"][i])
                        label = int(labels[i])
                        tree.search(vector, lower, upper, None if negatives else label, label if negatives else None, best)
                        out += [(row["asks"][i], nth, id_, -score) for nth, b in enumerate(best) for score, id_ in b.rows]
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ask", "nth", "id", "score"])

    return dealt.mapInArrow(search, "ask bigint, nth bigint, id bigint, score bigint")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of every group, with their ``rank``: every task keeps its own k best before rows are brought together."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, mining: Mining = Mining(), key: str = "vec_id", label: str = "label", vector: str = "vector"
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has whole numbers (array of bigint); scores are their products, exact. Anchors are the rows for which the
    condition ``anchors`` holds. Positives are an anchor's best other rows of its label. For each, the best rows of
    other labels are given whose score is from ``low`` to ``high`` per cent of the positive's: none if that is negative.

    A row without key, label or vector, or with a null in it, takes no part. Shorter vectors count as ending in zeros.
    Rows that share a key are rows of their own, but never each other's positive or negative; a repeated anchor gives its
    rows again. Equal scores go by key. Other columns are not read; without anchors, positives or negatives there are
    no rows.
    """
    space = Workspace(vectors.sparkSession, "rtree")
    columns = [F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector")]
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~F.exists("vector", lambda x: x.isNull()), F.lit(False))
    usable = vectors.select(*columns, F.coalesce(anchors, F.lit(False)).alias("asked")).filter(whole)
    n, width = usable.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(1, width or 0)
    usable = usable.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))))
    index, cells = space.keep(tiles(usable, n, width), "tiles"), _cells(n)
    asked = usable.filter("asked").select(F.monotonically_increasing_id().alias("ask"), "id", "label", "vector")
    asked = space.keep(asked, "asked")

    none = F.array().cast("array<bigint>")
    near = _found(index, _blocks(asked.withColumn("wanted", none), width), cells, mining, False)
    near = _best(near, ["ask"], mining.positives)
    # As many as are asked for at most.
    listed = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
    positives = space.keep(near.groupBy("ask").agg(listed.alias("positives")), "positives")
    known = asked.join(positives, "ask").withColumn("wanted", F.col("positives.score"))
    far = _found(index, _blocks(known.select("ask", "id", "label", "vector", "wanted"), width), cells, mining, True)
    far = _best(far, ["ask", "nth"], mining.negatives).join(known.select("ask", F.col("id").alias("anchor_id"), "positives"), "ask")
    positive = F.get("positives", F.col("nth").cast("int"))
    return far.select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
