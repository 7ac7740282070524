"""Documents whose sets of word shingles are alike, found by prefixes of adapted length.

A document's shingles are put in one global order, rare ones first. Of two sets that are alike enough,
prefixes of length n - t + 1 share a token, and prefixes longer by l - 1 share l tokens, t being the least
overlap that a set of n tokens needs. Each document takes the l that its own estimated costs make best: a
longer prefix means more tokens to match, but far fewer candidates to verify. Prefixes made for l and m
share at least the smaller of both, so that is what a candidate pair must share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.llm.links import components
from yieldlens.llm.shingles import set_id, shingle_set, shingle_sets, word_hashes
from yieldlens.llm.sketch import chunks, total
from yieldlens.llm.storage import Workspace, unused

# Counters of the frequency sketch, for shingles and again for words: 32 MB whatever the corpus, which is what is broadcast.
CELLS = 1 << 21
# Longest extension of a prefix, and the costs it is weighed by: of a candidate by tokens of both sets, and
# the partners that any token has besides those that the sketch shows.
MOST_SHARED = 8
VERIFY_COST, STRAY = 0.1, 0.05
# Sets whose postings a task has seen are left out when they come again; as many are remembered.
REMEMBERED = 50_000


@dataclass(frozen=True)
class Alike:
    """Documents link when per_cent * union <= 100 * intersection of their shingles of ``width`` words."""

    width: int = 5
    per_cent: int = 80

    def least_overlap(self, n: np.ndarray | int) -> np.ndarray | int:
        """Tokens that a set of n must share with any set that it links with."""
        return -(-self.per_cent * n // 100)

    def needed(self, n: Column, m: Column) -> Column:
        """Tokens that sets of n and m must share to link."""
        return F.ceil(F.lit(self.per_cent) * (n + m) / F.lit(100 + self.per_cent))


def _ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))


def summaries(docs: DataFrame, alike: Alike) -> DataFrame:
    """Rows (id, n, set_id) of all documents, and rows (chunk, counts) of every task's frequency sketch."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * CELLS, np.uint32)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        names = ["id", "n", "set_id", "chunk", "counts"]
        for keys, words in word_hashes(batches):
            sets = [shingle_set(w, alike.width) for w in words]
            for at, hashes in ((0, sets), (CELLS, words)):
                if hashes:
                    found = np.bincount(np.concatenate(hashes) & np.uint64(CELLS - 1), minlength=CELLS)
                    counts[at : at + CELLS] += found.astype(np.uint32)
            columns = [keys, [len(s) for s in sets], [set_id(s) if len(s) else None for s in sets], [None] * len(sets), [None] * len(sets)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, list) else c for c, k in zip(columns, kinds, strict=True)], names=names)
        for chunk, part in chunks(counts):
            row = [[None], [None], [None], [chunk], [part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=names)

    return docs.mapInArrow(summarise, "id bigint, n bigint, set_id binary, chunk int, counts binary")


def shared_tokens(partners: np.ndarray, n: int, prefix: int, least: int) -> int:
    """The number l of tokens to share that costs least, given the partners each token of the order has.

    Costs are those of matching the prefix and of verifying the candidates; of all partners of n tokens
    together, at most one in l can share l of them, and chance partners far fewer.
    """
    most = min(MOST_SHARED, least)
    if most <= 1:
        return 1
    matches = np.cumsum(partners[: prefix + most - 1])[prefix - 1 :]
    shared = np.arange(1, len(matches) + 1)
    return int(np.argmin(matches * (1 + VERIFY_COST * n / shared**2))) + 1


def postings(docs: DataFrame, alike: Alike, sent: Broadcast) -> DataFrame:
    """The prefix of every document: ``token``, ``id``, ``n``, ``place`` in its order, ``shared`` (l).

    The order goes by what a shingle is estimated to occur: not more often than its rarest word, nor than
    its own counter says (``sent`` has the counters). Of equal sets within one task, only the first is given.
    """
    usual = float(sent.value[:CELLS].mean())

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sent.value, set()
        for keys, texts in word_hashes(batches):
            tokens, ids, sizes, places, shares = [], [], [], [], []
            for key, words in zip(keys.to_pylist(), texts, strict=True):
                found, at = shingle_set(words, alike.width, places=True)
                name = set_id(found)
                if not len(found) or key is None or name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                n = len(found)
                often = counts[words & np.uint64(CELLS - 1) | np.uint64(CELLS)]
                width = min(alike.width, len(words))
                rarest = np.lib.stride_tricks.sliding_window_view(often, width).min(1)[at]
                often = np.minimum(counts[found & np.uint64(CELLS - 1)], rarest)
                least = int(alike.least_overlap(n))
                prefix = n - least + 1
                # Sets are sorted by hash, so equal counts stay in the order of hashes.
                order = np.argsort(often, kind="stable")[: prefix + MOST_SHARED - 1]
                partners = np.maximum(often[order].astype(np.float64) - usual, 0) + STRAY
                shared = shared_tokens(partners, n, prefix, least)
                taken = found[order[: prefix + shared - 1]].view(np.int64)
                tokens.append(taken)
                k = len(taken)
                ids.append(np.full(k, key, np.int64))
                sizes.append(np.full(k, n, np.int32))
                places.append(np.arange(k, dtype=np.int32))
                shares.append(np.full(k, shared, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (tokens, ids, sizes, places, shares)],
                    names=["token", "id", "n", "place", "shared"],
                )

    return docs.mapInArrow(prefixes, "token bigint, id bigint, n int, place int, shared int")


def sets_of(docs: DataFrame, wanted: DataFrame, alike: Alike) -> DataFrame:
    """``id`` and ``tokens`` of the documents whose ``id`` is in ``wanted``, a distinct list."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sets in shingle_sets(batches, alike.width):
            for at in range(0, len(sets), 500):
                part = sets[at : at + 500]
                arrays = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, part)]), pa.int32()), pa.array(np.concatenate(part).view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([keys.slice(at, 500), arrays], names=["id", "tokens"])

    return docs.join(wanted, "id", "left_semi").mapInArrow(whole, "id bigint, tokens array<bigint>")


def _narrowed(rows: DataFrame, kind: str, alike: Alike) -> DataFrame:
    """The postings that can still be shared by a linked pair of different ``kind`` (id or component), with ``lonely``.

    A token whose postings are all of one kind joins nothing. Those tokens of a set before this one count as
    ``lonely``: no set of another kind that could be linked has them. A posting that too many lonely tokens
    precede is dropped, which may leave other tokens to one kind.
    """
    mixed = rows.groupBy("token").agg(F.min(kind).alias("low"), F.max(kind).alias("high")).filter("low < high")
    kept = rows.join(mixed.select("token"), "token", "left_semi")
    # A prefix is a group of bounded size.
    before = F.row_number().over(W.partitionBy("id", "n").orderBy("place")) - 1
    left = F.col("n") - F.col("lonely")
    return kept.withColumn("lonely", F.col("place") - before).filter(left >= F.ceil(F.lit(alike.per_cent) * F.col("n") / 100))


def _candidates(left: DataFrame, right: DataFrame, alike: Alike, same: Column, all_shared: bool) -> DataFrame:
    """Pairs (x, y), x the smaller, whose postings share tokens and leave room for enough more, with the tokens ``found``.

    What stands before a shared token in one set can only be in the other if it is shared there, too. So
    ``lonely`` tokens are lost to the overlap, and, if the postings hold
    ``all_shared`` tokens of a pair, so are all others up to the last shared one.
    """
    a = left.select("token", *[F.col(c).alias(f"{c}_x") for c in left.columns if c != "token"])
    b = right.select("token", *[F.col(c).alias(f"{c}_y") for c in right.columns if c != "token"])
    x, y = (lambda c: F.col(f"{c}_x")), (lambda c: F.col(f"{c}_y"))
    need = alike.needed(x("n"), y("n"))
    room = F.least(x("place") - x("lonely"), y("place") - y("lonely")) + F.least(x("n") - x("place"), y("n") - y("place"))
    # The first token that a linked pair shares stands so early that the rest of both suffices.
    lost = "place" if all_shared else "lonely"
    likely = (F.least(x("n") - x(lost), y("n") - y(lost)) >= need) & (room >= need) & ~same
    # A pair may come from either side.
    swap = x("id") > y("id")
    both = a.join(b, (a["token"] == b["token"]) & likely).select(
        *[F.when(swap, y(c)).otherwise(x(c)).alias(f"{c}_x") for c in ("id", "n", "place")],
        *[F.when(swap, x(c)).otherwise(y(c)).alias(f"{c}_y") for c in ("id", "n", "place")],
        F.least(x("shared"), y("shared")).alias("shared"),
    )
    pairs = both.groupBy(F.col("id_x").alias("x"), F.col("id_y").alias("y")).agg(
        F.count("*").alias("found"),
        F.min("shared").alias("shared"),
        *[f(c).alias(f"{n}_{c}") for c in ("place_x", "place_y") for n, f in (("first", F.min), ("last", F.max))],
        *[F.min(c).alias(c) for c in ("n_x", "n_y")],
    )

    def most(side: str) -> Column:
        lost = F.col(f"last_place_{side}") + 1 - F.col("found") if all_shared else F.col(f"first_place_{side}")
        return F.col(f"n_{side}") - lost

    return pairs.filter(F.least(most("x"), most("y")) >= alike.needed(x("n"), y("n"))).select("x", "y", "found", "shared")


def _shared_enough(pairs: DataFrame, postings_: DataFrame) -> DataFrame:
    """The pairs whose whole prefixes share as many tokens as the shorter of both was made for."""
    of = postings_.select("token", "id", "shared")
    both = pairs.select("x", "y").join(of.select(F.col("id").alias("x"), "token", F.col("shared").alias("shared_x")), "x")
    both = both.join(of.select(F.col("id").alias("y"), "token", F.col("shared").alias("shared_y")), ["y", "token"])
    found = both.groupBy("x", "y").agg(F.count("*").alias("found"), F.min(F.least("shared_x", "shared_y")).alias("shared"))
    return found.filter("found >= shared").select("x", "y")


def _verified(pairs: DataFrame, docs: DataFrame, alike: Alike, space: Workspace, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    pairs = space.keep(pairs, f"{name}-pairs")
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    sets = space.keep(sets_of(docs, wanted, alike), f"{name}-sets")
    both = (
        pairs.join(sets.select(F.col("id").alias("x"), F.col("tokens").alias("tokens_x")), "x")
        .join(sets.select(F.col("id").alias("y"), F.col("tokens").alias("tokens_y")), "y")
        .withColumn("common", F.size(F.array_intersect("tokens_x", "tokens_y")))
    )
    union = F.size("tokens_x") + F.size("tokens_y") - F.col("common")
    linked = both.filter(100 * F.col("common") >= alike.per_cent * union)
    links = space.keep(linked.select(F.col("x").alias("a"), F.col("y").alias("b")), f"{name}-links")
    space.drop(f"{name}-pairs", f"{name}-sets")
    return links


def join_similar(docs: DataFrame, alike: Alike, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``class_id`` and ``component_id``.

    A class holds the documents of equal sets, and a component those that links lead to; each is named by
    its smallest key. A null or empty text, or one without words, has 0 shingles, no class (null) and is
    its own component. Rows with one key count as one document when links are followed, and each gets a row. Keys
    must be integers; a null key is kept, links with nothing, and its component is null. Other columns are
    not read; no documents give no rows.

    Classes are formed first, so copies are never paired. Tokens that no two classes share are dropped
    before anything is joined. Then each token's most central document is compared with the others, which
    joins groups of near copies without pairing them among themselves; what is left are pairs of a token
    whose components still differ, which are all compared. Texts are read again rather than their sets kept.
    """
    space = Workspace(docs.sparkSession, "jaccard")
    source = _ids(docs, key, text)
    seen = space.keep(summaries(source, alike), "summaries")
    rows = seen.filter("chunk IS NULL").select("id", "n", "set_id")
    counts = total(seen.filter("chunk IS NOT NULL"), 2 * CELLS)
    sets = rows.filter("set_id IS NOT NULL AND id IS NOT NULL").groupBy("set_id")
    classes = space.keep(sets.agg(F.min("id").alias("class_id"), F.count("*").alias("copies")).filter("copies > 1"), "classes")
    alone = F.when(F.col("set_id").isNotNull(), F.col("id"))
    # A row without key is in a class, too, but never the one that names it.
    members = rows.join(classes, "set_id", "left").select("id", "n", F.coalesce("class_id", alone).alias("class_id"))
    members = space.keep(members, "members")
    class_of = members.filter("class_id IS NOT NULL").select("id", "class_id").distinct()

    sent = docs.sparkSession.sparkContext.broadcast(counts)
    prefixes = space.keep(postings(source, alike, sent), "postings")
    sent.destroy()
    common = prefixes.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    met = prefixes.join(common.select("token"), "token", "left_semi").join(class_of, "id")
    met = met.groupBy("token", F.col("class_id").alias("id"), "n").agg(F.min("place").alias("place"), F.min("shared").alias("shared"))
    met = space.keep(met, "met")
    space.drop("summaries", "postings")
    met = space.keep(_narrowed(_narrowed(met, "id", alike), "id", alike), "possible")

    centre = met.groupBy("token").agg(F.min(F.struct("lonely", "place", "id", "n", "shared")).alias("c")).select("token", "c.*")
    same = F.col("id_x") == F.col("id_y")
    near = _candidates(met, centre, alike, same, False).filter("found >= shared").select("x", "y")
    near = _verified(near, source, alike, space, "near")
    joined = components(near, space, "near-components")

    in_component = met.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = space.keep(_narrowed(_narrowed(in_component, "component", alike), "component", alike), "apart")
    main = apart.groupBy("token").agg(F.min(F.struct("lonely", "place", "id", "component")).alias("c"))
    rest = space.keep(apart.join(main.select("token", F.col("c.component").alias("main")), "token"), "rest")
    others = rest.filter("component != main").drop("main")
    # A pair with one side in the main component is found from the other side, one without from its smaller id.
    elsewhere = (F.col("component_x") == F.col("component_y")) | ((F.col("component_y") != F.col("main_y")) & (F.col("id_x") >= F.col("id_y")))
    # Prefixes made for one token give every pair; those few that have room are then held to all their tokens.
    first = F.col("place") <= F.col("n") - F.ceil(F.lit(alike.per_cent) * F.col("n") / 100)
    far = _candidates(others.filter(first), rest.filter(first), alike, elsewhere, True)
    far = _verified(_shared_enough(space.keep(far, "far-first"), rest), source, alike, space, "far")
    linked = components(near.unionByName(far), space, "components").withColumnRenamed("node", "class_id")

    result = members.join(linked, "class_id", "left")
    component = F.coalesce("component", "class_id", "id")
    return result.select(
        F.col("id").cast(docs.schema[key].dataType).alias(key),
        F.col("n").alias("n_shingles"),
        "class_id",
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
    )


def one_of_each(docs: DataFrame, alike: Alike = Alike(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every component of ``join_similar`` the document with the smallest key, with all its columns.

    Rows that share a key are one document: of those that stay, the least by all columns is the one. So is the least of
    rows without key that have the same text. All else without key, and documents without words, are alike to none
    and stay. No documents give none.
    """
    found, space = join_similar(docs, alike, key, text), Workspace(docs.sparkSession, "copies")
    name, mark, row = (unused(n, docs.columns) for n in ("_again", "_mark", "_row"))
    again = found.filter(F.col("component_id") != F.col(key)).select(F.col(key).alias(name)).distinct()
    kept = docs.join(space.keep(again, "again"), docs[key] == F.col(name), "left_anti")
    # A row's identity among those that may be one document; only rows that share it are brought together.
    same = F.when(F.col(key).isNull(), F.xxhash64(F.coalesce(F.col(text), F.lit("")))).otherwise(F.xxhash64(F.col(key), F.lit(1)))
    shared = docs.groupBy(same.alias(mark)).agg(F.count("*").alias(name)).filter(F.col(name) > 1).select(mark)
    shared = space.keep(shared, "shared")
    if shared.isEmpty():
        return kept
    marked = kept.withColumn(mark, same)
    alone = marked.join(shared, mark, "left_anti").select(*docs.columns)
    identity = [F.col(mark), F.col(key), F.when(F.col(key).isNull(), F.col(text))]
    first = marked.join(shared, mark, "left_semi").groupBy(*[c.alias(f"{mark}{i}") for i, c in enumerate(identity)])
    first = first.agg(F.min(F.struct(*docs.columns)).alias(row)).select(f"{row}.*")
    return alone.unionByName(first)
