"""Scoring of clicked items against a matrix, and the best items per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.functions.threshold import MinUtility
from yieldlens.operators.matrix import session_items
from yieldlens.operators.skew import is_small, split_join
from yieldlens.plans.checkpoints import stored


def _scored(
    clicks: DataFrame, edges: DataFrame, keys: list[str], edge_rows: int | None, *aggregates: Column
) -> DataFrame:
    """Join clicks with the edges of their items and aggregate per session and purchasable item.

    A click meets as many edges as its item has, so the joined rows far outnumber the clicks. If
    the edges are counted and few, the clicks are brought together by session before they multiply:
    the sums, and later the ranking, then need no shuffle, and no session can multiply to more rows
    than there are edges. Else both sides are shuffled by item, with hot items spread.
    """
    if is_small(edge_rows):
        # A fixed number of partitions: merged by their size before the join they would be too few.
        partitions = int(clicks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        joined = clicks.repartition(partitions, "session_id").join(F.broadcast(edges), keys)
    else:
        joined = split_join(clicks, edges, keys, ["session_id"], ["purchase_item"])
    return joined.groupBy("session_id", F.col("purchase_item").alias("item_id")).agg(*aggregates)


def score(clicks: DataFrame, matrix: DataFrame, matrix_rows: int | None = None) -> DataFrame:
    """Sum of weights per session and purchasable item.

    ``clicks`` has session_id and click_item and is taken as it is: an item given twice counts
    twice. Sessions whose clicks have no weight do not appear. ``matrix_rows`` is the number of rows
    of the matrix where it has been counted.
    """
    return _scored(clicks, matrix, ["click_item"], matrix_rows, F.sum("weight").alias("score"))


def without_bought(scores: DataFrame, purchases: DataFrame) -> DataFrame:
    """Drop items the session has bought already."""
    return scores.join(session_items(purchases), ["session_id", "item_id"], "left_anti")


def top_items(scores: DataFrame, top_k: int = 5) -> DataFrame:
    """The ``top_k`` highest scores of each session; the smaller item id wins a tie."""
    best = W.partitionBy("session_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    return (
        scores.withColumn("rank", F.row_number().over(best).cast("bigint"))
        .filter(F.col("rank") <= top_k)
        .select("session_id", "rank", "item_id", "score")
    )


def top_unseen(scores: DataFrame, purchases: DataFrame, top_k: int = 5) -> DataFrame:
    """``top_items`` of ``without_bought``: the ``top_k`` highest scores of each session among items it has not bought.

    Of a session's best ``top_k`` and as many more as it has bought, at most those can be bought. So that many are
    ranked where the scores lie, by session, and only they are shuffled again to be held against the purchases.
    """
    counts = session_items(purchases).groupBy("session_id").agg(F.count("*").alias("bought"))
    best = W.partitionBy("session_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    ranked = scores.withColumn("rank", F.row_number().over(best)).join(counts, "session_id", "left")
    enough = ranked.filter(F.col("rank") <= F.lit(top_k) + F.coalesce("bought", F.lit(0)))
    return top_items(without_bought(enough.select("session_id", "item_id", "score"), purchases), top_k)


def as_lists(ranked: DataFrame) -> DataFrame:
    """One row per session with its items and scores, best first. A list has at most top_k entries."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    return ranked.groupBy("session_id").agg(entries.alias("entries")).select(
        "session_id",
        F.col("entries.item_id").alias("items"),
        F.col("entries.score").alias("scores"),
    )


def recommend(
    clicks: DataFrame, matrix: DataFrame, top_k: int = 5, matrix_rows: int | None = None
) -> DataFrame:
    """The ``top_k`` items for each session of ``clicks`` (session_id, click_item)."""
    return top_items(score(clicks, matrix, matrix_rows), top_k)


def expected_profit(clicks: DataFrame, edges: DataFrame, top_k: int = 5, edge_rows: int | None = None) -> DataFrame:
    """Per session: sum over its recommended items of P(Buy|Click) times utility.

    ``edges`` comes from ``profit_edges``. Where several clicked items lead to one recommended item
    the largest probability counts.
    """
    scores = _scored(
        clicks, edges, ["click_item"], edge_rows, F.sum("weight").alias("score"), F.max("gain").alias("gain")
    )
    best = W.partitionBy("session_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    chosen = scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_k)
    return chosen.groupBy("session_id").agg(F.sum("gain").alias("expected_profit"))


def click_only(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    """The clicked items of sessions that bought nothing."""
    buyers = purchases.select("session_id").distinct()
    return split_join(session_items(clicks, "click_item"), buyers, ["session_id"], ["click_item"], how="left_anti")


def _without_own_fold(rows: DataFrame, keys: list[str], amount: Column, folds: int) -> DataFrame:
    """Sums by ``keys``, as an array by fold: what all sessions but those of the fold add up to."""
    own = F.pmod("session_id", F.lit(folds))
    in_fold = [F.coalesce(F.sum(F.when(own == f, amount)), F.lit(0)).alias(f"f{f}") for f in range(folds)]
    sums = rows.groupBy(*keys).agg(F.sum(amount).alias("all"), *in_fold)
    return sums.select(*keys, F.array(*[F.col("all") - F.col(f"f{f}") for f in range(folds)]).alias("others"))


def _held_out_matrix(clicked: DataFrame, purchases: DataFrame, share: MinUtility, folds: int) -> DataFrame:
    """One matrix per fold, column ``model``, built from the sessions of all other folds.

    A model's count is the total less its own fold's, so pairs are shuffled once, and become one row per model
    only after the items that no model wants have gone.
    """
    items = _without_own_fold(purchases, ["item_id"], F.col("utility"), folds).select(
        F.col("item_id").alias("purchase_item"), F.posexplode("others").alias("model", "utility")
    )
    # One row per fold.
    totals = F.broadcast(items.groupBy("model").agg(F.sum("utility").alias("total")))
    wanted = items.join(totals, "model").filter(
        (F.col("utility") > 0) & (F.col("utility") >= F.col("total") * F.lit(share.share))
    )
    models = wanted.groupBy("purchase_item").agg(F.collect_list(F.struct("model", "utility")).alias("models"))
    both = split_join(clicked, session_items(purchases, "purchase_item"), ["session_id"], ["click_item"], ["purchase_item"])
    pairs = _without_own_fold(both, ["click_item", "purchase_item"], F.lit(1), folds)
    return (
        split_join(pairs, models, ["purchase_item"], ["click_item"])
        .select("click_item", "purchase_item", "others", F.inline("models"))
        .withColumn("cps", F.get("others", F.col("model")))
        .filter("cps > 0")
        .select("model", "click_item", "purchase_item", (F.col("cps") * F.col("utility")).alias("weight"))
    )


def recommend_held_out(
    clicks: DataFrame, purchases: DataFrame, share: MinUtility, folds: int = 5, top_k: int = 5
) -> DataFrame:
    """Items for every session, from a matrix that was built without that session's fold.

    A session is in fold ``session_id mod folds``. ``share`` must be a relative threshold and applies to
    what each model has seen. The matrices are computed on call.
    """
    if share.share is None:
        raise ValueError("held-out scoring needs a relative threshold")
    clicked = session_items(clicks, "click_item")
    matrix, rows = stored(_held_out_matrix(clicked, purchases, share, folds))
    asked = clicked.withColumn("model", F.pmod("session_id", F.lit(folds)).cast("int"))
    return top_items(_scored(asked, matrix, ["model", "click_item"], rows, F.sum("weight").alias("score")), top_k)
