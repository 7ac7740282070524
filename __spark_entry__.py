
from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import ORACLE_SQL  # noqa: E402
from yieldlens.functions.columns import category_kind, sequence_text  # noqa: E402
from yieldlens.functions.threshold import MinUtility  # noqa: E402
from yieldlens.operators import matrix as mx  # noqa: E402
from yieldlens.operators import patterns, profile, recommend, sequences, utility  # noqa: E402
from yieldlens.plans import pipeline  # noqa: E402
from yieldlens.plans.checkpoints import stored, use_checkpoints  # noqa: E402
from yieldlens.sources import adapters as src  # noqa: E402
from yieldlens.sources import tables  # noqa: E402
from yieldlens.streaming import scoring  # noqa: E402

# Thresholds are shares of the total utility, so that they mean the same at every scale.
ITEMS = MinUtility.of_share("0.01")
SHARDED = MinUtility.of_share("0.003")
LONGER = MinUtility.of_share("0.0003")
ITEMSETS = MinUtility.of_share("0.004")
ORDER_ITEMS = MinUtility.of_share("0.0006")
SHARDS = 4
TOP_K = 5
FIRST_ROWS = 1_000
# So few that sessions of the test tables continue over several rows.
PART_ROWS = 2

# Prices and quantities of the test tables are never negative; the operators check that.
PIPELINE = pipeline.Settings(min_utility=ITEMS, top_k=3, nonnegative=True)

Query = Callable[[SparkSession, str], DataFrame]


def _double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


def _plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _on_clicks(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(src.event_clicks(spark, sf))


def _on_purchases(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(src.event_purchases(spark, sf))


def _on_orders(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(src.order_purchases(spark, sf))


def _on_both(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(src.event_clicks(spark, sf), src.event_purchases(spark, sf))


def _clicked(clicks: DataFrame) -> DataFrame:
    return mx.session_items(clicks, "click_item")


def _items(purchases: DataFrame) -> DataFrame:
    return pipeline.mined_items(purchases, PIPELINE)


def _matrix(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    return pipeline.matrix_from_events(clicks, purchases, PIPELINE)


def _scores(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    return recommend.score(_clicked(clicks), *stored(_matrix(clicks, purchases)))


def _top(scores: DataFrame) -> DataFrame:
    return recommend.top_items(scores, TOP_K)


def _drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    raw = src.event_rows_with_gaps(spark, sf).drop("ts")
    return tables.drop_incomplete(raw, tables.CLICK_KEYS)


def _purchase_sequences(purchases: DataFrame) -> DataFrame:
    listed = sequences.purchase_sequences(purchases, src.EVENT_ORDER, PART_ROWS)
    entry = F.transform(
        "purchases", lambda p: F.concat_ws(":", p["item_id"].cast("string"), p["utility"].cast("string"))
    )
    return listed.select("session_id", "part", F.array_join(entry, ">").alias("purchases"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{use_checkpoints(spark)}/{name}-{uuid.uuid4().hex}"


def _load_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as the lines of a click file, some without session or item, and loaded from there."""
    path = _folder(spark, "clicks")
    raw = src.event_rows_with_gaps(spark, sf)
    lines = raw.select("session_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "item_id", "category")
    lines.write.csv(path, emptyValue="")
    return _plain_time(tables.load_clicks(spark, path))


def _load_purchases(spark: SparkSession, sf: str) -> DataFrame:
    """The same for purchases, at prices finer than a cent and in quantities of one to three."""
    path = _folder(spark, "purchases")
    lines = src.event_purchases(spark, sf).select(
        "session_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "item_id",
        (F.col("price") / 8).cast("decimal(18,5)"),
        F.col("event_id") % 3 + 1,
    )
    lines.write.csv(path)
    return _double(_plain_time(tables.load_purchases(spark, path)), "price", "utility")


def _category_code() -> Column:
    """Each kind of category in turn."""
    turn = F.col("event_id") % 5
    return F.when(turn == 0, "S").when(turn == 1, "0").when(turn == 2, F.col("item_id").cast("string")).when(turn == 3, "12")


def _matrix_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "matrix")
    tables.save_matrix(_matrix(src.event_clicks(spark, sf), src.event_purchases(spark, sf)), path)
    return _double(tables.load_matrix(spark, path), "weight")


def _stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks in three batches, not in order of time, with six hours to live; then every session's latest list."""
    clicks = src.event_clicks(spark, sf)
    matrix, rows = stored(_matrix(clicks, src.event_purchases(spark, sf)))
    scorer = scoring.ClickScorer(matrix, _folder(spark, "stream"), TOP_K, rows, timedelta(hours=6))
    for batch in range(3):
        scorer.score_batch(clicks.filter(F.col("event_id") % 3 == batch), batch)
    return _as_text(scoring.latest_answers(spark, scorer.store))


def _as_text(lists: DataFrame) -> DataFrame:
    money = F.transform("scores", lambda s: s.cast("decimal(18,2)").cast("string"))
    return lists.select(
        "session_id", F.array_join("items", ">").alias("items"), F.array_join(money, ">").alias("scores")
    )


def _recommend_lists(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    return _as_text(recommend.as_lists(_top(_scores(clicks, purchases))))


def _recommend_click_only(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    matrix, rows = stored(_matrix(clicks, purchases))
    return recommend.recommend(recommend.click_only(clicks, purchases), matrix, TOP_K, rows)


def _expected_profit(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    items = _items(purchases)
    kept = mx.purchases_of(purchases, items, PIPELINE.max_items)
    edges, rows = stored(mx.profit_edges(mx.cps(clicks, kept), clicks, items, PIPELINE.max_items))
    return recommend.expected_profit(_clicked(clicks), edges, TOP_K, rows)


def _frequent(df: DataFrame, support: float, length: int, order: list[str]) -> DataFrame:
    found = sequences.frequent_sequences(df, support, length, order)
    return found.select(sequence_text("sequence").alias("sequence"), "freq")


def _valuable(df: DataFrame, least: MinUtility, length: int, shortest: int = 1, **how: object) -> DataFrame:
    found = patterns.high_utility_sequences(df, least, length, **how)
    long_enough = found.filter(F.size(F.flatten("pattern")) >= shortest)
    return _double(long_enough.select(sequence_text("pattern").alias("pattern"), "utility"), "utility")


def _brands_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return src.order_purchases(spark, sf).select(
        "session_id", F.date_trunc("year", "ts").alias("ts"), F.col("brand").alias("item_id"), "utility"
    )


def entry(spark: SparkSession) -> DataFrame:
    """Which items of high value should each clicking session see? From events to ranked items."""
    return queries()["mine_and_recommend"](spark, "/root/testdata/sf0.001")


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL for language-model data; none where that subpackage can not be imported."""
    try:
        more = importlib.import_module("yieldlens.llm.queries")
        corpus = importlib.import_module("corpus_pipeline")
    except ImportError:
        return {}, {}
    sql = {} if corpus.ORACLE_SQL is None else {"pipeline": corpus.ORACLE_SQL}
    return more.queries() | {"pipeline": corpus.run}, more.oracle_sql() | sql


def queries() -> dict[str, Query]:
    return _own_queries() | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | _llm()[1]


def _own_queries() -> dict[str, Query]:
    return {
        # Sources, cleaning, profile
        "load_clicks": _load_clicks,
        "load_purchases": _load_purchases,
        "category_kinds": _on_clicks(lambda c: c.select("event_id", category_kind(_category_code()).alias("kind"))),
        "drop_incomplete": _drop_incomplete,
        "purchase_utility": _on_orders(
            lambda o: _double(o.select("session_id", "item_id", "price", "quantity", "utility"), "price", "utility")
        ),
        "price_quantile": _on_purchases(lambda p: _rounded(profile.quantile(p, "price"), "quantile")),
        "trim_outliers": _on_purchases(
            lambda p: _double(profile.trim_outliers(p).select("session_id", "event_id", "item_id", "price"), "price")
        ),
        "utility_trimmed": _on_purchases(lambda p: _double(utility.item_utility(profile.trim_outliers(p)), "utility")),
        "price_histogram": _on_purchases(profile.histogram),
        "limit_rows": _on_clicks(
            lambda c: _plain_time(tables.first_rows(c, ["session_id", "ts", "event_id"], FIRST_ROWS))
        ),
        "top_clicked_items": _on_clicks(profile.top_items_by_count),
        "conversion_rate": _on_both(
            lambda c, p: _rounded(profile.conversion(c, p), "buy_click_ratio", "buying_session_ratio")
        ),
        "popularity_share": _on_clicks(lambda c: _rounded(profile.popularity_share(c), "top_share")),
        "stage_counts": _on_both(lambda c, p: pipeline.stage_counts(c, p, PIPELINE)),
        # Sequences
        "distinct_session_items": _on_clicks(mx.session_items),
        "click_sequences": _on_clicks(
            lambda c: sequences.click_sequences(c, src.EVENT_ORDER, PART_ROWS).select(
                "session_id",
                "part",
                F.array_join("items", ">").alias("items"),
                sequence_text("sequence").alias("sequence"),
            )
        ),
        "purchase_sequences": _on_purchases(_purchase_sequences),
        "prefixspan": lambda spark, sf: _frequent(src.event_types(spark, sf), 0.05, 3, src.EVENT_ORDER),
        "prefixspan_items": _on_clicks(
            lambda c: _frequent(c.withColumn("item_id", F.col("item_id") % 10), 0.002, 3, src.EVENT_ORDER)
        ),
        "prefixspan_orders": lambda spark, sf: _frequent(src.order_states(spark, sf), 0.1, 3, src.STATE_ORDER),
        # Utility mining
        "session_utility": _on_purchases(lambda p: _double(utility.session_utility(p), "utility")),
        "item_utility": _on_purchases(lambda p: _double(utility.item_utility(p), "utility")),
        "swu": _on_purchases(lambda p: _double(utility.swu(p), "swu")),
        "promising_items": _on_purchases(lambda p: _double(utility.promising_items(p, ITEMS), "swu")),
        "huspm_items": _on_purchases(lambda p: _double(_items(p), "utility")),
        "huspm_items_none": _on_purchases(
            lambda p: _double(utility.high_utility_items(p, MinUtility.of_share("1")), "utility")
        ),
        "huspm_sharded_max": _on_purchases(
            lambda p: _double(utility.high_utility_items_by_shard(p, SHARDED, SHARDS, "max"), "utility")
        ),
        "huspm_sharded_sum": _on_purchases(
            lambda p: _double(utility.high_utility_items_by_shard(p, SHARDED, SHARDS, "sum"), "utility")
        ),
        "swu_orders": _on_orders(lambda o: _double(utility.swu(o), "swu")),
        "huspm_orders": _on_orders(lambda o: _double(utility.high_utility_items(o, ORDER_ITEMS), "utility")),
        "huspm_len2": _on_purchases(lambda p: _valuable(p, LONGER, 2, shortest=2, order=src.EVENT_ORDER)),
        "huspm_patterns": _on_purchases(lambda p: _valuable(p, LONGER, 3, order=src.EVENT_ORDER)),
        "huspm_itemsets": lambda spark, sf: _valuable(
            _brands_by_year(spark, sf), ITEMSETS, 3, order=["ts"], singletons=False
        ),
        # Matrices
        "cps": _on_both(mx.cps),
        "cps_probability": _on_both(lambda c, p: _rounded(mx.cps_probability(mx.cps(c, p), c), "probability")),
        "whuom": _on_both(lambda c, p: _double(_matrix(c, p), "weight")),
        "matrix_roundtrip": _matrix_roundtrip,
        "whuom_left": _on_both(lambda c, p: _double(mx.whuom_left(mx.cps(c, p), _items(p)), "weight")),
        "whuom_log": _on_both(
            lambda c, p: _rounded(mx.whuom_log(mx.cps(c, p), _items(p), PIPELINE.max_items), "weight")
        ),
        # Recommendations
        "recommend_scores": _on_both(lambda c, p: _double(_scores(c, p), "score")),
        "recommend_topk": _on_both(lambda c, p: _double(_top(_scores(c, p)), "score")),
        "recommend_lists": _on_both(_recommend_lists),
        "recommend_unseen": _on_both(
            lambda c, p: _double(recommend.top_unseen(_scores(c, p), p, TOP_K), "score")
        ),
        "recommend_holdout": _on_both(lambda c, p: _double(recommend.recommend_held_out(c, p, ITEMS), "score")),
        "recommend_click_only": _on_both(lambda c, p: _double(_recommend_click_only(c, p), "score")),
        "expected_profit": _on_both(lambda c, p: _double(_expected_profit(c, p), "expected_profit")),
        "stream_scores": _stream_scores,
        "mine_and_recommend": _on_both(lambda c, p: _double(pipeline.mine_and_recommend(c, p, PIPELINE), "score")),
    }
