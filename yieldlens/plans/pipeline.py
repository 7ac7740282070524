"""From click and purchase tables to recommendations, as one plan or as a batch job with stored results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from yieldlens.functions.threshold import MinUtility
from yieldlens.operators.matrix import cps, session_items, utility_matrix, whuom
from yieldlens.operators.profile import row_counts
from yieldlens.operators.recommend import as_lists, recommend
from yieldlens.operators.utility import high_utility_items
from yieldlens.plans.checkpoints import stored
from yieldlens.sources.tables import first_rows, load_clicks, load_matrix, load_purchases, save_matrix


@dataclass(frozen=True)
class Settings:
    """``nonnegative`` promises that no purchase has a negative utility; see ``high_utility_items``."""

    min_utility: MinUtility = MinUtility.of_amount(1000)
    top_k: int = 3
    nonnegative: bool = False

    @property
    def max_items(self) -> int | None:
        return self.min_utility.max_items if self.nonnegative else None


def mined_items(purchases: DataFrame, settings: Settings) -> DataFrame:
    return high_utility_items(purchases, settings.min_utility, settings.nonnegative)


def matrix_from_events(clicks: DataFrame, purchases: DataFrame, settings: Settings) -> DataFrame:
    """The weights of all pairs. Items whose number has no bound beforehand are computed and counted on call."""
    items, size = mined_items(purchases, settings), settings.max_items
    if size is None:
        items, size = stored(items)
    return utility_matrix(clicks, purchases, items, size)


def mine_and_recommend(clicks: DataFrame, purchases: DataFrame, settings: Settings) -> DataFrame:
    """Mine items, weigh pairs and recommend to every clicking session.

    The matrix is computed on call: its size decides how the sessions are scored.
    """
    matrix, rows = stored(matrix_from_events(clicks, purchases, settings))
    return recommend(session_items(clicks, "click_item"), matrix, settings.top_k, rows)


def stage_counts(clicks: DataFrame, purchases: DataFrame, settings: Settings) -> DataFrame:
    """How many rows each step of the pipeline has."""
    items = mined_items(purchases, settings)
    counts = cps(clicks, purchases)
    return row_counts(
        {
            "clicks": clicks,
            "purchases": purchases,
            "items": items,
            "pairs": counts,
            "weights": whuom(counts, items, settings.max_items),
        }
    )


def run_batch(
    spark: SparkSession,
    click_path: str,
    purchase_path: str,
    out_dir: str,
    settings: Settings = Settings(),
    fmt: str = "csv",
    rows: int | None = None,
) -> dict[str, int]:
    """The whole job from files to files: how many rows each stage has, as ``stage_counts`` names them, and the lists.

    Under ``out_dir`` are the cleaned ``clicks`` and ``purchases``, ``items``, ``pairs``, ``matrix`` and
    ``recommendations``. Each is written once, its rows counted as they pass, and read back by the steps that need it: the
    inputs are read and parsed once, nothing is computed twice, and a lost executor costs only its own tasks. ``rows``
    keeps the first rows of each input.
    """
    counts: dict[str, int] = {}

    def kept(df: DataFrame, name: str) -> DataFrame:
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out_dir}/{name}")
        counts[name] = seen.get["rows"]
        return spark.read.schema(df.schema).parquet(f"{out_dir}/{name}")

    clicks = kept(first_rows(load_clicks(spark, click_path, fmt), ["session_id", "ts", "item_id"], rows), "clicks")
    purchases = first_rows(load_purchases(spark, purchase_path, fmt), ["session_id", "ts", "item_id", "price"], rows)
    purchases = kept(purchases, "purchases")
    items = kept(mined_items(purchases, settings), "items")
    pairs = kept(cps(clicks, purchases), "pairs")
    save_matrix(whuom(pairs, items, counts["items"]), f"{out_dir}/matrix")
    # Stored rows are counted from the files' footers.
    counts["weights"] = load_matrix(spark, f"{out_dir}/matrix").count()
    kept(serve(spark, f"{out_dir}/matrix", clicks, settings.top_k), "recommendations")
    return counts


def serve(spark: SparkSession, matrix_path: str, clicks: DataFrame, top_k: int = 5) -> DataFrame:
    """Recommendation lists for a table of clicks from a stored matrix."""
    matrix = load_matrix(spark, matrix_path)
    return as_lists(recommend(session_items(clicks, "click_item"), matrix, top_k, matrix.count()))
