"""Recommendations that follow a stream of clicks.

A session's clicks arrive over several micro-batches, and every answer needs all of them. Each
batch therefore stores its clicks, and the sessions it touched are scored again over their stored
clicks. Both tables lie in a folder shared by all executors, in subfolders per batch that a
retried batch overwrites, so a failure at any point leaves neither gaps nor duplicates.

    <store>/clicks/day=YYYY-MM-DD/batch_id=N    the clicks of batch N
    <store>/answers/batch_id=N                  lists for the sessions touched by batch N

What a session is answered depends on its own clicks alone, however they were cut into batches.
With a time to live a batch reads the days from its oldest click on, less that time, and those
clicks that have no time.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yieldlens.operators.matrix import session_items
from yieldlens.operators.recommend import as_lists, recommend

STORED_CLICK = "session_id bigint, ts timestamp, item_id bigint, day date, batch_id bigint"
UNDATED = date(1970, 1, 1)


def within(clicks: DataFrame, ttl: timedelta) -> DataFrame:
    """The clicks no older than ``ttl`` before their session's newest one, and those without a time."""
    newest = clicks.groupBy("session_id").agg(F.max("ts").alias("newest"))
    young = F.col("ts") >= F.col("newest") - F.lit(ttl)
    return clicks.join(newest, "session_id").filter(F.col("ts").isNull() | young).drop("newest")


@dataclass(frozen=True)
class ClickScorer:
    """``session_ttl`` limits a session to the clicks within this time of its own newest click.

    ``matrix_rows`` is the size of the matrix; ``start`` counts it where it is not given.
    """

    matrix: DataFrame
    store: str
    top_k: int = 5
    matrix_rows: int | None = None
    session_ttl: timedelta | None = None

    def start(self, clicks: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        """Score ``clicks``, a streaming table; the default trigger works off what is there and stops."""
        scorer = self if self.matrix_rows is not None else replace(self, matrix_rows=self.matrix.count())
        return (
            clicks.writeStream.foreachBatch(scorer.score_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def score_batch(self, clicks: DataFrame, batch_id: int) -> None:
        batch = clicks.select("session_id", "ts", "item_id").persist()
        try:
            dated = batch.withColumns(
                {"day": F.coalesce(F.to_date("ts"), F.lit(UNDATED)), "batch_id": F.lit(batch_id)}
            )
            (
                # Files are sorted by session, so that reading a few sessions skips row groups.
                dated.repartition("day", F.pmod(F.xxhash64("session_id"), F.lit(16))).sortWithinPartitions("session_id")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day", "batch_id")
                .parquet(f"{self.store}/clicks")
            )
            touched = batch.select("session_id").distinct()
            mine = self._history(batch, batch_id).join(touched, "session_id", "left_semi")
            if self.session_ttl is not None:
                mine = within(mine, self.session_ttl)
            lists = as_lists(recommend(session_items(mine, "click_item"), self.matrix, self.top_k, self.matrix_rows))
            # A touched session without a recommendation is stored too, so that no older list survives.
            touched.join(lists, "session_id", "left").write.mode("overwrite").parquet(
                f"{self.store}/answers/batch_id={batch_id}"
            )
        finally:
            batch.unpersist()

    def _history(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Stored clicks, at least all that the touched sessions still need.

        A session's newest click is not older than its oldest in the batch. So nothing it needs is older than
        that less the time to live. For a session of which the batch has undated clicks only, nothing is known.
        """
        stored = batch.sparkSession.read.schema(STORED_CLICK).option("basePath", f"{self.store}/clicks")
        clicks = stored.parquet(f"{self.store}/clicks").filter(F.col("batch_id") <= batch_id)
        if self.session_ttl is None:
            return clicks
        oldest = batch.groupBy("session_id").agg(F.min("ts").alias("ts")).agg(
            F.min("ts").alias("first"), F.max(F.col("ts").isNull()).alias("unknown")
        ).select(F.to_date(F.col("first") - F.lit(self.session_ttl)).alias("day"), "unknown").first()
        if oldest.unknown or oldest.day is None:
            return clicks
        # The days are folders; only these are listed and read.
        return clicks.filter((F.col("day") >= F.lit(oldest.day)) | (F.col("day") == F.lit(UNDATED)))


def latest_answers(spark: SparkSession, store: str) -> DataFrame:
    """The newest lists of every session that has any."""
    answers = spark.read.parquet(f"{store}/answers")
    newest = F.max_by(F.struct("items", "scores"), "batch_id").alias("answer")
    return answers.groupBy("session_id").agg(newest).filter(F.col("answer.items").isNotNull()).select(
        "session_id", "answer.items", "answer.scores"
    )
