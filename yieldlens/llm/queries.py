"""The registered queries of these operators, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldlens.llm import (
    alignment,
    chat,
    contamination,
    jaccard,
    minhash,
    packing,
    quality,
    resampling,
    rtree,
    secrets,
    surrogates,
    token_counts,
    warc,
)
from yieldlens.llm.oracles import ORACLE_SQL
from yieldlens.llm.storage import Workspace

# A secret in use; here one that anybody may know, so that answers can be compared.
SURROGATE_KEY = b"public key of the registered query"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_branches(chat.conversation_messages(rows)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return verdicts.select("doc_id", *counts, "base_failed", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return contamination.contaminated(documents, benchmark)


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(documents, SURROGATE_KEY)


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages become old archives of both versions, those new ones, and these the rows."""
    space = Workspace(spark, "archives")
    html = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    # The old header line has its fields between blanks.
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("about:blank"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    pages = _table(spark, sf_dir, "pages").select(
        F.when(url == "", "about:blank").otherwise(url).alias("url"),
        F.lit("192.0.2.1").alias("ip"),
        F.lit("20010203040506").alias("date"),
        F.lit("text/html; charset=UTF-8").alias("mime"),
        (F.pmod(F.xxhash64("page_id"), F.lit(2)) + 1).alias("version"),
        F.concat(F.encode(head, "utf-8"), html).alias("block"),
    )
    page = F.regexp_extract("head", r"\r\nX-Page-Id: (-?[0-9]+)\r\n", 1).try_cast("long")
    warc.write_arc(pages, f"{space.path}/arc")
    warc.write_warc(warc.read_arc(spark, f"{space.path}/arc"), f"{space.path}/warc", order=page)
    read = warc.read_warc(spark, f"{space.path}/warc").withColumn("page_id", page)
    full = read.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("full_page"),
        F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest"),
    )
    again = F.col("record_type") == "revisit"
    return read.join(full, "refers_to", "left").select(
        "page_id",
        F.when(again, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("full_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.when(again, F.col("full_page")).alias("refers_to"),
    )


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(_table(spark, sf_dir, "documents")))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents labelled as good and not as toxic."""
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    target = labels.filter("quality = 1 AND toxic = 0")
    return resampling.resampled(_table(spark, sf_dir, "documents"), target).withColumn("kept", F.lit(True))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join_similar(_table(spark, sf_dir, "documents"), jaccard.Alike(width=3, per_cent=90))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", length=1024, end_id=2)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"groups_sha256": "if(groups = '', '', sha2(groups, 256))"}
    return alignment.align(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model", carry=digest)


def op12_minhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), minhash.Bands(width=2, per_cent=80))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is wrong on purpose; vectors are taken in steps of 1/256."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    vectors = _table(spark, sf_dir, "embeddings").filter(finite).select("vec_id", wrong.alias("label"), steps.alias("vector"))
    return rtree.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Query]:
    registered = (
        op1_chat_formatting,
        op2_quality_rules,
        op3_decontamination,
        op4_surrogates,
        op5_arc_to_warc,
        op6_secret_scans,
        op7_importance_resampling,
        op8_jaccard_join,
        op9_best_fit_packing,
        op10_token_counts,
        op11_token_alignment,
        op12_minhash_duplicates,
        op13_hard_negatives,
    )
    return {query.__name__: query for query in registered}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
