"""The operators over the given tables, as the driver registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.ann import nearest

    rows = _read(spark, sf_dir, "embeddings")
    return nearest(rows, rows.select("vec_id").where("vec_id % 50 = 0"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of documents, maintained: all come in with no tokens, half of them (by a hash) are then revised to
    their counts, the others deleted and brought in again; one batch is sent twice and all are folded into one."""
    from acreline.llm.tokencounts import Rollup, changes, count_tokens
    from acreline.runtime import new_path, stored

    rollup = Rollup(spark, new_path(spark, "rollup"))
    counted = stored(count_tokens(_read(spark, sf_dir, "documents")), "counted")
    half = F.xxhash64(F.coalesce("doc_id", F.lit(-1))) % 2 == 0
    none = F.lit(0).cast("long")
    rollup.apply("arrivals", changes(counted, "insert", new=none))
    rollup.apply("second looks", changes(counted.where(half), "revise", new=F.col("tokens"), old=none).unionByName(changes(counted.where(~half), "delete", old=none)))
    rollup.apply("arrivals", changes(counted, "insert", new=none))
    rollup.compact()
    rollup.apply("returns", changes(counted.where(~half), "insert", new=F.col("tokens")))
    return rollup.totals()


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.nearjoin import jaccard_join

    return jaccard_join(_read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.linededup import dedup_lines

    made = dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.sharding import assign

    made = assign(_read(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.quality import classify

    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.chat import digest, windows

    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digest(windows(turns.unionByName(more)))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.decontaminate import find_contamination

    found = find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from acreline.llm.urlfilter import judge

    # a label stands for the page of the same number; without quality and toxic it says nothing
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    outcomes = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge(_read(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_nearest_neighbours,
        op2_token_counts,
        op3_ngram_jaccard_join,
        op4_packing,
        op5_line_dedup,
        op6_sharding,
        op7_quality,
        op8_chat_formatting,
        op9_decontamination,
        op10_url_filters,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    from acreline.llm import decontaminate, linededup, nearjoin, urlfilter

    return {"op3_ngram_jaccard_join": nearjoin.ORACLE, "op5_line_dedup": linededup.ORACLE, "op9_decontamination": decontaminate.ORACLE, "op10_url_filters": urlfilter.oracle()}
