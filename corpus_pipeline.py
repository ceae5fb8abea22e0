"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor wrote. All but the last return the
columns of documents.

* quality classifier: documents with a score under the threshold go.
* line dedup: a line in ten documents or more stays in the first of them only;
  a document that loses all its lines goes.
* n-gram Jaccard join: of each class of near copies the smallest doc_id stays.
* benchmark decontamination: documents that share a window with an item go.
* packing: the rest becomes windows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreline.llm.decontaminate import drop_contaminated
from acreline.llm.linededup import keep_first_lines
from acreline.llm.nearjoin import keep_one
from acreline.llm.packing import pack
from acreline.llm.quality import keep_good
from acreline.runtime import stored


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, _read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The classifier and the tokenizer are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
