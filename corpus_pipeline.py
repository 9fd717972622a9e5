"""The corpus pipeline: from raw documents to the tokens of what is worth training on."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, decontaminate, jaccard, langid, quality
from strataflow.llm._scratch import Scratch

#: Near copies share this share, in percent, of their runs of so many words; op4's query has a contract of its own.
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
#: Rows that Spark hands to Python at a time in this application's session: texts are long, and a task holds a batch on either side.
ARROW_ROWS = "2000"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this application's setting; stages return plans, so it holds until they have run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def tidy(spark: SparkSession) -> None:
    """Has the driver collect garbage, so that Spark lets executors drop broadcasts of plans that are gone."""
    spark._jvm.System.gc()


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined go on."""
    prepared(spark)
    return langid.keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the risk-controlled rules keep go on."""
    with Scratch(prepared(spark), "pipeline-quality") as scratch:
        return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), scratch)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies goes on."""
    with Scratch(prepared(spark), "pipeline-copies", lambda: tidy(spark)) as scratch:
        return jaccard.keep_one_of_each(docs, scratch, k=STAGE_SHINGLE, percent=STAGE_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    with Scratch(prepared(spark), "pipeline-decontamination") as scratch:
        return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of the token ids and of the decoded bytes."""
    prepared(spark)
    return bpe.token_digests(docs, functools.partial(public_tokenizers.path, "byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: The stages learn, so no SQL tells their rows; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        return scratch.publish(STAGES[-1][1](spark, docs, sf_dir))
