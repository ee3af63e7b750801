"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, the mixture, and token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next stage's docs. All stages but the last keep the columns of docs. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import decontaminate, mixing, near_dups, quality, token_files
from scoreloom.llm.common import ready
from scoreloom.llm.queries import WORD_VOCABULARY
from scoreloom.session import new_table_path

#: The random ranks of the mixture and the tokenizer's ids can't be had in SQL; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    ready(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies, the one with the least id."""
    ready(spark)
    return near_dups.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    ready(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; a document taken more than once is as many rows."""
    ready(spark)
    return mixing.mixture(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture; one row per document with its place, length and checksum, read back from the files."""
    ready(spark)
    folder = token_files.corpus_folder(docs)
    return token_files.token_digest(docs.select("doc_id", "text"), folder, WORD_VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_table_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
