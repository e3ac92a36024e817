"""A training-data pipeline over ``documents``: host quality rules, line dedup, near-dedup, decontamination, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabstrata.llm import bpe, decontaminate, host_rules, line_dedup, near_dup
from tabstrata.session import scratch_path, ship_package, table

#: SQL can't express the near-duplicate and byte-pair stages; tests check the result against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return host_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 documents or more stay in the first of them only; documents that were nothing else go."""
    return line_dedup.dedup_documents(docs, min_docs=10, keep_first=True, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates."""
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the bytes they decode to."""
    done = bpe.round_trip(docs, bpe.default_ranks(), keep=["doc_id", "lang", "source", "n_chars"], with_ids=True)
    return done.select("row.*", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_duplicates), ("decontamination", decontamination), ("byte-level BPE", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
