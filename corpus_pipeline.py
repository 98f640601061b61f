"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import bpe, decontaminate, jaccard, quality, secrets
from seqloom.llm.common import cut, table
from seqloom.llm.queries import tokenizer_path

#: The stages learn from labels and scan texts in Python; SQL can't express them.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_ids(docs, tokenizer_path(), carry=("doc_id", "lang", "source")).selectExpr("doc_id", "lang", "source", "size(token_ids) AS n_tokens", "token_ids")


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("secrets", redact_secrets), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
