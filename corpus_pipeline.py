"""The corpus pipeline: quality, near copies, benchmark leaks, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage
before it kept. All but the last return the columns of ``documents``; the last
returns doc_id with the digests of the tokens and of the decoded text. Nulls,
empty texts, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpanel.llm import bpe, decontaminate, jaccard, pii, quality, texts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level rules reject go."""
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text is encoded, and decoded again."""
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bpe", tokens),
]

#: The masks and the tokens have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = texts.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
