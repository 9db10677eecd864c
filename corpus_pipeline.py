"""From raw documents to packed sequences: quality, near duplicates, secrets, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugelake.llm import host_quality, mixing, ngram_join, packing, secrets
from gaugelake.llm.encoding import public_path
from gaugelake.llm.shared import Scratch, documents
from gaugelake.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or whose host is rejected go."""
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8 or more) stays: the one with the smallest id."""
    ship_package(spark)
    return ngram_join.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    ship_package(spark)
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: some go, some come twice."""
    ship_package(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, public_path(packing.TOKENIZER), forget=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixture", mixture),
    ("packing", packed),
]

#: The n-gram join, the secret scan, the sampling and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
