"""A corpus pipeline: classify, deduplicate, mix, encode. Each stage is written as Parquet and
read again as the next one's documents; all but the last keep the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, mixing, quality, simhash
from quire.llm.common import fresh_path, passing, remove, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id."""
    return simhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of every row."""
    return bpe.encoded(docs)


STAGES = [
    ("quality_classifier", classify),
    ("simhash_dedup", deduplicate),
    ("mix_sources", mix),
    ("bpe_encode", encode),
]

#: Classifier, SimHash groups and BPE are not expressible in SQL; tests/llm holds run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with passing():
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.schema(out.schema).parquet(path), path
    return docs
