"""From raw documents to packed training rows: five corpus operators in a row.

Each stage takes the rows its predecessor kept, as written to the shared folder and read again, so a
lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.llm import decontam, mixing, near_dedup, packing, quality
from gridcast.llm.common import remainder, shared_dir, table


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject. Labels of every fifth key stay unseen, so
    that the stage can be judged on them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels").where(remainder("doc_id") != 0))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources as even as repeating none more than one and a half times allows; no document left out."""
    return mixing.mix(docs, max_repeats=1.5)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids."""
    return packing.pack(docs)


STAGES = [("quality", good_only), ("near_dedup", one_of_each), ("decontaminate", uncontaminated),
          ("mix", mixed), ("pack", packed)]

#: A learnt classifier and random signatures have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
