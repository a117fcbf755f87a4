"""A training corpus from `documents`: each stage works on all that the one before kept."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from biolattice.llm import lines, mixing, packing, quality, simhash
from biolattice.llm.common import table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on `labels`, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line, lines of one or two words included."""
    return lines.dedup_lines(docs, least_words=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pack(docs, added=True)


STAGES = [("quality_filter", quality_filter), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources),
          ("pack_sequences", pack_sequences)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written as Parquet and read again, in a new folder
    beside the checkpoints."""
    from biolattice.plans.views import scratch

    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
