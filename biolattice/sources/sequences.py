"""Sequence files as rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """S-07: one row per record, the sequence joined over its lines.

    A record begins at a `>` that begins a line; a `>` elsewhere belongs to the name or sequence it stands in.
    """
    rec = spark.read.option("lineSep", "\n>").text(path).filter(F.trim("value") != "")
    rec = rec.withColumn("value", F.regexp_replace("value", r"^\s*>", ""))  # the mark of a file's first record
    lines = F.split("value", "\r?\n")
    return rec.select(F.trim(lines[0]).alias("name"),
                      F.regexp_replace(F.array_join(F.slice(lines, 2, F.size(lines)), ""), r"\s", "")
                      .alias("seq"))


def fasta_lines(df: DataFrame, name: str = "name", seq: str = "seq") -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value"))


def write_fasta(df: DataFrame, path: str, name: str = "name", seq: str = "seq",
                mode: str = "error") -> None:
    """S-07: a header and a sequence line per row."""
    fasta_lines(df, name, seq).write.mode(mode).text(path)
