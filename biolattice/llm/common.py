"""Small helpers shared by the operators of this folder."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scale import cut_lineage

__all__ = ["cut_lineage", "table", "fold", "text_or_empty", "count_words", "clean_names", "components", "released"]

#: White space of the contracts: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(df: DataFrame) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, a function for mapInArrow, after whose last batch the worker gives the memory that the task has freed back to the system: it
    lives on for other tasks, beside the executor's own memory."""
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
        if trim:
            trim(0)
    return task


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % 5


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node that has an edge; root is
    the smallest node reachable.

    Alternates the two star contractions: neighbours of a node are hung onto its smallest one. A step
    is one grouped minimum and one join, so no neighbourhood is gathered; the number of steps grows with
    the logarithm of the longest chain. Every step is checkpointed.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        if large:
            out = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            down = both.filter("b < a").join(low, "a")
            out = down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    last = mark(e)
    while last[0]:
        e = cut_lineage(star(star(e, True), False))
        now = mark(e)
        if now == last:
            break
        last = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
