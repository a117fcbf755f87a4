"""Labelled grids as long tables: one row per grid point, one column per variable."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_grid(spark: SparkSession, paths: Sequence[str], dims: Sequence[str],
              fmt: str = "parquet", **options) -> DataFrame:
    """S-06: several files as one grid; a variable absent from a file is NULL there."""
    parts = [spark.read.format(fmt).options(**options).load(p) for p in paths]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*dims, *[c for c in out.columns if c not in dims])


def write_grid(df: DataFrame, path: str, time: str | None = None, mode: str = "error") -> None:
    """S-06: parquet, in folders by year of the time dimension so that time filters skip files."""
    if time is None:
        df.write.mode(mode).parquet(path)
    else:
        (df.withColumn("year", F.year(time)).write.mode(mode).partitionBy("year").parquet(path))
