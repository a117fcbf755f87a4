"""Detections as an event stream (X-01 .. X-03).

Each function takes a streaming or a batch table and gives the same rows for the same input, as
long as nothing arrives later than the watermark.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_detections(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                    files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def _marked(df: DataFrame, time: str, delay: str) -> DataFrame:
    return df.withWatermark(time, delay) if df.isStreaming else df


def tidy_live(df: DataFrame, file: str = "file", taxon: str = "taxon", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """X-01: one record per (file, taxon), `empty` records all kept; state lives for `delay` only."""
    d = _marked(df, time, delay)
    blank = F.col(taxon) == "empty"
    named = d.filter(~blank)
    named = named.dropDuplicatesWithinWatermark([file, taxon]) if df.isStreaming else named.dropDuplicates([file, taxon])
    return named.unionByName(d.filter(blank))


def hourly_contacts(df: DataFrame, species: str = "species", time: str = "ts", delay: str = "1 hour",
                    width: str = "1 hour") -> DataFrame:
    """X-02: contacts per species and hour; rows later than the watermark are dropped."""
    w = F.window(time, width)
    return (_marked(df, time, delay).groupBy(w, species).agg(F.count(F.lit(1)).alias("contacts"))
            .select(F.col("window.start").alias("hour_start"), species, "contacts"))


def detection_sessions(df: DataFrame, by: str = "file", time: str = "ts", gap: str = "30 minutes",
                       delay: str = "1 hour") -> DataFrame:
    """X-03: runs of detections without a gap, per source."""
    return (_marked(df, time, delay).groupBy(F.session_window(time, gap).alias("w"), by)
            .agg(F.count(F.lit(1)).alias("detections"))
            .select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "detections"))
