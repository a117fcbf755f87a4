"""Operator 4, sharding: a two-pass external shuffle in DataFrame operations."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def shuffle_rows(df: DataFrame, seed: int = 42, bucket_bytes: int = 64 << 20, bucket_rows: int = 8192) -> DataFrame:
    """All rows of df with `_position` long, their places 0..n-1 in a uniformly random order.

    Pass one scatters the rows into buckets by a seeded hash of the whole row; a bucket holds about
    bucket_rows rows and bucket_bytes of strings, whatever the size of df, and is written by one
    exchange. Pass two shuffles every bucket by Fisher-Yates and puts the buckets one after
    the other. Rows that repeat exactly are counted first and scattered by copy number, so that no
    bucket swells. Null columns hash like any value; an empty df gives an empty result. The same rows,
    seed and parameters give the same order, also when a task is run again.
    """
    cols = df.columns
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if t in ("string", "binary") else F.lit(0)
                 for c, t in df.dtypes), F.lit(16 * len(cols)))
    rows = (df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n"))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    buckets = max(1, -(-n // bucket_rows), -(-size // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col("_copy"), *[F.col(f"`{c}`") for c in cols])
    scattered = rows.withColumn("_key", key).withColumn("_bucket", F.pmod("_key", F.lit(buckets)))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
                       .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    record = F.struct("_key", "_copy", *[F.col(f"`{c}`") for c in cols])
    # the start of a bucket travels with its records, so that these are not shuffled again for a join
    sent = (scattered.select("_bucket", record.alias("_row")).unionByName(starts, allowMissingColumns=True)
                     .repartition(buckets, "_bucket"))
    # the sort by bucket fixes the order in which the seeded generator of a partition is used
    dealt = (sent.groupBy("_bucket").agg(F.sort_array(F.collect_list("_row")).alias("_rows"), F.max("_start").alias("_start"))
                 .sortWithinPartitions("_bucket").select("_start", F.shuffle("_rows", F.lit(seed)).alias("_rows"))
                 .select("_start", F.posexplode("_rows").alias("_at", "_row")))
    return dealt.select(*[F.col(f"_row.`{c}`").alias(c) for c in cols], (F.col("_start") + F.col("_at")).alias("_position"))


def shard(df: DataFrame, shards: int = 8, seed: int = 42, **sizes) -> DataFrame:
    """All rows of df with `shard` int and `slot` long: the shuffled rows are dealt out in turn.

    Row counts of the shards differ by one at most, slots run from 0 without a gap, and every row is
    in one shard. Columns named shard or slot are replaced.
    """
    src = df.drop("shard", "slot")
    at = F.col("_position")
    return (shuffle_rows(src, seed, **sizes).withColumns({"shard": (at % shards).cast("int"), "slot": F.floor(at / shards).cast("long")})
            .drop("_position"))


def write_shards(df: DataFrame, path: str, shards: int = 8, seed: int = 42, **sizes) -> None:
    """Write the shards as Parquet folders shard=0, shard=1, ... under path, rows within a file by slot."""
    out = shard(df, shards, seed, **sizes)
    span = F.floor(F.col("slot") / sizes.get("bucket_rows", 8192))
    (out.withColumn("_span", span).repartition("shard", "_span").sortWithinPartitions("shard", "slot").drop("_span")
        .write.partitionBy("shard").parquet(path))
