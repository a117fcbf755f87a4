"""Building blocks that stay whole and balanced when one key holds much of the data.

* a first row per key is a partial aggregate, never a window over the key;
* ranks and quantiles split a group into ordered buckets, so that the sort of a hot group
  is shared by many tasks and only bucket counts meet in one place;
* nearest-marked lookups do the same and carry only bucket edges across buckets;
* permutations are row-wise bijections of a dense index, so nothing is sorted at all.
"""
from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .scalars import as_col


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint df in the shared folder that the session names in spark.checkpoint.dir."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="ckpt-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed frame that nothing reads any more, such as the state of the last round."""
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return
    at = plan.rdd().getCheckpointFile()
    if at.isDefined():
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(at.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  last: bool = False) -> DataFrame:
    """Row with the smallest (last=True: largest) order per key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return (df.groupBy(*keys)
              .agg(pick(F.struct(*rest), F.struct(*[as_col(o).alias(f"_o{i}")
                                                    for i, o in enumerate(order)])).alias("_r"))
              .select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in rest])
              .select(*df.columns))


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys, as they do in a grouping; the key columns of left stay."""
    r = right.select(*[F.col(f"`{c}`").alias(f"_of_{c}" if c in keys else c) for c in right.columns])
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in keys]
    return left.join(r, on, how).drop(*[f"_of_{c}" for c in keys])


def join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 16, nulls: bool = False) -> DataFrame:
    """big joined to a table with few rows for each key, such as an aggregate of big itself; keys may be empty.

    A key may hold most of big: its rows are dealt over salts by their hash and the partition they come from, so that equal rows are
    dealt out too and a task that is run again deals alike; small is repeated for each salt, so that no task gets a whole key. Spark
    still broadcasts small where it is small enough. With nulls, NULL keys meet NULL keys.
    """
    hashed = [F.col(f"`{c}`") for c, t in big.dtypes if "map<" not in t]
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = join_keys(b, s, [*keys, "_salt"], how) if nulls else b.join(s, [*keys, "_salt"], how)
    return joined.drop("_salt")


def range_buckets(df: DataFrame, by: Sequence[str], value: str, name: str = "_b", parts: int = 128) -> DataFrame:
    """df with an int column that never decreases in value within a group and cuts every group into up to
    `parts` ranges of about equal numbers of rows, whatever the values' scale or outliers.

    Range edges are quantile sketches, combined before the shuffle; equal values share a bucket.
    """
    v = F.col(value).cast("double")
    at = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    edges = df.groupBy(*by).agg(F.percentile_approx(v, at, F.lit(2000)).alias("_edges"))
    out = join_small(df, edges, by, "left", nulls=True)
    return out.withColumn(name, F.coalesce(F.size(F.filter("_edges", lambda e: e < v)), F.lit(0))).drop("_edges").select(*df.columns, name)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
                    ) -> DataFrame:
    """Exact interpolated quantiles (the usual (n-1)p rule) per group.

    Equal values are counted before the shuffle, groups are cut into ranges of equal numbers of values, and
    only the ranges that hold a wanted rank are sorted.
    """
    counts = _value_counts(df, by, value)
    return _quantiles_of(counts.filter("_v IS NOT NULL"), by, probs)


def _value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by or _all, _v, _n): how often each value stands in a group; NaN counts as NULL."""
    keys = list(by) or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    return src.groupBy(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def describe_exact(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """by, n (rows), n_value, mean, sd, min, max and exact quantiles, all from one count of values: df is read once."""
    by = list(by)
    keys = by or ["_all"]
    counts = _value_counts(df, by, value)
    v, n = F.col("_v"), F.col("_n")
    held = F.sum(F.when(v.isNotNull(), n))
    base = counts.groupBy(*keys).agg(F.sum(n).alias("n"), F.coalesce(held, F.lit(0)).alias("n_value"), (F.sum(n * v) / held).alias("mean"),
                                     F.min(v).alias("min"), F.max(v).alias("max"))
    known = counts.filter("_v IS NOT NULL")
    # squares around the mean, so that values far from zero keep their digits
    ss = join_small(known, base.select(*keys, "mean", "n_value"), keys, nulls=True).groupBy(*keys).agg(
        F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.col("mean"), 2)), F.max("n_value") - 1)).alias("sd"))
    out = join_keys(base, ss, keys, "left")
    q = _quantiles_of(known, by, probs)
    out = join_keys(out, q if by else q.withColumn("_all", F.lit(1)), keys, "left")
    return out.select(*by, "n", "n_value", "mean", "sd", "min", "max", *probs)


def middle_values(df: DataFrame, by: Sequence[str], value: str, low: str = "low", high: str = "high") -> DataFrame:
    """The two middle values per group, equal for an odd number of values: the median of any column that is monotone in value follows."""
    return _quantiles_of(_value_counts(df, by, value).filter("_v IS NOT NULL"), by, {"_m": .5}, pair=(low, high))


def _quantiles_of(counts: DataFrame, by: Sequence[str], probs: dict[str, float], pair: tuple[str, str] | None = None) -> DataFrame:
    by = list(by)
    keys = by or ["_all"]
    counts = range_buckets(counts, keys, "_v")
    w = W.partitionBy(*keys).orderBy("_b")
    ps = list(probs.items())
    edges = (counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
             .withColumn("_hi", F.sum("_bn").over(w.rowsBetween(W.unboundedPreceding, 0)))
             .withColumn("_tot", F.sum("_bn").over(W.partitionBy(*keys)))
             .withColumn("_lo", F.col("_hi") - F.col("_bn")))
    hit = F.lit(False)
    for _, p in ps:
        k = F.floor((F.col("_tot") - 1) * F.lit(float(p)))
        hit = hit | ((k + 1 >= F.col("_lo")) & (k < F.col("_hi")))
    edges = edges.filter(hit).select(*keys, "_b", "_lo", "_tot")
    wv = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = (join_keys(counts, edges, [*keys, "_b"])
              .withColumn("_end", F.col("_lo") + F.sum("_n").over(wv))
              .withColumn("_start", F.col("_end") - F.col("_n")))
    aggs = []
    for i, (_, p) in enumerate(ps):
        k = F.floor((F.col("_tot") - 1) * F.lit(float(p)))
        for side, pos in (("a", k), ("z", F.least(k + 1, F.col("_tot") - 1))):
            aggs.append(F.max(F.when((F.col("_start") <= pos) & (pos < F.col("_end")),
                                     F.col("_v"))).alias(f"_{side}{i}"))
    out = ranked.groupBy(*keys).agg(F.max("_tot").alias("_tot"), *aggs)
    cols = []
    if pair:
        h = (F.col("_tot") - 1) * F.lit(float(ps[0][1]))
        return out.select(*by, F.col("_a0").alias(pair[0]), F.when(h == F.floor(h), F.col("_a0")).otherwise(F.col("_z0")).alias(pair[1]))
    for i, (name, p) in enumerate(ps):
        h = (F.col("_tot") - 1) * F.lit(float(p))
        cols.append((F.col(f"_a{i}") + (h - F.floor(h)) * (F.col(f"_z{i}") - F.col(f"_a{i}"))
                     ).alias(name))
    return out.select(*by, *cols)


def exact_quantiles_many(df: DataFrame, by: Sequence[str], values: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """exact_quantiles of several columns in one pass; result columns are value_name."""
    by = list(by)
    rows = F.array(*[F.struct(F.lit(v).alias("_col"), F.col(v).cast("double").alias("_val")) for v in values])
    q = exact_quantiles(df.select(*by, F.inline(rows)), [*by, "_col"], "_val", probs)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("_col") == v, F.col(n))).alias(f"{v}_{n}") for v in values for n in probs])


def ordered_index(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
                  bucket: Column, name: str = "idx") -> DataFrame:
    """0-based rank within by; bucket must not decrease along the order."""
    by = list(by)
    d = df.withColumn("_b", bucket)
    head = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = (d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_bn"))
               .withColumn("_base", F.coalesce(F.sum("_bn").over(head), F.lit(0)))
               .select(*by, "_b", "_base"))
    local = W.partitionBy(*by, "_b").orderBy(*[as_col(o) for o in order])
    return (join_keys(d.withColumn("_rn", F.row_number().over(local)), starts, [*by, "_b"])
             .withColumn(name, (F.col("_base") + F.col("_rn") - 1).cast("long"))
             .select(*df.columns, name))


def value_index(df: DataFrame, by: Sequence[str], value: str, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """0-based rank within by in the given order, which starts with the numeric column `value`."""
    return ordered_index(range_buckets(df, by, value, "_range"), by, order, F.col("_range"), name).drop("_range")


def dense_index(df: DataFrame, key: str, name: str = "idx", buckets: int = 4096) -> DataFrame:
    """Distinct keys numbered 0..n-1 in hash order; the same keys always get the same numbers."""
    return ordered_index(df.select(key).distinct(), [], [key],
                         F.pmod(F.xxhash64(key), F.lit(buckets)), name)


def nearest_marked(df: DataFrame, by: Sequence[str], order: str, marked: str,
                   carry: Sequence[str], prefix: str = "near_", buckets: int = 128) -> DataFrame:
    """For each row the carried columns of the marked row of its group nearest in `order`.

    At equal distance the later marked row wins; among marked rows at one point the last in
    carry order does. Rows of groups without a marked row get NULL. Equal points are handled
    once, and a group is cut into ordered buckets whose first and last marked points alone
    travel across buckets.
    """
    by = list(by)
    keys = by or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    o = F.col(order).cast("double")
    src = src.withColumn("_o", o)
    near = F.struct(F.col("_o").alias("_p"), *[F.col(c) for c in carry])
    pts = (src.groupBy(*keys, "_o")
              .agg(F.max(F.when(F.col(marked), near)).alias("_m")))
    pts = range_buckets(pts, keys, "_o", parts=buckets)
    wb = W.partitionBy(*keys).orderBy("_b")
    edge = (pts.groupBy(*keys, "_b").agg(F.max("_m").alias("_l"), F.min("_m").alias("_f"))
               .withColumn("_before", F.last("_l", True).over(wb.rowsBetween(W.unboundedPreceding, -1)))
               .withColumn("_after", F.last("_f", True).over(W.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(W.unboundedPreceding, -1)))
               .select(*keys, "_b", "_before", "_after"))
    wp = W.partitionBy(*keys, "_b").orderBy("_o")
    pts = pts.withColumn("_lo", F.last("_m", True).over(wp.rowsBetween(W.unboundedPreceding, 0)))
    # the marked row behind is the last one of the turned order: a frame that ends at the bucket's end is summed anew for every row
    wr = W.partitionBy(*keys, "_b").orderBy(F.desc("_o")).rowsBetween(W.unboundedPreceding, 0)
    pts = (join_keys(pts.withColumn("_hi", F.last("_m", True).over(wr)), edge, [*keys, "_b"])
              .withColumn("_lo", F.coalesce("_lo", "_before"))
              .withColumn("_hi", F.coalesce("_hi", "_after")))
    take_hi = F.col("_lo").isNull() | (F.col("_hi._p") - F.col("_o") <= F.col("_o") - F.col("_lo._p"))
    pts = (pts.withColumn("_n", F.when(F.col("_hi").isNotNull() & take_hi, F.col("_hi"))
                          .otherwise(F.col("_lo")))
              .select(*keys, "_o", F.col("_n._p").alias(f"{prefix}{order}"),
                      *[F.col(f"_n.{c}").alias(f"{prefix}{c}") for c in carry]))
    return (join_keys(src, pts, [*keys, "_o"], "left")
               .select(*df.columns, f"{prefix}{order}", *[f"{prefix}{c}" for c in carry]))


def permute(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the indexes i (0..n-1) under the permutations chosen by the keys, all as unsigned 64-bit arrays of one length."""
    x, size, k = i, n, key
    a = np.ceil(np.sqrt(size.astype(np.float64))).astype(np.uint64)
    a = np.maximum(a, np.uint64(1))
    b = (size + a - np.uint64(1)) // a

    def mix(h):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))

    def once(v, sel):
        aa, bb, kk = a[sel], b[sel], k[sel]
        hi, lo = v // bb, v % bb
        for r in range(8):
            salt = kk + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            if r % 2 == 0:
                lo = (lo + mix(hi + salt) % bb) % bb
            else:
                hi = (hi + mix(lo + salt) % aa) % aa
        return hi * bb + lo

    with np.errstate(over="ignore"):
        todo = np.arange(len(x))
        out = x.copy()
        while len(todo):
            out[todo] = once(out[todo], todo)
            todo = todo[out[todo] >= size[todo]]
    return out


def permute_by(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """permute() of many indexes under one permutation: divisors are numbers, which numpy divides by several times faster."""
    one = lambda v: np.array([v], np.uint64)[0]
    a = one(max(1, int(np.ceil(np.sqrt(float(n))))))
    b = one((n + int(a) - 1) // int(a))
    salts = [one((key + (r + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) for r in range(8)]
    rest = lambda v, d: v - v // d * d

    def mix(h):
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
        return h

    def once(v):
        hi = v // b
        lo = v - hi * b
        for r in range(8):
            if r % 2 == 0:
                lo = rest(lo + rest(mix(hi + salts[r]), b), b)
            else:
                hi = rest(hi + rest(mix(lo + salts[r]), a), a)
        return hi * b + lo

    with np.errstate(over="ignore"):
        out = np.concatenate([once(i[k:k + (1 << 15)]) for k in range(0, max(1, len(i)), 1 << 15)])
        todo = np.flatnonzero(out >= one(n))
        while len(todo):
            out[todo] = once(out[todo])
            todo = todo[out[todo] >= one(n)]
    return out


def unpermute_by(to: np.ndarray, n: int, key: int) -> np.ndarray:
    """The indexes that permute_by() sends to the places `to`. What a round adds depends on a row or a column of the rectangle alone, so it is
    looked up in a table of some sqrt(n) numbers."""
    a = max(1, int(np.ceil(np.sqrt(float(n)))))
    b = (n + a - 1) // a
    tables = []
    with np.errstate(over="ignore"):
        for r in range(8):
            size, rest = ((a, b), (b, a))[r % 2]
            h = np.arange(size, dtype=np.uint64) + np.array([(key + (r + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], np.uint64)
            for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                h = (h ^ h >> np.uint64(33)) * np.uint64(factor)
            tables.append(rest - ((h ^ h >> np.uint64(33)) % np.uint64(rest)).astype(np.int64))

    def once(v):
        hi = v // b
        lo = v - hi * b
        # a sum below twice the size, brought into it: what is too small wraps round to a large number
        for r in range(7, -1, -1):
            if r % 2 == 0:
                lo += tables[r][hi]
                np.minimum(lo.view(np.uint64), (lo - b).view(np.uint64), out=lo.view(np.uint64))
            else:
                hi += tables[r][lo]
                np.minimum(hi.view(np.uint64), (hi - a).view(np.uint64), out=hi.view(np.uint64))
        hi *= b
        hi += lo
        return hi

    out = np.empty(len(to), np.int64)
    for k in range(0, len(to), 1 << 14):
        out[k:k + (1 << 14)] = once(to[k:k + (1 << 14)].astype(np.int64))
    todo = np.flatnonzero(out >= n)
    while len(todo):
        out[todo] = once(out[todo])
        todo = todo[out[todo] >= n]
    return out


@F.pandas_udf(T.LongType())
def _permute(i: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(i.to_numpy(dtype=np.uint64), n.to_numpy(dtype=np.uint64), key.to_numpy(dtype=np.int64).view(np.uint64)).astype(np.int64))


def permuted_index(i, n, *key) -> Column:
    """Place of index i (0..n-1) under the pseudo-random permutation chosen by key.

    A keyed round function over a rectangle just covering 0..n-1, repeated until the result
    falls inside, is a bijection: every key gives one permutation and no rows meet.
    """
    return _permute(as_col(i).cast("long"), as_col(n).cast("long"),
                    F.xxhash64(*[as_col(c) for c in key]))


def previous_row(df: DataFrame, by: Sequence[str], order: str, carry: Sequence[str],
                 prefix: str = "prev_", buckets: int = 128) -> DataFrame:
    """The carried columns of the row before each row of its group, across bucket edges."""
    by = list(by)
    keys = by or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    src = src.withColumn("_o", F.col(order).cast("double"))
    d = range_buckets(src, keys, "_o", parts=buckets).withColumn("_s", F.struct("_o", *carry))
    wb = W.partitionBy(*keys).orderBy("_b")
    edge = (d.groupBy(*keys, "_b").agg(F.max("_s").alias("_l"))
             .withColumn("_before", F.lag("_l").over(wb)).select(*keys, "_b", "_before"))
    w = W.partitionBy(*keys, "_b").orderBy("_s")
    d = (join_keys(d.withColumn("_p", F.lag("_s").over(w)), edge, [*keys, "_b"])
          .withColumn("_p", F.coalesce("_p", "_before")))
    return d.select(*df.columns, *[F.col(f"_p.{c}").alias(f"{prefix}{c}") for c in carry])
