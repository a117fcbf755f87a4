"""Permutation and resampling statistics (O-16, O-20, O-21).

A permutation is a keyed bijection of row numbers (see permuted_index), evaluated row by row. No
replicate sorts or windows anything, zeros stay implicit, and replicates run in slices whose
results are added up. What belongs to replicates is kept in arrays, so that those of a slice share their shuffles.
"""
from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.scale import cut_lineage, dense_index, permute
from .community import hellinger, site_contributions, species_totals


def _slices(reps: int, size: int):
    for a in range(0, reps, size):
        yield a, min(reps, a + size)


def _expand(df: DataFrame, a: int, b: int) -> DataFrame:
    return df.withColumn("rep", F.explode(F.sequence(F.lit(a), F.lit(b - 1))))


def holm(df: DataFrame, p: str = "p_value", out: str = "p_holm") -> DataFrame:
    """Step-down adjustment. Permutation p values take few distinct values, so the running maximum
    is over the distinct ones."""
    n = df.agg(F.count(p)).scalar()
    lv = df.filter(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("_c"))
    w = W.orderBy(p)
    lv = lv.withColumn("_b", F.coalesce(F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    lv = lv.withColumn("_a", F.least(F.lit(1.0), (n - F.col("_b")) * F.col(p)))
    lv = lv.select(p, F.max("_a").over(w.rowsBetween(W.unboundedPreceding, 0)).alias(out))
    return df.join(lv, p, "left").select(*df.columns, out)


def _species_keys(rep: int, j: np.ndarray, seed: int) -> np.ndarray:
    """The permutation keys of the species j in a replicate."""
    with np.errstate(over="ignore"):
        key = (np.uint64(rep + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 63)) * np.uint64(0xD6E8FEB86659FD93)) ^ (j + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (key ^ key >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)


def moved_counts(raw: DataFrame, n: int, blocks: int, first: int, last: int, seed: int, rows: int = 1 << 16) -> DataFrame:
    """(rep, block, place, kind, x): the counts of raw (_i, _j, _n; site and species numbers from 0) at the sites where the replicates
    first..last-1 send them, each species by a permutation of its own.

    A row holds many counts as arrays: those of one replicate that fall into one of `blocks` equal ranges of site numbers, from some
    `rows` rows of a task.
    """
    def run(batches):
        def deal(i, j, x):
            size = np.full(len(i), n, np.uint64)
            for rep in range(first, last):
                to = permute(i, size, _species_keys(rep, j, seed)).astype(np.int64)
                block = to * blocks // n
                order = np.argsort(block, kind="stable")
                block, to = block[order], to[order]
                cut = np.flatnonzero(np.diff(block, prepend=-1))
                parts = [np.split(v, cut[1:]) for v in (to.astype("<i8"), j[order].astype("<i4"), x[order].astype("<f8"))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cut), rep, np.int32)), pa.array(block[cut]),
                                                  *[pa.array([v.tobytes() for v in part], pa.binary()) for part in parts]], ["rep", "block", "place", "kind", "x"])

        held, size = [], 0
        for b in batches:
            held.append([b.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            size += b.num_rows
            if size >= rows:
                i, j, x = (np.concatenate(c) for c in zip(*held))
                held, size = [], 0
                yield from deal(i.astype(np.uint64), j.astype(np.uint64), x)
        if size:
            i, j, x = (np.concatenate(c) for c in zip(*held))
            yield from deal(i.astype(np.uint64), j.astype(np.uint64), x)
    return raw.select("_i", "_j", "_n").mapInArrow(run, "rep int, block long, place binary, kind binary, x binary")


def _reached(moved: DataFrame, obs: DataFrame, n: int, blocks: int) -> DataFrame:
    """(_i, _h): how often a site reaches its observed LCBD in the replicates of `moved`."""
    def shares(frame: pd.DataFrame) -> pd.DataFrame:
        place, kind, x = (np.concatenate([np.frombuffer(v, t) for v in frame[c]]) for c, t in (("place", "<i8"), ("kind", "<i4"), ("x", "<f8")))
        at, where = np.unique(place, return_inverse=True)
        y = np.sqrt(x / np.bincount(where, x)[where])
        return pd.DataFrame({"rep": frame["rep"].iloc[:1], "block": frame["block"].iloc[:1], "place": [place.tobytes()], "kind": [kind.tobytes()],
                             "y": [y.astype("<f8").tobytes()], "filled": [len(at)]})

    def by_kind(batches):
        for b in batches:
            for rep, kind, y in zip(*(c.to_pylist() for c in b.columns)):
                k, where = np.unique(np.frombuffer(kind, "<i4"), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), rep, np.int32)), pa.array(k), pa.array(np.bincount(where, np.frombuffer(y, "<f8")))], ["rep", "kind", "s"])

    def compare(batches):
        held = {}
        for b in batches:
            rows = {c: b.column(c) for c in b.schema.names}
            for r in range(b.num_rows):
                block, m2, filled = (rows[c][r].as_py() for c in ("block", "m2", "filled"))
                known = rows["known"][r].values.to_numpy(zero_copy_only=False)
                first = -(-block * n // blocks)
                value = np.full(len(known), m2)
                if rows["y"][r].is_valid:
                    place, kind, y = (np.frombuffer(rows[c][r].as_buffer(), t) for c, t in (("place", "<i8"), ("kind", "<i4"), ("y", "<f8")))
                    means = rows["means"][r].values
                    k = means.field("kind").to_numpy(zero_copy_only=False)
                    m = np.zeros(int(k.max()) + 1)
                    m[k] = means.field("m").to_numpy(zero_copy_only=False)
                    value -= 2 * np.bincount(place - first, y * m[kind], minlength=len(known))
                    value += np.bincount(place - first, minlength=len(known)) > 0
                with np.errstate(divide="ignore", invalid="ignore"):
                    hit = value / (filled - n * m2) >= known - 1e-12
                held[block] = held.get(block, 0) + hit.astype(np.int64)
                if sum(map(len, held.values())) > 1 << 22:
                    yield out(held)
        if held:
            yield out(held)

    def out(held):
        at = np.concatenate([np.arange(len(v)) + -(-k * n // blocks) for k, v in held.items()])
        got = pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate(list(held.values())))], ["_i", "_h"])
        held.clear()
        return got

    y = cut_lineage(moved.groupBy("rep", "block").applyInPandas(shares, "rep int, block long, place binary, kind binary, y binary, filled long"))
    means = (y.select("rep", "kind", "y").mapInArrow(by_kind, "rep int, kind int, s double").groupBy("rep", "kind").agg((F.sum("s") / n).alias("m"))
             .groupBy("rep").agg(F.collect_list(F.struct("kind", "m")).alias("means"), F.sum(F.col("m") * F.col("m")).alias("m2")))
    grid = (means.join(y.groupBy("rep").agg(F.sum("filled").alias("filled")), "rep")
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    known = (obs.groupBy(F.expr(f"_i * {blocks} div {n}").alias("block"))
             .agg(F.array_sort(F.collect_list(F.struct("_i", "lcbd"))).alias("k")).select("block", F.col("k.lcbd").alias("known")))
    # a block that got nothing in a replicate keeps its row: all its sites are empty there
    full = grid.join(y.drop("filled"), ["rep", "block"], "left").join(known, "block")
    return full.mapInArrow(compare, "_i long, _h long").groupBy("_i").agg(F.sum("_h").alias("_h"))


def _reached_held(raw: DataFrame, obs: DataFrame, n: int, kinds: int, reps: int, seed: int, piece: int = 1 << 18) -> DataFrame:
    """(_i, _h) as by `_reached`, over all replicates: each task holds the counts of raw and the observed LCBD (16 bytes a count) and makes whole
    replicates, so that only one copy of these for each task is moved, whatever the number of replicates."""
    spark = raw.sparkSession
    tasks = max(1, min(reps, 2 * spark.sparkContext.defaultParallelism))

    def pack(batches):
        for b in batches:
            i, j, x = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in ((i, "<i4"), (j, "<i4"), (x, "<f8"))], ["i", "j", "x"])

    def run(batches):
        task, known, parts = None, np.zeros(n), []
        for b in batches:
            for t, i, j, x in zip(*(c.to_pylist() for c in b.columns)):
                task, i, j, x = t, np.frombuffer(i, "<i4"), np.frombuffer(j, "<i4"), np.frombuffer(x, "<f8")
                if len(j) and j[0] < 0:
                    known[i] = x
                else:
                    parts.append((i, j, x))
        if task is None or not parts:
            return
        i, j, x = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        hits, to, y = np.zeros(n, np.int64), np.empty(len(i), np.int32), np.empty(len(i))
        cuts = [slice(a, a + piece) for a in range(0, len(i), piece)]
        for rep in range(task, reps, tasks):
            total, met, mean, value = np.zeros(n), np.zeros(n, bool), np.zeros(kinds), np.zeros(n)
            for c in cuts:
                to[c] = permute(i[c].astype(np.uint64), np.full(len(i[c]), n, np.uint64), _species_keys(rep, j[c].astype(np.uint64), seed))
                total += np.bincount(to[c], x[c], n)
                met[to[c]] = True
            for c in cuts:
                y[c] = np.sqrt(x[c] / total[to[c]])
                mean += np.bincount(j[c], y[c], kinds)
            mean /= n
            m2 = (mean * mean).sum()
            for c in cuts:
                value += np.bincount(to[c], y[c] * mean[j[c]], n)
            with np.errstate(divide="ignore", invalid="ignore"):
                hits += (m2 - 2 * value + met) / (met.sum() - n * m2) >= known - 1e-12
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(hits)], ["_i", "_h"])

    held = raw.select("_i", "_j", F.col("_n").cast("double")).mapInArrow(pack, "i binary, j binary, x binary").unionByName(
        obs.select(F.col("_i").cast("long"), F.lit(-1).cast("long"), "lcbd").mapInArrow(pack, "i binary, j binary, x binary"))
    dealt = held.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "i", "j", "x").repartitionById(tasks, F.col("task"))
    return dealt.mapInArrow(run, "_i long, _h long").groupBy("_i").agg(F.sum("_h").alias("_h"))


def lcbd_permutation(df: DataFrame, reps: int = 999, seed: int = 1, site: str = "site", species: str = "species",
                     number: str = "number", slice_size: int | None = None, block_rows: int = 1 << 17, held_counts: int = 1 << 24) -> DataFrame:
    """O-16: LCBD of each site with its permutation p and the Holm adjustment.

    Each replicate sends every species' counts to other sites. p = (times LCBD is reached + 1) / (reps + 1). A site that receives nothing
    in a replicate is an empty row of distances there. Up to `held_counts` counts (a site's total of a species each) are held by every task, which makes
    whole replicates, and nothing is moved for a replicate. More are dealt out: counts, transformed values and results of a replicate travel as arrays over a range of
    sites (about `block_rows` counts each), so `slice_size` replicates (as many as move some 2^33 counts, at least 50, if not given) share one
    shuffle of counts and one of species means; the means of a replicate, one number a species, are one row. Rows without a site or a species take no part; an empty table gives no rows.
    """
    raw = cut_lineage(species_totals(df.filter(F.col(site).isNotNull() & F.col(species).isNotNull()), [site], species, number))
    kept = raw.count()
    idx = cut_lineage(dense_index(raw, site, "_i"))
    if not kept:
        return idx.select(site, F.lit(None).cast("double").alias("lcbd"), F.lit(None).cast("double").alias("p_value"), F.lit(None).cast("double").alias("p_holm"))
    kinds = dense_index(raw, species, "_j")
    raw = cut_lineage(raw.join(idx, site).join(kinds, species).select(F.col("_i").cast("long").alias("_i"), F.col("_j").cast("long").alias("_j"), "_n"))
    n = idx.count()
    obs = cut_lineage(site_contributions(hellinger(raw, "_i", "_j", "_n"), [], "_i", "_j", F.lit(float(n))))
    if kept <= held_counts and slice_size is None:
        hits = cut_lineage(_reached_held(raw, obs, n, raw.agg(F.max("_j")).first()[0] + 1, reps, seed))
    else:
        blocks, hits = min(n, -(-kept // block_rows)), None
        for a, b in _slices(reps, slice_size or max(50, (1 << 33) // kept)):
            part = _reached(moved_counts(raw, n, blocks, a, b, seed), obs, n, blocks)
            hits = cut_lineage(part if hits is None else hits.unionByName(part).groupBy("_i").agg(F.sum("_h").alias("_h")))
    out = (obs.join(hits, "_i").join(idx, "_i")
              .select(site, "lcbd", ((F.col("_h") + 1) / F.lit(float(reps + 1))).alias("p_value")))
    return holm(out)


def _indval(cells: DataFrame, sizes: DataFrame, by: Sequence[str], species: str, cluster: str) -> DataFrame:
    """Indicator value per (.., species, cluster) from sums and occupancy."""
    g = cells.join(sizes, cluster)
    g = g.withColumn("_mean", F.col("_s") / F.col("_size")).withColumn("_fid", F.col("_o") / F.col("_size"))
    tot = g.groupBy(*by, species).agg(F.sum("_mean").alias("_all"))
    return g.join(tot, [*by, species]).select(
        *by, species, cluster, (F.col("_mean") / F.col("_all")).alias("specificity"), F.col("_fid").alias("fidelity"),
        F.sqrt(F.col("_mean") / F.col("_all") * F.col("_fid")).alias("indval"))


def indicator_values(df: DataFrame, site: str = "site", species: str = "species", cluster: str = "cluster",
                     number: str = "number") -> DataFrame:
    """O-20 without p: specificity, fidelity and indicator value of every (species, cluster)."""
    d = df.groupBy(site, cluster, species).agg(F.sum(number).cast("double").alias("_n"))
    sizes = df.select(site, cluster).distinct().groupBy(cluster).agg(F.count(F.lit(1)).alias("_size"))
    cells = d.groupBy(species, cluster).agg(F.sum("_n").alias("_s"), F.count_if(F.col("_n") > 0).alias("_o"))
    return _indval(cells.filter("_s > 0"), sizes, [], species, cluster)


def replicate_sums(raw: DataFrame, n: int, ends: Sequence[int], first: int, last: int, seed: int, held_mb: int = 64) -> DataFrame:
    """(species, sums, seen): for each species of raw (_i, species, _n; site numbers 0..n-1) the summed counts and the number of
    rows in each cluster under the replicates first..last-1, as vectors of replicates by clusters.

    The labels of a replicate are dealt by sending each site number to another one; clusters are consecutive ranges of these, up to `ends`. A
    task adds its rows into one vector for each species and gives these out at its end, or once they fill held_mb.
    """
    name, kind = raw.columns[1], raw.schema[1].dataType
    size = (last - first) * len(ends)
    schema = T.StructType([T.StructField(name, kind), T.StructField("sums", T.BinaryType()), T.StructField("seen", T.BinaryType())])

    def run(batches):
        with np.errstate(over="ignore"):
            keys = np.arange(first + 1, last + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 63)) * np.uint64(0xD6E8FEB86659FD93)
        place, held = np.arange(last - first) * len(ends), {}

        def out():
            got = [[k for k in held], [v[0].tobytes() for v in held.values()], [v[1].tobytes() for v in held.values()]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(got[0], to_arrow_type(kind)), pa.array(got[1], pa.binary()), pa.array(got[2], pa.binary())], schema.names)

        for b in batches:
            for i, sp, x in zip(*(c.to_pylist() for c in b.columns)):
                at = permute(np.full(len(keys), i, np.uint64), np.full(len(keys), n, np.uint64), keys)
                cell = place + np.searchsorted(ends, at.astype(np.int64), "right")
                if sp not in held:
                    if (len(held) + 1) * size * 16 > held_mb * 2 ** 20 and held:
                        yield out()
                    held[sp] = np.zeros(size), np.zeros(size, np.int64)
                s, k = held[sp]
                s[cell] += x
                k[cell] += 1
        yield out()

    dealt = raw.repartition(name, F.col("_i") % 16).sortWithinPartitions(name)
    return dealt.mapInArrow(run, schema)


def indicator_species(df: DataFrame, reps: int = 999, seed: int = 1, site: str = "site", species: str = "species",
                      cluster: str = "cluster", number: str = "number", slice_size: int = 1000) -> DataFrame:
    """O-20: best cluster of each species with its indicator value and permutation p.

    In every replicate the cluster labels are dealt to the sites anew; the value compared is the species' largest over clusters. Replicates
    are vectors: a species has one vector of sums over (replicate, cluster) in each task, these are added up in one shuffle for
    `slice_size` replicates, and its p needs nothing else.
    """
    d = df.groupBy(site, cluster, species).agg(F.sum(number).cast("double").alias("_n")).filter("_n > 0")
    labels = df.select(site, cluster).distinct()
    idx = cut_lineage(dense_index(labels, site, "_i").join(labels, site))
    sizes = sorted(((r[0], r[1]) for r in labels.groupBy(cluster).count().collect()), key=lambda r: (r[0] is not None, r[0]))
    ends = np.cumsum([k for _, k in sizes])
    best = (indicator_values(df, site, species, cluster, number).groupBy(species)
            .agg(F.max(F.struct("indval", F.col(cluster).alias("c"))).alias("b"))
            .select(species, F.col("b.c").alias(cluster), F.col("b.indval").alias("indval")))
    best = cut_lineage(best)
    raw = cut_lineage(d.join(idx.select(site, "_i"), site).select("_i", species, "_n"))
    n = int(ends[-1]) if len(ends) else 0
    each = np.diff(np.append(0, ends)).astype(float)

    def reached(frame: pd.DataFrame) -> pd.DataFrame:
        s, o = (sum(np.frombuffer(v, t) for v in frame[c]).reshape(-1, len(each)) for c, t in (("sums", "<f8"), ("seen", "<i8")))
        mean = s / each
        value = np.sqrt(mean / mean.sum(1, keepdims=True) * (o / each)).max(1)
        return pd.DataFrame({species: frame[species].iloc[:1], "_h": [int((value >= frame["indval"].iloc[0] - 1e-12).sum())]})

    hits = best.select(species, F.lit(0).cast("long").alias("_h"))
    kind = T.StructType([best.schema[species], T.StructField("_h", T.LongType())])
    for a, b in _slices(reps, slice_size):
        got = (replicate_sums(raw, n, ends, a, b, seed).join(best.select(species, "indval"), species)
               .groupBy(species).applyInPandas(reached, kind))
        hits = cut_lineage(hits.unionByName(got).groupBy(species).agg(F.sum("_h").alias("_h")))
    return best.join(hits, species).select(species, cluster, "indval",
                                           ((F.col("_h") + 1) / F.lit(float(reps + 1))).alias("p_value"))


def geometric_mean_uncertainty(df: DataFrame, reps: int = 10000, seed: int = 1, region: str = "region",
                               category: str = "category", period: str = "period", mean: str = "mean",
                               half_width: str = "half_width", reference=None, region_rows: int = 1 << 14) -> tuple[DataFrame, DataFrame]:
    """O-21: (per region, overall) ratio of geometric means to the reference period: mean, sd and
    the 2.5 and 97.5 % points over lognormal replicates with the given means and half-widths.

    The reference period is drawn twice (independent draws), so its own ratio shows the noise. The
    draws of a row depend only on its keys, so a lost task repeats the same numbers. Replicates are vectors of `reps` numbers that stay
    in the task that draws them: a region of up to `region_rows` rows is drawn in one task, which gives its statistics and adds its ratios to the task's
    sums over regions. A larger region is dealt over tasks, and its vectors are added in two shuffles. Rows whose mean is not above 0 or whose half-width is missing take no
    part; a region without its reference period has no ratio.
    """
    m, h = F.col(mean).cast("double"), F.col(half_width).cast("double")
    sig = F.sqrt(F.ln(F.pow(h / F.lit(1.959963984540054) / F.nullif(m, F.lit(0.0)), 2) + 1))
    ref = reference if reference is not None else df.agg(F.min(period)).scalar()
    d = df.select(F.col(region).alias("_r"), F.col(period).alias("_p"), F.xxhash64(F.lit(seed), region, category, period).alias("_k"),
                  F.when(m > 0, F.ln(m) - sig * sig / 2).alias("_mu"), sig.alias("_sg"), F.coalesce(F.col(period) == ref, F.lit(False)).alias("_ref"))
    d = d.filter(F.col("_mu").isNotNull() & F.col("_sg").isNotNull())
    d = d.withColumn("_own", F.explode(F.when(F.col("_ref"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))

    def draws(k, mu, sg):
        return mu + sg * np.random.Generator(np.random.Philox(key=k % (1 << 64))).standard_normal(reps)

    d = cut_lineage(d.select("_r", "_p", "_own", F.xxhash64("_k", "_own").alias("_k"), "_mu", "_sg"))
    large = cut_lineage(d.groupBy("_r").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > region_rows).select(F.col("_r").alias("_b")))
    wide = not large.isEmpty()
    same = F.col("_r").eqNullSafe(F.col("_b"))
    spark = d.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = (d.join(large, same, "left_anti") if wide else d).repartition(tasks, "_r").sortWithinPartitions("_r", "_own", "_p", "_k")
    names = ["ratio_mean", "ratio_sd", "q025", "q975"]
    of_region, of_period = [[d.schema[c] for c in cols] for cols in (("_r", "_p"), ("_p",))]

    def ratios(batches):
        """(region, period, logs of the ratios); a region's second draw of the reference period comes first."""
        at, total, n, base = None, 0, 0, (None, None)
        for row in chain(rows(batches), [None]):
            key = None if row is None else row[:3]
            if n and key != at:
                if not at[1]:
                    base = at[0], total / n
                elif base[1] is not None and base[0] == at[0]:
                    yield at[0], at[2], total / n - base[1]
                total, n = 0, 0
            if row is not None:
                at, total, n = key, total + draws(*row[3:]), n + 1

    def rows(batches):
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("_r", "_own", "_p", "_k", "_mu", "_sg")))

    def summary(logs):
        r = np.exp(logs)
        return [r.mean(), r.std(ddof=1) if len(r) > 1 else None, *np.quantile(r, [.025, .975])]

    def arrow(got, schema):
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], to_arrow_type(f.dataType)) for i, f in enumerate(schema.fields)], schema.names)

    stat_fields = [T.StructField(c, T.DoubleType()) for c in names]
    by_schema, sum_schema = T.StructType([*of_region, *stat_fields]), T.StructType([*of_period, T.StructField("v", T.BinaryType()), T.StructField("n", T.LongType())])

    def region_stats(batches):
        got = []
        for r, p, logs in ratios(batches):
            got.append([r, p, *summary(logs)])
            if len(got) >= 1024:
                yield arrow(got, by_schema)
                got.clear()
        yield arrow(got, by_schema)

    def period_sums(batches):
        sums = {}

        def out():
            for p, (v, n) in sums.items():
                yield arrow([[p, v.tobytes(), n]], sum_schema)
            sums.clear()

        for _, p, logs in ratios(batches):
            v, n = sums.get(p, (0, 0))
            sums[p] = v + logs, n + 1
            if len(sums) * reps * 8 > 64 * 2 ** 20:
                yield from out()
        yield from out()

    by_region, sums = held.mapInArrow(region_stats, by_schema), held.mapInArrow(period_sums, sum_schema)
    if wide:
        dealt = d.join(large, same, "left_semi").repartition(tasks, "_r", F.pmod("_k", F.lit(16))).sortWithinPartitions("_r", "_p", "_own", "_k")
        logs = cut_lineage(_added(_vector_sums(dealt.select("_r", "_p", "_own", "_k", "_mu", "_sg"), 3, draws), ["_r", "_p", "_own"]))
        base = logs.filter("NOT _own").select(F.col("_r").alias("_b"), F.col("v").alias("_base"))
        ratio = logs.filter("_own").join(base, same).select("_r", "_p", "v", "_base")
        diff = lambda v, b: np.frombuffer(v, "<f8") - np.frombuffer(b, "<f8")
        by_region = by_region.unionByName(_ratio_stats(ratio, 2, lambda v, b: summary(diff(v, b)), by_schema))
        sums = sums.unionByName(_vector_sums(ratio.select("_p", "v", "_base").repartition("_p", F.pmod(F.xxhash64("v"), F.lit(16))).sortWithinPartitions("_p"), 1, diff))
    overall = _ratio_stats(_added(sums, ["_p"]), 1, lambda v: summary(np.frombuffer(v, "<f8")), T.StructType([*of_period, *stat_fields]))
    return by_region.withColumnsRenamed({"_r": region, "_p": period}), overall.withColumnRenamed("_p", period)


def _ratio_stats(df: DataFrame, keys: int, value, schema: T.StructType) -> DataFrame:
    """The first columns, the keys, and the statistics that `value` makes of the others."""
    def run(batches):
        for b in batches:
            got = [value(*row) for row in zip(*(c.to_pylist() for c in b.columns[keys:]))]
            yield pa.RecordBatch.from_arrays([*b.columns[:keys], *[pa.array([g[i] for g in got], pa.float64()) for i in range(4)]], schema.names)
    return df.mapInArrow(run, schema)


def _vector_sums(df: DataFrame, keys: int, vector) -> DataFrame:
    """(keys, v, n): sums of the vectors of rows that follow one another with equal keys (the first columns), and their number; `vector` makes that of a
    row from the other columns."""
    fields = df.schema.fields[:keys]
    schema = T.StructType([*fields, T.StructField("v", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches):
        at, total, n, out = None, 0, 0, []

        def batch():
            cols = [pa.array([o[i] for o in out], to_arrow_type(f.dataType)) for i, f in enumerate(schema.fields)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, schema.names)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if n and row[:keys] != at:
                    out.append((*at, total.tobytes(), n))
                    total, n = 0, 0
                    if len(out) >= 64:
                        yield batch()
                at, total, n = row[:keys], total + vector(*row[keys:]), n + 1
        if n:
            out.append((*at, total.tobytes(), n))
        yield batch()
    return df.mapInArrow(run, schema)


def _added(vectors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, v): mean vectors by keys; few rows of a key come in, at most one or a few of a task."""
    schema = T.StructType([*[vectors.schema[k] for k in keys], T.StructField("v", T.BinaryType())])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        v = sum(np.frombuffer(x, "<f8") for x in frame["v"]) / frame["n"].sum()
        return pd.DataFrame({**{k: frame[k].iloc[:1] for k in keys}, "v": [v.tobytes()]})
    return vectors.groupBy(*keys).applyInPandas(add, schema)
