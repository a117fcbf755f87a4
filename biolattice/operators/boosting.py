"""Boosted trees of presence on environment for many species at once (M-05).

Features are cut into quantile bins and rows with the same bins merge into cells with counts, so a fit reads a bounded table
whatever the number of rows. A tree has two splits, hence at most two features: all trees of a model add up to one table of bins by bins for
each pair of features, and a prediction is a sum of lookups however many trees there are.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scale import cut_lineage

STEP = 50  # trees between two looks at the held-out deviance


def deviance(y: np.ndarray, n: np.ndarray, p: np.ndarray) -> float:
    """Bernoulli deviance a row of cells with n rows, y of them 1."""
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return float(-2 * np.sum(y * np.log(p) + (n - y) * np.log1p(-p)) / max(n.sum(), 1))


def area_under_curve(y: np.ndarray, n: np.ndarray, score: np.ndarray) -> float:
    """Share of (1, 0) pairs of rows that the score orders rightly, ties half."""
    of = np.unique(score, return_inverse=True)[1]
    pos, neg = np.bincount(of, y), np.bincount(of, n - y)
    total = pos.sum() * neg.sum()
    return float(np.sum(pos * (np.cumsum(neg) - neg / 2)) / total) if total else float("nan")


class Boosting:
    """Gradient boosting of 0/1 rows in cells: bins (cells x features), rows n and ones y of each cell.

    Every tree splits at the best place twice (least squares on the residuals, at least `least` rows in a leaf); a leaf adds rate times
    sum(residuals) / sum(p (1 - p)). With bag < 1 each tree sees that share of the rows, drawn from a seeded generator.
    """

    def __init__(self, bins: np.ndarray, n: np.ndarray, y: np.ndarray, width: int, rate: float, bag: float = 1.0, least: int = 10, seed: int = 0):
        self.bins, self.n, self.y, self.width, self.rate, self.bag, self.least = bins, n.astype(float), y.astype(float), width, rate, bag, least
        self.p = bins.shape[1]
        self.at = (bins + np.arange(self.p) * width).ravel()
        self.random, self.trees = np.random.default_rng(seed), 0
        mean = min(max(self.y.sum() / max(self.n.sum(), 1), 1e-6), 1 - 1e-6)
        self.start = math.log(mean / (1 - mean))
        self.score = np.full(len(n), self.start)
        self.tables: dict[tuple[int, int], np.ndarray] = {}

    def sums(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, np.repeat(w, self.p), self.p * self.width).reshape(self.p, self.width)

    def best(self, w: np.ndarray, z: np.ndarray) -> tuple[float, int, int]:
        """Gain, feature and last bin on the left of the best split, from the rows and residuals of each bin."""
        lw, lz = np.cumsum(w, 1), np.cumsum(z, 1)
        rw, rz = lw[:, -1:] - lw, lz[:, -1:] - lz
        good = (lw >= self.least) & (rw >= self.least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(good, lw * rw / (lw + rw) * (lz / lw - rz / rw) ** 2, 0.0)
        k = int(np.argmax(gain))
        return float(gain.flat[k]), k // self.width, k % self.width

    def grow(self) -> None:
        p = 1 / (1 + np.exp(-self.score))
        n, y = self.n, self.y
        if self.bag < 1:
            y = self.random.binomial(self.y.astype(np.int64), self.bag).astype(float)
            n = y + self.random.binomial((self.n - self.y).astype(np.int64), self.bag)
        z, h = y - n * p, n * p * (1 - p)
        w, g = self.sums(n), self.sums(z)
        gain, f, cut = self.best(w, g)
        self.trees += 1
        if gain <= 0:
            return
        left = self.bins[:, f] <= cut
        wl, gl = self.sums(np.where(left, n, 0)), self.sums(np.where(left, z, 0))
        one, two = self.best(wl, gl), self.best(w - wl, g - gl)
        side, (gain2, f2, cut2) = (left, one) if one[0] >= two[0] else (~left, two)
        first = np.arange(self.width) <= cut
        leaf = left.astype(np.int64)
        if gain2 > 0:
            leaf = np.where(side, np.where(self.bins[:, f2] <= cut2, 3, 2), leaf)
        top, low = np.bincount(leaf, z, 4), np.bincount(leaf, h, 4)
        value = self.rate * np.divide(top, low, out=np.zeros(4), where=low > 0)
        self.score += value[leaf]
        if gain2 > 0:
            inner = np.where(np.arange(self.width) <= cut2, value[3], value[2])
            split = first if one[0] >= two[0] else ~first
            table = np.where(split[:, None], inner[None, :], value[0] if one[0] >= two[0] else value[1])
        else:
            f2, table = f, np.repeat(np.where(first, value[1], value[0])[:, None], self.width, 1)
        if f2 < f:
            f, f2, table = f2, f, table.T
        elif f2 == f:
            table = np.repeat(np.diag(table)[:, None], self.width, 1)
        key = (f, f2)
        self.tables[key] = self.tables[key] + table if key in self.tables else table

    def model(self) -> np.ndarray:
        """The tables of all pairs of features; the start is part of the first."""
        out = np.zeros((self.p, self.p, self.width, self.width))
        for (a, b), t in self.tables.items():
            out[a, b] += t
        out[0, 0] += self.start
        return out


def scores(model: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Log odds of rows of bins under the tables of a model."""
    out = np.zeros(len(bins))
    for a in range(model.shape[0]):
        for b in range(a, model.shape[0]):
            if model[a, b].any():
                out += model[a, b][bins[:, a], bins[:, b]]
    return out


def dealt(count: np.ndarray, start: np.ndarray, fold: int, folds: int) -> np.ndarray:
    """How many of `count` rows, dealt over the folds in turn from fold `start` on, come to this fold."""
    return (count + folds - 1 - (fold - start) % folds) // folds


def held_out_curve(bins, n, y, start, fold, folds, most, width, rate, bag, least, seed):
    """Deviances and areas under the curve on the rows of a fold, every STEP trees fitted on the other folds, until they have stopped
    falling: the mean of the last five is not under that of the five before by a thousandth of the first, after 20 looks at least."""
    zeros, ones = dealt(n - y, start, fold, folds), dealt(y, start, fold, folds)
    fit, held, mine = Boosting(bins, n - zeros - ones, y - ones, width, rate, bag, least, seed), zeros + ones, ones
    used = np.flatnonzero(held)
    curve, area = [], []
    null = deviance(mine[used], held[used], np.full(len(used), 1 / (1 + math.exp(-fit.start))))
    while fit.trees < most:
        for _ in range(STEP):
            fit.grow()
        p = 1 / (1 + np.exp(-fit.score[used]))
        curve.append(deviance(mine[used], held[used], p))
        area.append(area_under_curve(mine[used], held[used], p))
        if len(curve) > 20 and np.mean(curve[-10:-5]) - np.mean(curve[-5:]) <= 0.001 * null:
            break
    return curve, area, null, int(held.sum())


def _binned(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    def place(f: str, es: Sequence[float]):
        return F.size(F.filter(F.array(*[F.lit(float(e)) for e in es]).cast("array<double>"), lambda e: e < F.col(f).cast("double")))
    return df.withColumn("_bins", F.array(*[place(f, es) for f, es in zip(features, edges)]))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Up to bins - 1 different edges of each feature at quantiles of all rows; a value is right of the edges that are smaller."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), at, F.lit(10000)).alias(f"_{k}") for k, f in enumerate(features)]).first()
    return [sorted(set(v or [])) for v in row]


def species_distribution(train: DataFrame, grid: DataFrame, features: Sequence[str], label: str = "presence", species: str | None = None,
                         rate: float = 0.05, least_rate: float = 0.0005, least_trees: int = 1000, most_trees: int = 10000, folds: int = 10,
                         bins: int = 32, cells: int = 4096, bag: float = 0.75, least: int = 10, seed: int = 1, block_mb: int = 64
                         ) -> tuple[DataFrame, DataFrame]:
    """M-05: boosted trees of presence (0/1) on environment for each species: (predictions of every grid row, evaluation).

    Trees of two splits are added while the deviance on held-out folds falls; the number with the least mean deviance is taken. While
    that is under `least_trees` and the rate above `least_rate`, the rate is halved and the species fitted again; the last fit counts.
    Evaluation: species, rate, trees, deviance_explained (held out, share of the null deviance) and auc (mean over folds).
    Predictions: the columns of grid, species and pred.

    A species is fitted on at most about `cells` cells of equal bins (all their rows; those of smallest hash where it has more), each fold
    of a species in a task of its own. Equal rows are dealt over the folds in turn, so the result does not depend on the order of rows. Rows with a
    NULL or NaN feature, a NULL label or a NULL species take no part in the fit; their prediction is NULL. Models of all species are laid against the
    grid in blocks of `block_mb`. A species with one label alone has pred near that label, NULL auc and deviance_explained.
    """
    spark, one = train.sparkSession, "species" if species is None else species
    if species is None:
        train = train.withColumn(one, F.lit(""))
    known = lambda d: [~F.isnan(F.col(f).cast("double")) & F.col(f).isNotNull() for f in features]
    for c in known(train):
        train = train.filter(c)
    train = train.filter(F.col(label).isNotNull() & F.col(one).isNotNull())
    edges = bin_edges(train, features, bins)
    y = F.col(label).cast("double") > 0
    table = (_binned(train, features, edges).groupBy(F.col(one).cast("string").alias("_sp"), "_bins").agg(F.count(F.lit(1)).alias("n"), F.count_if(y).alias("y"))
             .withColumn("_h", F.xxhash64("_sp", "_bins", F.lit(seed))))
    table = cut_lineage(table)
    sizes = table.groupBy("_sp").agg(F.count(F.lit(1)).alias("_k"))
    share = (F.col("_h").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    table = cut_lineage(table.join(sizes, "_sp").filter(share * F.col("_k") < F.lit(float(cells)))
                        .select("_sp", "_bins", "n", "y", F.pmod(F.col("_h"), F.lit(folds)).cast("int").alias("_start"), "_h"))
    seeds = lambda frame, fold: abs(hash((int(frame["_h"].min()), fold, seed))) % (1 << 32)

    def arrays(frame: pd.DataFrame):
        frame = frame.sort_values("_h")
        return np.array(frame["_bins"].tolist()), frame["n"].to_numpy(), frame["y"].to_numpy(), frame["_start"].to_numpy()

    left, found, tasks = table, [], 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        def one_fold(frame: pd.DataFrame) -> pd.DataFrame:
            fold = int(frame["_fold"].iloc[0])
            curve, area, null, held = held_out_curve(*arrays(frame), fold, folds, most_trees, bins, rate, bag, least, seeds(frame, fold))
            return pd.DataFrame({"_sp": [frame["_sp"].iloc[0]], "curve": [curve], "area": [area], "null": [null], "held": [held]})

        # few rows and much work in each: dealt over tasks by number, which adaptive execution leaves alone
        runs = left.withColumn("_fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).repartition(tasks, "_sp", "_fold").groupBy("_sp", "_fold")
        curves = runs.applyInPandas(one_fold, "_sp string, curve array<double>, area array<double>, null double, held long")
        look = (curves.filter("held > 0").select("_sp", "null", "held", F.size("curve").alias("k"), F.posexplode(F.arrays_zip("curve", "area")).alias("j", "v")))
        means = (look.groupBy("_sp", "j").agg((F.sum(F.col("v.curve") * F.col("held")) / F.sum("held")).alias("dev"),
                                              F.avg(F.when(~F.isnan("v.area"), F.col("v.area"))).alias("auc"), F.count(F.lit(1)).alias("c"),
                                              (F.sum(F.col("null") * F.col("held")) / F.sum("held")).alias("null"))
                 .withColumn("_most", F.max("c").over(W.partitionBy("_sp"))).filter("c = _most"))
        best = means.groupBy("_sp").agg(F.min_by(F.struct("j", "dev", "null", "auc"), F.struct("dev", "j")).alias("b")).select(
            "_sp", ((F.col("b.j") + 1) * STEP).cast("int").alias("trees"), F.lit(float(rate)).alias("rate"),
            F.when(F.col("b.null") > 1e-5, 1 - F.col("b.dev") / F.col("b.null")).alias("deviance_explained"), F.col("b.auc").alias("auc"))
        best = cut_lineage(best)
        more = best.filter(F.col("trees") < least_trees) if rate > least_rate else best.limit(0)
        found.append(best.join(more.select("_sp"), "_sp", "left_anti"))
        if more.isEmpty():
            break
        left = left.join(more.select("_sp"), "_sp", "left_semi")
        rate /= 2
    chosen = found[0]
    for f in found[1:]:
        chosen = chosen.unionByName(f)
    chosen = cut_lineage(chosen)

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        b, n, k, _ = arrays(frame)
        fit = Boosting(b, n, k, bins, float(frame["rate"].iloc[0]), bag, least, seeds(frame, -1))
        for _ in range(int(frame["trees"].iloc[0])):
            fit.grow()
        return pd.DataFrame({"_sp": [frame["_sp"].iloc[0]], "model": [fit.model().astype("<f8").tobytes()]})

    fits = table.join(chosen.select("_sp", "trees", "rate"), "_sp")
    models = cut_lineage(fits.repartition(tasks, "_sp").groupBy("_sp").applyInPandas(whole, "_sp string, model binary"))
    cells_of = _binned(grid, features, edges)
    for k, c in enumerate(known(grid)):
        cells_of = cells_of.withColumn("_bins", F.when(c, F.col("_bins")))
    width, p = bins, len(features)
    per_block = max(1, block_mb * 2 ** 20 // (8 * p * p * width * width))
    out, block = None, []

    def laid(block) -> DataFrame:
        names, raw = [r[0] for r in block], spark.sparkContext.broadcast([bytes(r[1]) for r in block])

        def run(batches):
            tables = [np.frombuffer(m, "<f8").reshape(p, p, width, width) for m in raw.value]
            for b in batches:
                rows = [v for v in b.column(b.num_columns - 1).to_pylist()]
                ok = np.array([v is not None for v in rows], bool)
                at = np.array([v for v in rows if v is not None], np.int64).reshape(-1, p)
                for name, t in zip(names, tables):
                    pred = np.full(len(rows), np.nan)
                    pred[ok] = 1 / (1 + np.exp(-scores(t, at)))
                    yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([name] * len(rows), pa.string()), pa.array(pred, pa.float64(), mask=~ok)],
                                                     [*b.schema.names[:-1], one, "pred"])
        schema = cells_of.drop("_bins").withColumn(one, F.lit("").cast("string")).withColumn("pred", F.lit(0.0).cast("double")).schema
        for f in schema:
            f.nullable = True
        return cells_of.mapInArrow(run, schema)

    for r in models.toLocalIterator():
        block.append(r)
        if len(block) == per_block:
            out, block = laid(block) if out is None else out.union(laid(block)), []
    if block or out is None:
        out = laid(block) if out is None else out.union(laid(block))
    ev = chosen.withColumnRenamed("_sp", one).select(one, "rate", "trees", "deviance_explained", "auc")
    return (out, ev) if species is not None else (out.drop(one), ev.drop(one))
