"""Regression fits and tests as Spark jobs (M-01 .. M-04, M-08 .. M-10, M-12 .. M-14)."""
from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scale import cut_lineage, drop_checkpoint, exact_quantiles, join_small
from ..functions.scalars import ln_gamma
from ..functions.tails import f_tail, normal_tail, t_tail

Z95 = 1.959963984540054


# ---------------------------------------------------------------- M-01 generalised linear models

def _levels(df: DataFrame, col: str) -> list:
    """The levels of a factor: as many as the model has coefficients, which its result lists one by one."""
    return [r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


GRADIENT, DEVIANCE, PEARSON = -1, -2, -3  # marks of the sums that are not part of X'WX


def grouped_glm(df: DataFrame, response: str, by: Sequence[str], numeric: Sequence[str] = (),
                factors: Mapping[str, Sequence] | Sequence[str] = (), family: str = "gaussian",
                max_iter: int = 25, tol: float = 1e-6) -> tuple[DataFrame, DataFrame]:
    """M-01: one fit per group by reweighted least squares, for all groups at once.

    Returns (coefficients, fits). Equal design rows are merged first, so a model on factors works
    on a few rows per group whatever the data size. Each round is one sum of X'WX and X'Wz over
    all groups; the p x p solve is a row-wise function. Families: gaussian, poisson, quasipoisson,
    binomial. Rows of a level that a given list of levels leaves out take no part. A column without variation in a group gets NULL, and a group that cannot be fitted is
    reported by its status.
    """
    by = list(by)
    keys = by or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    need = [response, *numeric, *(factors if not isinstance(factors, Mapping) else factors.keys())]
    src = src.dropna(subset=need)
    fac = dict(factors) if isinstance(factors, Mapping) else {f: _levels(src, f) for f in factors}
    # a design row is sparse: places of the coefficients and values, so that a factor may have any number of levels
    names, at, val = ["(Intercept)"], [F.lit(0)], [F.lit(1.0)]
    for c in numeric:
        at.append(F.lit(len(names)))
        val.append(F.col(c).cast("double"))
        names.append(c)
    for k, (c, lv) in enumerate(fac.items()):
        lv = list(lv)
        place = df.sparkSession.createDataFrame([(v, len(names) + i - 1 if i else 0) for i, v in enumerate(lv)],
                                                T.StructType([src.schema[c], T.StructField(f"_f{k}", T.IntegerType())]))
        src = join_small(src, place, [c])
        at.append(F.col(f"_f{k}"))
        val.append(F.when(F.col(f"_f{k}") > 0, 1.0).otherwise(0.0))
        names += [f"{c}{v}" for v in lv[1:]]
    p = len(names)
    y = F.col(response).cast("double")
    raw = src.select(*keys, F.array(*at).alias("_at"), F.array(*val).alias("_val"), y.alias("_y"))
    xs = ["_at", "_val"]
    cells = raw.groupBy(*keys, *xs, "_y").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    lf = F.when(F.col("_y") >= 0, ln_gamma(F.col("_y") + 1)) if family == "poisson" else F.lit(0.0)
    yln = F.when(F.col("_y") > 0, F.col("_y") * F.ln("_y")).otherwise(0.0)
    cells = cut_lineage(cells.withColumn("_lf", lf).groupBy(*keys, *xs).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_y")).alias("_sy"),
        F.sum(F.col("_n") * F.col("_y") * F.col("_y")).alias("_syy"),
        F.sum(F.col("_n") * yln).alias("_syl"), F.sum(F.col("_n") * F.col("_lf")).alias("_slf")))
    tot = cells.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_sy").alias("sy"), F.sum("_syy").alias("syy"),
                                   F.sum("_syl").alias("syl"), F.sum("_slf").alias("slf"))
    ybar = F.col("sy") / F.col("n")
    link0 = {"gaussian": ybar, "binomial": F.ln((ybar + 1e-9) / (1 - ybar + 1e-9))}.get(family, F.ln(ybar + 1e-12))
    state = cut_lineage(tot.select(*keys, F.concat(F.array(link0), F.array_repeat(F.lit(0.0), p - 1)).alias("_beta"),
                                   F.lit(float("inf")).alias("_step")))

    eta = F.aggregate(F.zip_with("_at", "_val", lambda i, v: v * F.get("_beta", i)), F.lit(0.0), lambda t, x: t + x)
    link = {"gaussian": eta, "binomial": 1 / (1 + F.exp(-eta))}.get(family, F.exp(F.least(eta, F.lit(700.0))))
    mu = F.col("_mu")
    w = {"gaussian": F.lit(1.0), "binomial": F.greatest(mu * (1 - mu), F.lit(1e-12))}.get(family, mu)
    if family == "gaussian":
        dev = F.col("_syy") - 2 * mu * F.col("_sy") + F.col("_n") * mu * mu
        pear = dev
    elif family == "binomial":
        dev = -2 * (F.col("_sy") * F.ln(mu) + (F.col("_n") - F.col("_sy")) * F.ln(1 - mu))
        pear = (F.col("_syy") - 2 * mu * F.col("_sy") + F.col("_n") * mu * mu) / w
    else:
        dev = 2 * (F.col("_syl") - F.col("_sy") * F.ln(mu) - (F.col("_sy") - F.col("_n") * mu))
        pear = (F.col("_syy") - 2 * mu * F.col("_sy") + F.col("_n") * mu * mu) / mu

    out_t = T.StructType([src.schema[k] for k in keys] + [
        T.StructField("_beta", T.ArrayType(T.DoubleType())), T.StructField("_step", T.DoubleType()),
        T.StructField("_cov", T.ArrayType(T.DoubleType())), T.StructField("_rank", T.IntegerType()),
        T.StructField("_dev", T.DoubleType()), T.StructField("_pear", T.DoubleType())])

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                i, j, v = (np.asarray(r[c], t) for c, t in (("_i", int), ("_j", int), ("_v", float)))
                h, g, b = np.zeros((p, p)), np.zeros(p), np.asarray(r["_beta"], float)
                inner = j >= 0
                h[i[inner], j[inner]] = v[inner]
                h = h + h.T - np.diag(np.diag(h))
                g[i[j == GRADIENT]] = v[j == GRADIENT]
                # columns are taken in order; one that the earlier ones explain is left out
                use, left, scale = [], h.copy(), np.diag(h).copy()
                for c in range(p):
                    if not (np.isfinite(scale[c]) and scale[c] > 0 and left[c, c] > 1e-9 * scale[c]):
                        left[c:, c] = left[c, c:] = 0
                        continue
                    left[c + 1:, c + 1:] -= np.outer(left[c + 1:, c], left[c, c + 1:]) / left[c, c]
                    use.append(c)
                step, cov = np.zeros(p), np.full(p, np.nan)
                if use:
                    sub = h[np.ix_(use, use)]
                    step[use] = np.linalg.solve(sub, g[use])
                    cov[use] = np.diag(np.linalg.inv(sub))
                big = np.max(np.abs(step)) if len(step) else 0.0
                if family != "gaussian" and big > 5:
                    step *= 5 / big
                rows.append({**{k: r[k] for k in keys}, "_beta": (b + step).tolist(), "_step": float(np.max(np.abs(step))),
                             "_cov": cov.tolist(), "_rank": len(use), "_dev": float(v[j == DEVIANCE].sum()), "_pear": float(v[j == PEARSON].sum())})
            yield pd.DataFrame(rows, columns=[f.name for f in out_t])

    for _ in range(max_iter):
        d = join_small(cells, state.select(*keys, "_beta"), keys).withColumn("_mu", link)
        d = d.select(*keys, "_at", "_val", (F.col("_n") * w).alias("_w"), (F.col("_sy") - F.col("_n") * mu).alias("_r"), dev.alias("_d"), pear.alias("_p"))
        entry = lambda i, j, v: F.struct(i.cast("int").alias("_i"), j.cast("int").alias("_j"), v.cast("double").alias("_v"))
        x = F.zip_with("_at", "_val", lambda i, v: F.struct(i.alias("i"), v.alias("v")))
        x = F.filter(x, lambda e: e["v"] != 0)
        pairs = F.flatten(F.transform(x, lambda e: F.transform(F.filter(x, lambda f: f["i"] >= e["i"]), lambda f: entry(e["i"], f["i"], F.col("_w") * e["v"] * f["v"]))))
        slope = F.transform(x, lambda e: entry(e["i"], F.lit(GRADIENT), e["v"] * F.col("_r")))
        rest = F.array(entry(F.lit(0), F.lit(DEVIANCE), F.col("_d")), entry(F.lit(0), F.lit(PEARSON), F.col("_p")))
        sums = d.select(*keys, F.inline(F.concat(pairs, slope, rest))).groupBy(*keys, "_i", "_j").agg(F.sum("_v").alias("_v"))
        lists = sums.groupBy(*keys).agg(F.collect_list(F.struct("_i", "_j", "_v")).alias("_e"))  # at most p (p + 3) / 2 + 2 entries
        s = lists.join(state.select(*keys, "_beta"), keys).select(*keys, "_beta", "_e._i", "_e._j", "_e._v")
        state, old = cut_lineage(s.mapInPandas(solve, out_t)), state
        drop_checkpoint(old)
        if (state.agg(F.max("_step")).first()[0] or 0.0) < tol:
            break

    dfres = F.col("n") - F.col("_rank")
    ratio = F.col("_pear") / dfres if family in ("gaussian", "quasipoisson") else F.lit(1.0)
    null_dev = {"gaussian": F.col("syy") - F.col("sy") * ybar,
                "binomial": -2 * (F.col("sy") * F.ln(ybar) + (F.col("n") - F.col("sy")) * F.ln(1 - ybar))
                }.get(family, 2 * (F.col("syl") - F.col("sy") * F.ln(ybar)))
    aic = {"gaussian": F.col("n") * (F.ln(2 * math.pi * F.col("_dev") / F.col("n")) + 1) + 2 * (F.col("_rank") + 1),
           "binomial": F.col("_dev") + 2 * F.col("_rank"),
           "poisson": F.col("_dev") - 2 * (F.col("syl") - F.col("sy") - F.col("slf")) + 2 * F.col("_rank"),
           }.get(family, F.lit(None).cast("double"))
    d = state.join(tot, keys).withColumn("_phi", F.when(dfres > 0, ratio))
    fits = d.select(*by, F.col("n").cast("long").alias("n"), aic.alias("aic"), F.col("_dev").alias("deviance"),
                    null_dev.alias("null_deviance"), dfres.cast("long").alias("df_residual"),
                    (F.col("_pear") / dfres).alias("pearson_ratio"),
                    F.when(F.col("_step") >= tol, "not converged").when(dfres <= 0, "too few rows")
                    .when(F.col("_rank") < p, "columns left out").otherwise("ok").alias("status"))
    terms = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("term"), F.col("_beta").alias("b"),
                         F.col("_cov").alias("v"))
    kept = F.col("c.v").isNotNull() & ~F.isnan("c.v")
    co = d.select(*by, "_phi", dfres.alias("_df"), F.explode(terms).alias("c")).select(
        *by, F.col("c.term").alias("term"), F.when(kept, F.col("c.b")).alias("estimate"),
        F.when(kept, F.sqrt(F.col("c.v") * F.col("_phi"))).alias("std_error"), "_df")
    stat = F.try_divide(F.col("estimate"), F.col("std_error"))
    pv = t_tail(stat, F.col("_df")) if family in ("gaussian", "quasipoisson") else normal_tail(stat)
    co = co.select(*by, "term", "estimate", "std_error", stat.alias("statistic"), pv.alias("p_value"),
                   (F.col("estimate") - Z95 * F.col("std_error")).alias("ci_low"),
                   (F.col("estimate") + Z95 * F.col("std_error")).alias("ci_high"))
    return co, fits


# ---------------------------------------------------------------- M-02 site + year log-linear

def factor_design(levels: np.ndarray) -> np.ndarray:
    return np.eye(len(levels))[:, 1:]


def linear_design(levels: np.ndarray) -> np.ndarray:
    return (levels - levels[0])[:, None]


def two_way_loglinear(df: DataFrame, by: Sequence[str], site: str = "site", year: str = "year",
                      count: str = "count", design: Callable[[np.ndarray], np.ndarray] = factor_design,
                      penalty: float = 0.0, max_iter: int = 40, tol: float = 1e-6) -> DataFrame:
    """M-02: log(count) ~ site + year terms, quasi-Poisson, one fit per group.

    Site effects are removed exactly by conditioning on the site totals. What is left depends only
    on which years a site was visited, so sites with the same years are merged into one row: the
    iteration runs on (group, set of years) rows instead of on the counts. Each Newton round sums
    gradients over partitions and solves one small system per group. Standard errors use the
    information left after eliminating sites.

    Result per group: levels, beta, var (diagonal), totals, n_obs, n_sites, df_residual,
    dispersion, deviance, null_deviance, converged.
    """
    by = list(by)
    keys = by or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    factor = design is factor_design
    y = (src.groupBy(*keys, site, F.col(year).cast("double").alias("_t")).agg(F.sum(count).cast("double").alias("_y"))
            .filter("_y IS NOT NULL"))
    y = cut_lineage(y)  # the raw counts are read once; what follows works on site-year totals
    lev = y.groupBy(*keys, "_t").agg(F.sum("_y").alias("_c"))
    if factor:
        lev = lev.filter("_c > 0")
    lev = (lev.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_t", "_c"))).alias("_l"))
              .select(*keys, F.col("_l._t").alias("levels"), F.col("_l._c").alias("totals")))
    sites = (y.groupBy(*keys, site).agg(
        F.array_sort(F.collect_list(F.struct("_t", "_y"))).alias("_c"), F.sum("_y").alias("_n"),
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.when(F.col("_y") > 0, F.col("_y") * F.ln("_y")).otherwise(0.0)).alias("_yl"))
        .join(lev.select(*keys, "levels"), keys, "left"))
    size = sites.groupBy(*keys).agg(F.sum("_k").alias("n_obs"), F.count(F.lit(1)).alias("n_sites"), F.sum("_n").alias("_tot"),
                                    F.sum("_yl").alias("_yl"),
                                    F.sum(F.when(F.col("_n") > 0, F.col("_n") * F.ln("_n"))).alias("_nl"))
    live = sites.filter("_n > 0")
    if factor:
        live = live.withColumn("_c", F.filter("_c", lambda x: F.array_contains("levels", x["_t"])))
    live = live.withColumn("_pat", F.col("_c._t"))
    cells = (live.select(*keys, "_pat", "_n", F.posexplode("_c").alias("_i", "_e"))
                 .groupBy(*keys, "_pat", "_i").agg(F.sum("_e._y").alias("c"),
                                                   F.sum(F.col("_e._y") * F.col("_e._y") / F.col("_n")).alias("q"))
                 .groupBy(*keys, "_pat").agg(F.array_sort(F.collect_list(F.struct("_i", "c", "q"))).alias("_s"))
                 .select(*keys, "_pat", F.col("_s.c").alias("_cs"), F.col("_s.q").alias("_qs")))
    compact = cut_lineage(cells)
    lev = cut_lineage(lev.join(size, keys))

    kf = [src.schema[k] for k in keys]
    part_t = T.StructType(kf + [T.StructField("_i", T.IntegerType()), T.StructField("_v", T.DoubleType())])

    def partial(batches):
        for pdf in batches:
            rows = []
            for key, g in pdf.groupby(keys, dropna=False, sort=False):
                # all patterns of a group at once: flat arrays over (pattern, level), sums by pattern
                levels, b = np.asarray(g["levels"].iloc[0], float), np.asarray(g["_beta"].iloc[0], float)
                size = g["_pat"].map(len).to_numpy()
                starts = np.cumsum(size) - size
                flat = lambda c: np.concatenate(g[c].to_list()).astype(float)
                c, q = flat("_cs"), flat("_qs")
                z = design(levels)[np.searchsorted(levels, flat("_pat"))]
                eta, n = z @ b, np.add.reduceat(c, starts)
                top = np.maximum.reduceat(eta, starts)
                e = np.exp(eta - np.repeat(top, size))
                total = np.add.reduceat(e, starts)
                pr = e / np.repeat(total, size)
                zbar = np.add.reduceat(z * pr[:, None], starts)
                grad = c @ z - n @ zbar
                hess = (z * (pr * np.repeat(n, size))[:, None]).T @ z - (zbar * n[:, None]).T @ zbar
                ll = float(c @ (eta - np.repeat(top + np.log(total), size)))
                pear = float((q / np.maximum(pr, 1e-300)).sum() - n.sum())
                rows += [(*key, i, float(x)) for i, x in enumerate(np.concatenate([[ll, pear], grad, hess.ravel()]))]
            yield pd.DataFrame(rows, columns=[f.name for f in part_t])

    arr = T.ArrayType(T.DoubleType())
    state_t = T.StructType(kf + [T.StructField("_beta", arr), T.StructField("_var", arr), T.StructField("_ll", T.DoubleType()),
                                 T.StructField("_pear", T.DoubleType()), T.StructField("_step", T.DoubleType())])

    def start(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                levels, c = np.asarray(r["levels"], float), np.asarray(r["totals"], float)
                b = np.log(c[1:] / c[0]) if factor else np.zeros(design(levels).shape[1])
                rows.append({**{k: r[k] for k in keys}, "_beta": b.tolist(), "_var": [], "_ll": 0.0, "_pear": 0.0,
                             "_step": 0.0 if len(b) == 0 else math.inf})
            yield pd.DataFrame(rows, columns=[f.name for f in state_t])

    def step(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                v, b = np.asarray(r["_v"], float), np.asarray(r["_beta"], float)
                p = len(b)
                grad, hess = v[2:2 + p] - penalty * b, v[2 + p:].reshape(p, p) + penalty * np.eye(p)
                inv = np.linalg.pinv(hess, rcond=1e-12) if p else hess
                delta = inv @ grad
                big = np.max(np.abs(delta)) if p else 0.0
                if big > 3:
                    delta *= 3 / big
                rows.append({**{k: r[k] for k in keys}, "_beta": (b + delta).tolist(), "_var": np.diag(inv).tolist(),
                             "_ll": v[0], "_pear": v[1], "_step": float(np.max(np.abs(delta))) if p else 0.0})
            yield pd.DataFrame(rows, columns=[f.name for f in state_t])

    state = cut_lineage(lev.select(*keys, "levels", "totals").mapInPandas(start, state_t))
    for _ in range(max_iter):
        sums = (join_small(compact, lev.select(*keys, "levels").join(state.select(*keys, "_beta"), keys), keys)
                       .select(*keys, "levels", "_beta", "_pat", "_cs", "_qs").mapInPandas(partial, part_t)
                       .groupBy(*keys, "_i").agg(F.sum("_v").alias("_v")).groupBy(*keys)
                       .agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_s"))
                       .select(*keys, F.col("_s._v").alias("_v")))
        state, old = cut_lineage(sums.join(state.select(*keys, "_beta"), keys).select(*keys, "_v", "_beta")
                                     .mapInPandas(step, state_t)), state
        drop_checkpoint(old)
        if (state.agg(F.max("_step")).first()[0] or 0.0) < tol:
            break

    d = lev.join(state, keys)
    dfres = F.col("n_obs") - F.col("n_sites") - F.size("_beta")
    dev = 2 * (F.col("_yl") - F.col("_nl") - F.col("_ll"))
    null = 2 * (F.col("_yl") - F.col("_tot") * F.ln(F.col("_tot") / F.col("n_obs")))
    return d.select(*by, "levels", F.col("_beta").alias("beta"), F.col("_var").alias("var"), "totals", "n_obs", "n_sites",
                    dfres.cast("long").alias("df_residual"),
                    F.when(dfres > 0, F.col("_pear") / dfres).alias("dispersion"), dev.alias("deviance"),
                    null.alias("null_deviance"), (F.col("_step") < tol).alias("converged"))


# ---------------------------------------------------------------- M-03, M-04

def choose_family(df: DataFrame, metric: str, chosen: str | None = None) -> str:
    """M-03: binomial for presence, Poisson for integers, Gaussian for doubles."""
    if chosen:
        return chosen
    if metric == "presence_absence":
        return "binomial"
    kind = df.schema[metric].dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "poisson"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "gaussian"
    raise TypeError(f"{metric} is neither an integer nor a number")


def rate_models(df: DataFrame, fits: DataFrame, metric: str, by: Sequence[str], factors: Sequence[str],
                random_effect: str | None = None, zero_counts: DataFrame | None = None) -> DataFrame:
    """M-04: a score of the plan and of the fit for each analysis.

    Plan points: half for fewer than 10 % empty factor combinations, half more when over 90 % of
    the combinations have one frequency, one for fewer than 10 % rows with a gap. Fit points: 1.5
    when the Pearson ratio is within two standard errors of 1 (in place of a simulated dispersion
    test), one for a residual scale near 1 (uniformity), half for few extreme cells, one when the
    zeros are as many as a Poisson with the group mean expects, one for few factors per row, one
    for a random effect of more than ten levels.
    """
    by, factors = list(by), list(factors)
    m = F.col(metric)
    whole = df.withColumn("_gap", F.greatest(*[F.col(c).isNull().cast("int") for c in [metric, *factors]]))
    combo = whole.groupBy(*by, *factors).agg(F.count(F.lit(1)).alias("_f"))
    # possible combinations are the product of the level counts; the unseen ones are never listed
    lv = whole.groupBy(*by).agg(*[F.count_distinct(f).alias(f"_l{i}") for i, f in enumerate(factors)])
    prod = F.lit(1.0)
    for i in range(len(factors)):
        prod = prod * F.col(f"_l{i}")
    freq = combo.groupBy(*by, "_f").agg(F.count(F.lit(1)).alias("_times"))
    # The shares and points named above.
    plan = (freq.groupBy(*by).agg(F.sum("_times").alias("_seen"), F.max("_times").alias("_same")).join(lv, by)
                .select(*by, ((prod - F.col("_seen")) < 0.1 * prod).alias("complete_plan"),
                        (F.col("_same") > 0.9 * prod).alias("_even")))
    rows = whole.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum("_gap").alias("_g"), F.avg(m).alias("_mean"),
                                  F.stddev_samp(m).alias("_sd"), F.avg((m == 0).cast("double")).alias("_z"))
    far = (join_small(whole, rows.select(*by, "_mean", "_sd"), by).groupBy(*by)
                .agg(F.avg((F.abs(m - F.col("_mean")) > 4 * F.col("_sd")).cast("double")).alias("_far")))
    d = plan.join(rows, by).join(far, by).join(fits.select(*by, "pearson_ratio", "df_residual"), by)
    if random_effect:
        d = d.join(df.groupBy(*by).agg(F.count_distinct(random_effect).alias("_lv")), by)
    band = 2 * F.sqrt(2.0 / F.col("df_residual"))
    zero = F.exp(-F.col("_mean"))
    checks = {
        "complete_plan": (F.col("complete_plan"), 0.5),
        "balanced_plan": (F.col("complete_plan") & F.col("_even"), 0.5),
        "few_gaps": (F.col("_g") < 0.1 * F.col("_n"), 1.0),
        "regular_dispersion": (F.abs(F.col("pearson_ratio") - 1) <= band, 1.5),
        "uniform_residuals": (F.col("pearson_ratio").between(0.5, 2.0), 1.0),
        "few_outliers": (F.col("_far") < 0.01, 0.5),
        "no_zero_inflation": (F.abs(F.col("_z") - zero) <= 2 * F.sqrt(zero * (1 - zero) / F.col("_n")) + 1e-9, 1.0),
        "enough_rows": (F.lit(float(len(factors))) / (F.col("_n") - F.col("_g")) < 0.1, 1.0),
        "enough_random_levels": ((F.col("_lv") > 10) if random_effect else F.lit(None).cast("boolean"), 1.0),
    }
    out = d.select(*by, *[F.coalesce(c, F.lit(None).cast("boolean")).alias(n) for n, (c, _) in checks.items()])
    score = F.lit(0.0)
    for n, (_, pts) in checks.items():
        score = score + F.when(F.col(n), pts).otherwise(0.0)
    return out.withColumn("rate", score)


def overall_rate(rated: DataFrame, good: float = 5) -> DataFrame:
    """M-04: median rate, plus one if half and one if nine tenths of the analyses are good."""
    q = exact_quantiles(rated, [], "rate", {"m": .5, "h": .9})
    return q.select((F.col("m") + (F.col("m") >= good).cast("int") + (F.col("h") >= good).cast("int")).alias("overall"))


# ---------------------------------------------------------------- correlations and tests

def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M-08: r, n and p of every pair of columns, from one pass."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    both = lambda a, b: F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1))
    g = df.agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)],
               *[both(a, b).alias(f"_n{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"_r{i}").alias("r"),
                              F.col(f"_n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
    d = g.select(F.inline(rows))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return d.withColumn("p_value", t_tail(t, F.col("n") - 2))


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M-09: variance inflation per column, the diagonal of the inverse correlation matrix."""
    cols = list(cols)
    pairs = {(a, b): F.corr(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]}
    got = df.dropna(subset=cols).agg(*[c.alias(f"_{i}") for i, c in enumerate(pairs.values())]).first()
    m = np.eye(len(cols))
    for (a, b), v in zip(pairs, got):
        i, j = cols.index(a), cols.index(b)
        m[i, j] = m[j, i] = np.nan if v is None else v
    if not np.isfinite(m).all() or np.linalg.matrix_rank(m, tol=1e-10) < len(cols):
        raise ValueError("the columns are linearly dependent; inflation factors do not exist")
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, np.diag(np.linalg.inv(m)))],
                                           "variable string, vif double")


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """M-10: F test on absolute deviations from group medians."""
    med = exact_quantiles(df, [group], value, {"_med": .5})
    z = join_small(df.filter(F.col(value).isNotNull()), med, [group]).withColumn("_z", F.abs(F.col(value) - F.col("_med")))
    g = z.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("_z").alias("m"),
                             F.coalesce(F.var_pop("_z"), F.lit(0.0)).alias("v"))
    t = g.agg(F.count(F.lit(1)).cast("double").alias("k"), F.sum("n").alias("nn"), F.sum(F.col("n") * F.col("v")).alias("w"),
              F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("q"))
    between = F.col("q") - F.col("s") * F.col("s") / F.col("nn")
    d1, d2 = F.col("k") - 1, F.col("nn") - F.col("k")
    stat = F.try_divide(between / d1, F.col("w") / d2)
    return t.select(d1.cast("long").alias("df1"), d2.cast("long").alias("df2"), stat.alias("f_value")).withColumn(
        "p_value", f_tail("f_value", "df1", "df2"))


def median_and_dispersion(df: DataFrame, value: str, species: str = "species") -> DataFrame:
    """M-12: quartiles, whiskers and number of outliers per species (box plot numbers)."""
    q = exact_quantiles(df, [species], value, {"q1": .25, "median": .5, "q3": .75})
    i = F.col("q3") - F.col("q1")
    q = q.withColumn("low", F.col("q1") - 1.5 * i).withColumn("high", F.col("q3") + 1.5 * i)
    out = join_small(df, q, [species]).groupBy(species).agg(
        F.count_if((F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))).alias("outliers"))
    return q.join(out, species)


def iqr_outliers(df: DataFrame, value: str, weight: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """M-14: bounds beyond which a value is an outlier."""
    q = exact_quantiles(df, by, value, {"q1": .25, "q3": .75})
    i = F.col("q3") - F.col("q1")
    return q.select(*by, (F.col("q1") - weight * i).alias("low"), (F.col("q3") + weight * i).alias("high"))


# ---------------------------------------------------------------- M-13 interpolation

def idw(obs: DataFrame, value: str, lat: str = "lat", lon: str = "lon", power: float = 2.0,
        columns: int = 10, rows: int = 10, extent: Sequence[float] | None = None) -> DataFrame:
    """M-13: inverse-distance weighted mean at the points of a regular grid over the extent.

    Every observation counts at every grid point, so each row is expanded over the (given, small)
    grid and summed at once on the map side; what is shuffled is one partial sum per grid point
    and task. At a grid point that is an observation the value is the observed mean.
    """
    d = obs.filter(F.col(value).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if extent is None:
        box = d.agg(F.min(lon), F.min(lat), F.max(lon), F.max(lat)).first()
        extent = tuple(float(v) for v in box)
    w, s, e, n = (float(v) for v in extent)
    i = F.sequence(F.lit(0), F.lit(columns * rows - 1))
    d = d.select(F.col(lat).cast("double").alias("_la"), F.col(lon).cast("double").alias("_lo"),
                 F.col(value).cast("double").alias("_v"), F.explode(i).alias("_i"))
    gx = w + (F.col("_i") % columns) * ((e - w) / max(columns - 1, 1))
    gy = s + F.floor(F.col("_i") / columns) * ((n - s) / max(rows - 1, 1))
    d2 = F.pow(F.col("_lo") - gx, 2) + F.pow(F.col("_la") - gy, 2)
    wt = F.when(d2 > 0, F.pow(d2, F.lit(-power / 2)))
    g = d.groupBy("_i").agg(F.sum(wt * F.col("_v")).alias("_a"), F.sum(wt).alias("_b"),
                            F.avg(F.when(d2 == 0, F.col("_v"))).alias("_at"))
    return g.select(gx.alias("lon"), gy.alias("lat"), F.coalesce(F.col("_at"), F.col("_a") / F.col("_b")).alias("value"))
