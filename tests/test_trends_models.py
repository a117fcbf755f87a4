"""Fits, tests and trends against numpy, and phenology by hand."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from biolattice.operators import distribution, models, trends


def irls(x, y, family):
    """Plain numpy fit for comparison."""
    b = np.zeros(x.shape[1])
    b[0] = math.log(y.mean()) if family == "poisson" else 0
    for _ in range(60):
        eta = x @ b
        mu = np.exp(eta) if family == "poisson" else 1 / (1 + np.exp(-eta))
        w = mu if family == "poisson" else mu * (1 - mu)
        b = b + np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (y - mu))
    return b, np.linalg.inv(x.T @ (x * w[:, None])), mu


@pytest.mark.parametrize("family", ["poisson", "binomial", "quasipoisson"])
def test_glm_equals_numpy_per_group(spark, family):
    r = np.random.default_rng(1)
    p = pd.DataFrame({"g": np.repeat(["a", "b"], 120), "x": np.round(r.normal(size=240), 1), "f": r.choice(["k", "l", "m"], 240)})
    lin = 0.4 * p.x + (p.f == "l") * .5 + (p.g == "b") * .3
    p["y"] = (r.poisson(np.exp(lin)) if family != "binomial" else r.random(240) < 1 / (1 + np.exp(-lin))).astype(int)
    co, fits = models.grouped_glm(spark.createDataFrame(p), "y", ["g"], ["x"], ["f"], family=family)
    co, fits = co.toPandas(), fits.toPandas().set_index("g")
    for g, d in p.groupby("g"):
        x = np.column_stack([np.ones(len(d)), d.x, d.f == "l", d.f == "m"]).astype(float)
        b, cov, mu = irls(x, d.y.to_numpy(float), "binomial" if family == "binomial" else "poisson")
        got = co[co.g == g].set_index("term").loc[["(Intercept)", "x", "fl", "fm"]]
        np.testing.assert_allclose(got.estimate, b, atol=1e-6)
        phi = (((d.y - mu) ** 2 / mu).sum() / (len(d) - 4)) if family == "quasipoisson" else 1
        np.testing.assert_allclose(got.std_error, np.sqrt(np.diag(cov) * phi), rtol=1e-5)
        assert fits.loc[g].status == "ok" and fits.loc[g].df_residual == len(d) - 4
        if family == "poisson":
            ll = sum(v * math.log(m) - m - math.lgamma(v + 1) for v, m in zip(d.y, mu))
            assert fits.loc[g].aic == pytest.approx(-2 * ll + 8, abs=1e-5)


def test_glm_reports_groups_it_cannot_fit(spark):
    d = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("a", 1.0, 4.0), ("b", 1.0, 2.0), ("b", 2.0, 4.1), ("b", 3.0, 5.9)], "g string, x double, y double")
    co, fits = models.grouped_glm(d, "y", ["g"], ["x"], family="gaussian")
    s = {r.g: r.status for r in fits.collect()}
    assert s == {"a": "columns left out", "b": "ok"}
    assert {(r.g, r.term): r.estimate for r in co.collect()}[("a", "x")] is None


@pytest.fixture(scope="module")
def counts():
    r = np.random.default_rng(2)
    rows = [(sp, s, y, int(r.poisson(math.exp(.2 * s % 2 + .1 * (y - 2000) + (sp == "b")))))
            for sp in "ab" for s in range(30) for y in range(2000, 2007) if r.random() < .7]
    return pd.DataFrame(rows, columns=["species", "site", "year", "abundance"])


def test_site_year_fit_equals_full_glm(spark, counts):
    got = trends.annual_variation(spark.createDataFrame(counts)).toPandas()
    lin = trends.overall_trend(spark.createDataFrame(counts)).toPandas().set_index("species")
    for sp, d in counts.groupby("species"):
        live = d[d.groupby("site").abundance.transform("sum") > 0]
        sites, years = sorted(live.site.unique()), sorted(live.year.unique())
        sx = np.column_stack([live.site == s for s in sites]).astype(float)
        x = np.column_stack([sx] + [live.year == y for y in years[1:]]).astype(float)
        b, cov, mu = np.zeros(x.shape[1]), None, None
        b[:len(sites)] = math.log(live.abundance.mean())
        for _ in range(80):
            mu = np.exp(x @ b)
            b = b + np.clip(np.linalg.solve(x.T @ (x * mu[:, None]), x.T @ (live.abundance - mu)), -2, 2)
        cov = np.linalg.inv(x.T @ (x * mu[:, None]))
        df = len(d) - d.site.nunique() - len(years) + 1
        phi = ((live.abundance - mu) ** 2 / mu).sum() / df
        k = got[got.species == sp].sort_values("year")
        np.testing.assert_allclose(k.relative_abundance.iloc[1:], np.exp(b[len(sites):]), rtol=1e-5)
        se = np.sqrt(np.diag(cov)[len(sites):] * phi) * np.exp(b[len(sites):])
        np.testing.assert_allclose(k.std_error.iloc[1:], se, rtol=1e-4)
        assert k.relative_abundance.iloc[0] == 1 and k.p_value.iloc[0] == 1
        assert lin.loc[sp].trend == pytest.approx(math.exp(.1), abs=.05)


def test_linear_trend_and_autocorrelation(spark):
    r = np.random.default_rng(4)
    x, y = np.arange(30.0), r.normal(size=30).cumsum()
    d = spark.createDataFrame(pd.DataFrame({"year": x, "index": y}))
    t = trends.linear_trend(d).first()
    s, i = np.polyfit(x, y, 1)
    res = y - s * x - i
    assert t.slope == pytest.approx(s) and t.std_error == pytest.approx(math.sqrt((res ** 2).sum() / 28 / ((x - x.mean()) ** 2).sum()))
    a = trends.autocorrelation(d, "index", "year", max_lag=4).toPandas().set_index("lag").acf
    c = y - y.mean()
    for k in range(5):
        assert a[k] == pytest.approx((c[:30 - k] * c[k:]).sum() / (c * c).sum())


def test_anchors_at_the_edges_of_the_year(spark):
    d = spark.createDataFrame([("s", 1, "2004-01-05", 3), ("s", 1, "2004-12-28", 1), ("s", 2, "2004-06-01", 2)], "species string, site int, date string, count int").withColumn("date", F.to_date("date"))
    g = trends.day_grid(d).toPandas()
    assert len(g) == 2 * 366
    a = g[(g.site == 1) & (g.anchor == 1)].dayno.tolist()
    assert sorted(a) == [1, 2, 3, 4, 5, 362, 363, 364, 365, 366] and g[(g.site == 1) & (g.dayno == 5)]["count"].iloc[0] == 0
    assert g[(g.site == 2) & (g.dayno == 153)]["count"].iloc[0] == 2


def test_flight_curve_and_index(spark):
    r = np.random.default_rng(6)
    rows = []
    for s in range(12):
        for day in range(95, 280, 7):
            m = (s + 2) * 6 * math.exp(-((day - 185) / 30) ** 2)
            rows.append(("sp", s, pd.Timestamp("2011-01-01") + pd.Timedelta(days=day - 1), int(r.poisson(m))))
    v = spark.createDataFrame(pd.DataFrame(rows, columns=["species", "site", "date", "count"])).withColumn("date", F.to_date("date"))
    c = trends.flight_curve(v)
    p = c.toPandas()
    assert p.nm.sum() == pytest.approx(1) and (p[(p.dayno < 60) | (p.dayno > 305)].nm == 0).all() and abs(p.loc[p.nm.idxmax()].dayno - 185) < 8
    idx = trends.abundance_index(v, c).toPandas().set_index("site")
    assert idx.loc[11].regional_index > idx.loc[2].regional_index > idx.loc[0].regional_index
    assert idx.prop_pheno_sampled.between(0.9, 1.0001).all()


def test_trend_words_and_back_transform(spark):
    d = spark.createDataFrame([(1.0, .5, .96, 1.04), (1.0, .5, .9, 1.2), (.9, .01, .8, .94), (.97, .01, .9, .99), (1.2, .01, 1.1, 1.3), (1.03, .01, 1.01, 1.06)], "t double, p double, lo double, hi double")
    got = [r.c for r in d.select(trends.trend_category("t", "p", "lo", "hi").alias("c")).collect()]
    assert got == ["Stable", "Incertain", "Fort declin", "Declin moderee", "Forte augmentation", "Augmentation modere"]
    b = trends.back_transform(spark.createDataFrame([(0.0,)], "x double"), "binomial", ["x"]).first()
    assert b.x == 0.5


def test_group_index_weights(spark):
    an = spark.createDataFrame([("a", 2000, 1.0, 1.0, 1.0), ("a", 2001, 2.0, 1.5, 2.5), ("b", 2000, 1.0, 1.0, 1.0), ("b", 2001, 8.0, 7.0, 9.0), ("c", 2000, 1.0, 1.0, 1.0), ("c", 2001, 0.0, 0.0, None)],
                               "species string, year int, relative_abundance double, ci_low double, ci_high double")
    tr = spark.createDataFrame([("a", "bon", 30.0), ("b", "Incertain", 7.0), ("c", "bon", 20.0)], "species string, valid string, median_occupied double")
    g = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "g")], "species string, group string")
    bias = spark.createDataFrame([(0.0, .1), (5.0, .5), (10.0, .9)], "threshold double, bias double")
    y, s = trends.group_index(an, tr, g, bias)
    r = {x.year: x for x in y.collect()}
    assert r[2001].relative_abundance == pytest.approx(round(math.exp((math.log(2) + .5 * math.log(8)) / 1.5), 3)) and r[2001].species_uncertain == 1
    assert s.first().trend == pytest.approx(r[2001].relative_abundance - 1, abs=1e-3)


def test_levene_ks_idw_vif(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", 1.0), ("b", 1.5), ("b", 2.0)], "g string, v double")
    z = {"a": np.abs(np.array([1, 2, 6]) - 2), "b": np.abs(np.array([1, 1.5, 2]) - 1.5)}
    allz = np.concatenate(list(z.values()))
    f = (sum(3 * (v.mean() - allz.mean()) ** 2 for v in z.values()) / 1) / (sum(((v - v.mean()) ** 2).sum() for v in z.values()) / 4)
    r = models.levene(d, "g", "v").first()
    assert r.f_value == pytest.approx(f) and (r.df1, r.df2) == (1, 4)
    o = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 1.0, 3.0)], "lat double, lon double, z double")
    got = {(x.lat, x.lon): x.value for x in models.idw(o, "z", columns=3, rows=3).collect()}
    assert got[(0.0, 0.0)] == 1.0 and got[(1.0, 1.0)] == 3.0 and got[(0.5, 0.5)] == pytest.approx(2) and got[(0.0, 1.0)] == pytest.approx(2)
    with pytest.raises(ValueError):
        models.vif(o, ["lat", "lon"])


def test_rate_model_scores(spark):
    r = np.random.default_rng(8)
    p = pd.DataFrame([("s", a, b, int(r.poisson(3))) for a in "xy" for b in "uv" for _ in range(40)], columns=["sp", "a", "b", "n"])
    d = spark.createDataFrame(p)
    _, fits = models.grouped_glm(d, "n", ["sp"], factors=["a", "b"], family="poisson")
    got = models.rate_models(d, fits, "n", ["sp"], ["a", "b"]).first()
    assert got.complete_plan and got.balanced_plan and got.few_gaps and got.enough_rows and got.rate >= 6
    assert models.overall_rate(spark.createDataFrame([(6.0,), (7.0,)], "rate double")).first().overall == pytest.approx(8.5)


def test_ordination_keeps_distances(spark):
    r = np.random.default_rng(9)
    xy = r.normal(size=(9, 2))
    rows = [(f"p{i}", f"p{j}", float(np.linalg.norm(xy[i] - xy[j]))) for i in range(9) for j in range(i)]
    o = distribution.ordinate(spark.createDataFrame(rows, "a string, b string, distance double"), 2).toPandas().set_index("plot")
    for a, b, d in rows:
        assert np.linalg.norm(o.loc[a] - o.loc[b]) == pytest.approx(d, abs=1e-6)


def test_pca_and_clusters(spark):
    r = np.random.default_rng(10)
    p = pd.DataFrame(np.vstack([r.normal(0, .1, (40, 3)), r.normal(5, .1, (40, 3))]), columns=["a", "b", "c"])
    d = spark.createDataFrame(p)
    s, e, _ = distribution.pca(d, ["a", "b", "c"], 3)
    assert e.toPandas().eigenvalue.sum() == pytest.approx(3) and s.first().cos2_1 <= 1
    sil, k = distribution.choose_k(d, ["a", "b", "c"], 4)
    assert k == 2 and distribution.cluster_sites(d, ["a", "b", "c"], 2).select("cluster").distinct().count() == 2


def test_a_factor_with_many_levels(spark):
    n = 300
    d = spark.range(n * 4).selectExpr(f"concat('s', lpad(cast(id % {n} as string), 4, '0')) as site", f"1 + (id % {n}) % 17 + cast(id / {n} as int) as y")
    co, fits = models.grouped_glm(d, "y", [], factors=["site"], family="poisson")
    got = {r.term: r.estimate for r in co.collect()}
    mean = {i: np.mean([1 + i % 17 + k for k in range(4)]) for i in range(n)}
    assert len(got) == n and got["(Intercept)"] == pytest.approx(np.log(mean[0]))
    assert all(got[f"sites{i:04d}"] == pytest.approx(np.log(mean[i] / mean[0]), abs=1e-6) for i in range(1, n))
    assert fits.first().df_residual == 3 * n
