"""Model and test queries (M)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import cut_lineage
from ..operators import boosting, distribution as dist, models as op
from .registry import query
from .views import OBS, PIX, SIGHTINGS, STATIONS, observations, pixels, sightings, stations, table


@query("glm_gaussian", "M-01", sql=f"""WITH {OBS}, f AS (SELECT species, regr_slope(biomass, abundance) AS s, regr_intercept(biomass, abundance) AS i, regr_sxx(biomass, abundance) AS xx, regr_syy(biomass, abundance) AS yy,
  regr_sxy(biomass, abundance) AS xy, count(*) AS n, avg(abundance) AS mx FROM obs GROUP BY species), g AS (SELECT *, (yy - xy * xy / xx) / (n - 2) AS phi FROM f)
SELECT species, 'abundance' AS term, s AS estimate, sqrt(phi / xx) AS std_error FROM g UNION ALL SELECT species, '(Intercept)', i, sqrt(phi * (1.0::DOUBLE / n + mx * mx / xx)) FROM g""", r="estimate:4 std_error:4")
def glm_gaussian(spark, sf):
    c, _ = op.grouped_glm(observations(spark, sf), "biomass", ["species"], numeric=["abundance"], family="gaussian")
    return c.select("species", "term", "estimate", "std_error")


@query("glm_poisson", "M-01", sql=f"""WITH {OBS}, m AS (SELECT year, kind, avg(abundance) AS m, sum(abundance) AS t FROM obs GROUP BY ALL), b AS (SELECT * FROM m WHERE kind = 'ECONOMY')
SELECT m.year, CASE WHEN m.kind = 'ECONOMY' THEN '(Intercept)' ELSE 'kind' || m.kind END AS term, CASE WHEN m.kind = 'ECONOMY' THEN ln(m.m) ELSE ln(m.m / b.m) END AS estimate,
  CASE WHEN m.kind = 'ECONOMY' THEN sqrt(1 / m.t) ELSE sqrt(1 / m.t + 1 / b.t) END AS std_error FROM m JOIN b USING (year)""", r="estimate:5 std_error:5", i="year")
def glm_poisson(spark, sf):
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    c, _ = op.grouped_glm(observations(spark, sf), "abundance", ["year"], factors={"kind": kinds}, family="poisson")
    return c.filter("estimate IS NOT NULL").select("year", "term", "estimate", "std_error")


@query("glm_binomial", "M-01", sql=f"""WITH {OBS}, m AS (SELECT kind, sum(CAST(discount > 0.05 AS INT)) AS a, sum(CAST(discount <= 0.05 AS INT)) AS b FROM obs GROUP BY kind)
SELECT kind, ln(a / b::DOUBLE) AS logit, sqrt(1.0::DOUBLE / a + 1.0::DOUBLE / b) AS std_error FROM m""", r="logit:5 std_error:5")
def glm_binomial(spark, sf):
    d = observations(spark, sf).withColumn("presence", (F.col("discount") > 0.05).cast("int"))
    c, _ = op.grouped_glm(d, "presence", ["kind"], family="binomial")
    return c.select("kind", F.col("estimate").alias("logit"), "std_error")


@query("glm_year", "M-01")
def glm_year(spark, sf):
    d = observations(spark, sf).withColumn("y", F.col("year") - 1995)
    _, fits = op.grouped_glm(d, "abundance", ["species"], numeric=["y"], factors={"kind": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}, family="quasipoisson")
    return fits


@query("two_way_loglinear", "M-02")
def two_way_loglinear(spark, sf):
    f = op.two_way_loglinear(observations(spark, sf), ["species"], count="abundance")
    return f.select("species", "n_obs", "n_sites", "df_residual", "dispersion", "deviance", "null_deviance", "converged")


@query("choose_family", "M-03", sql=f"""WITH {OBS}, m AS (SELECT count(*) AS n, avg(CASE WHEN discount > 0.05 THEN 1.0 ELSE 0.0 END::DOUBLE) AS p, avg(size_class) AS z, avg(abundance) AS a, stddev_samp(abundance) AS s FROM obs)
SELECT 'presence_absence' AS metric, 'binomial' AS family, n, ln(p / (1 - p)) AS estimate, sqrt(1 / (n * p * (1 - p))) AS std_error FROM m
UNION ALL SELECT 'size_class', 'poisson', n, ln(z), sqrt(1 / (n * z)) FROM m UNION ALL SELECT 'abundance', 'gaussian', n, a, s / sqrt(n) FROM m""", r="estimate std_error", i="n")
def choose_family(spark, sf):
    d = cut_lineage(observations(spark, sf).withColumn("presence_absence", (F.col("discount") > 0.05).cast("int")).select("presence_absence", "size_class", "abundance"))
    out = None
    for m in d.columns:
        family = op.choose_family(d, m)
        co, fits = op.grouped_glm(d, m, [], family=family)
        one = co.select(F.lit(m).alias("metric"), F.lit(family).alias("family"), fits.select("n").scalar().alias("n"), "estimate", "std_error")
        out = one if out is None else out.union(one)
    return out


@query("rate_models", "M-04")
def rate_models(spark, sf):
    d = cut_lineage(observations(spark, sf).select("species", "kind", "year", "abundance"))
    _, fits = op.grouped_glm(d, "abundance", ["species"], factors={"kind": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}, family="poisson")
    return op.rate_models(d, fits, "abundance", ["species"], ["kind", "year"])


def _environment(spark, sf):
    p = pixels(spark, sf)
    return p.select("row", "col", *[(F.col(b) / 1000).alias(b.lower()) for b in ("B2", "B3", "B4", "B8")],
                    ((F.col("B8") + F.col("B4") + F.col("code") * 100) % 3000 > 1500).cast("int").alias("presence"))


@query("species_distribution", "M-05")
def species_distribution(spark, sf):
    d = cut_lineage(_environment(spark, sf).withColumn("sp", F.lit("site")))
    pred, ev = boosting.species_distribution(d, d.drop("presence", "sp"), ["b2", "b3", "b4", "b8"], species="sp")
    return pred.join(ev, "sp")


@query("cluster_sites", "M-06")
def cluster_sites(spark, sf):
    d = dist.cluster_sites(cut_lineage(_environment(spark, sf)), ["b2", "b3", "b4", "b8"], 5)
    return d.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("choose_k", "M-06")
def choose_k(spark, sf):
    return dist.choose_k(cut_lineage(_environment(spark, sf)), ["b2", "b4", "b8"], 4)[0]


@query("pca_scores", "M-07")
def pca_scores(spark, sf):
    return dist.pca(cut_lineage(_environment(spark, sf)).drop("presence"), ["b2", "b3", "b4", "b8"], 2)[0]


@query("pca_eigenvalues", "M-07", sql=f"""WITH {PIX}, c AS (SELECT corr(B2, B8) AS r FROM pix) SELECT 1 AS component, 1 + abs(r) AS eigenvalue, (1 + abs(r)) / 2 AS share FROM c UNION ALL SELECT 2, 1 - abs(r), (1 - abs(r)) / 2 FROM c""",
       r="eigenvalue share", i="component")
def pca_eigenvalues(spark, sf):
    return dist.pca(cut_lineage(_environment(spark, sf)), ["b2", "b8"], 2)[1]


@query("correlation_matrix", "M-08", sql=f"""WITH {OBS} SELECT 'abundance' AS var_a, 'biomass' AS var_b, corr(abundance, biomass) AS r, count(*) AS n FROM obs UNION ALL SELECT 'abundance', 'size_class', corr(abundance, size_class), count(*) FROM obs
UNION ALL SELECT 'biomass', 'size_class', corr(biomass, size_class), count(*) FROM obs""", r="r", i="n")
def correlation_matrix(spark, sf):
    return op.correlation_matrix(observations(spark, sf), ["abundance", "biomass", "size_class"]).drop("p_value")


@query("vif", "M-09", sql=f"WITH {OBS}, c AS (SELECT corr(abundance, biomass) AS r FROM obs) SELECT unnest(['abundance', 'biomass']) AS variable, 1 / (1 - r * r) AS vif FROM c", r="vif")
def vif(spark, sf):
    return op.vif(observations(spark, sf), ["abundance", "biomass"])


@query("levene", "M-10", sql=f"""WITH {OBS}, m AS (SELECT kind, median(biomass) AS md FROM obs GROUP BY kind), z AS (SELECT kind, abs(biomass - md) AS z FROM obs JOIN m USING (kind)),
g AS (SELECT kind, count(*) AS n, avg(z) AS a, var_pop(z) AS v FROM z GROUP BY kind), t AS (SELECT count(*) AS k, sum(n) AS nn, sum(n * v) AS w, sum(n * a) AS s, sum(n * a * a) AS q FROM g)
SELECT k - 1 AS df1, nn - k AS df2, ((q - s * s / nn) / (k - 1)) / (w / (nn - k)) AS f_value FROM t""", r="f_value", i="df1 df2")
def levene(spark, sf):
    return op.levene(observations(spark, sf), "kind", "biomass").drop("p_value")


@query("ks_normal", "M-11", sql=f"""WITH {OBS}, r AS (SELECT (abundance - 25) / 15 AS x, count(*) AS c FROM obs GROUP BY ALL),
k AS (SELECT x, CAST(sum(c) OVER (ORDER BY x) AS DOUBLE) / sum(c) OVER () AS hi, CAST(sum(c) OVER (ORDER BY x) - c AS DOUBLE) / sum(c) OVER () AS lo,
  0.5 + list_sum([pow(-1, j) * pow(x, 2 * j + 1) / (pow(2, j) * gamma(j + 1) * (2 * j + 1)) FOR j IN range(0, 40)]) / sqrt(2 * pi()) AS f FROM r)
SELECT max(greatest(hi - f, f - lo)) AS statistic FROM k""", r="statistic")
def ks_normal(spark, sf):
    return dist.ks_normal(observations(spark, sf).select(((F.col("abundance") - 25) / 15).alias("x")), "x").select("statistic")


@query("ks_statistic", "M-11")
def ks_statistic(spark, sf):
    return dist.ks_normal(observations(spark, sf).select(((F.col("abundance") - 25) / 15).alias("x")), "x")


@query("median_and_dispersion", "M-12", sql=f"""WITH {OBS}, q AS (SELECT species, quantile_cont(biomass, 0.25) AS q1, quantile_cont(biomass, 0.5) AS median, quantile_cont(biomass, 0.75) AS q3 FROM obs GROUP BY species),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q) SELECT b.*, (SELECT count(*) FROM obs o WHERE o.species = b.species AND (biomass < low OR biomass > high)) AS outliers FROM b""",
       r="q1:5 median:5 q3:5 low:5 high:5", i="outliers")
def median_and_dispersion(spark, sf):
    return op.median_and_dispersion(observations(spark, sf), "biomass")


@query("idw", "M-13", sql=f"""WITH {STATIONS}, e AS (SELECT min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n FROM stations), g AS (SELECT i, w + (i % 10) * ((e - w) / 9) AS gx, s + (i // 10) * ((n - s) / 9) AS gy FROM e, range(0, 100) r(i)),
d AS (SELECT i, gx, gy, reading AS v, pow(lon - gx, 2) + pow(lat - gy, 2) AS d2 FROM stations CROSS JOIN g)
SELECT gx AS lon, gy AS lat, coalesce(avg(CASE WHEN d2 = 0 THEN v END), sum(CASE WHEN d2 > 0 THEN v / d2 END) / sum(CASE WHEN d2 > 0 THEN 1 / d2 END)) AS value FROM d GROUP BY i, gx, gy""", r="lon lat value:5")
def idw(spark, sf):
    return op.idw(stations(spark, sf), "reading")


@query("iqr_outliers", "M-14", sql=f"""WITH {OBS}, q AS (SELECT quantile_cont(biomass, 0.25) AS a, quantile_cont(biomass, 0.75) AS b FROM obs) SELECT a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high FROM q""", r="low:4 high:4")
def iqr_outliers(spark, sf):
    return op.iqr_outliers(observations(spark, sf), "biomass")
