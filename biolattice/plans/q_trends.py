"""Phenology and population trend queries (T)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import cut_lineage
from ..operators import community, trends as op
from .registry import query
from .views import OBS, observations, table


def _visits(spark, sf):
    """Counts per species, site and date."""
    return (observations(spark, sf).withColumn("species", F.col("kind")).groupBy("species", "site", "date")
            .agg(F.sum("abundance").alias("count")))


VIS = f"""{OBS}, vis AS (SELECT kind AS species, site, year, CAST(dayofyear(date) AS INT) AS dayno, sum(abundance) AS count FROM obs GROUP BY ALL),
season AS (SELECT species, year, min(dayno) AS a, max(dayno) AS z FROM vis GROUP BY ALL),
days AS (SELECT s.species, s.site, s.year, a, z, CAST(unnest(generate_series(make_date(s.year, 1, 1), make_date(s.year, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT DISTINCT species, site, year FROM vis) s JOIN season USING (species, year)),
dn AS (SELECT *, CAST(dayofyear(d) AS INT) AS dayno, CAST(dayofyear(make_date(year, 12, 31)) AS INT) AS nday FROM days),
fl AS (SELECT *, CASE WHEN a - 11 < 1 THEN dayno BETWEEN 1 AND 5 ELSE dayno BETWEEN a - 11 AND a - 7 END
  OR CASE WHEN z + 11 > nday THEN dayno BETWEEN nday - 4 AND nday ELSE dayno BETWEEN z + 7 AND z + 11 END AS anchor FROM dn),
grid AS (SELECT fl.species, fl.site, fl.year, CAST(month(d) AS INT) AS month, CAST(strftime(d, '%W') AS INT) AS week, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_week,
  fl.dayno, CASE WHEN anchor THEN 0 ELSE vis.count END AS count, CAST(anchor AS INT) AS anchor FROM fl LEFT JOIN vis ON vis.species = fl.species AND vis.site = fl.site AND vis.year = fl.year AND vis.dayno = fl.dayno)"""

# a fixed curve shape for the closed-form queries: a hump between days 60 and 305
CURVE = """cv0 AS (SELECT DISTINCT species, year, dayno, CASE WHEN dayno BETWEEN 60 AND 305 THEN (dayno - 59) * (306 - dayno)::DOUBLE ELSE 0 END AS f FROM grid),
cv AS (SELECT species, year, dayno, f / sum(f) OVER (PARTITION BY species, year) AS nm FROM cv0)"""


def _curve(visits):
    d = F.col("dayno")
    last = F.dayofyear(F.make_date("year", F.lit(12), F.lit(31)))
    c = visits.select("species", F.year("date").alias("year")).distinct().withColumn("dayno", F.explode(F.sequence(F.lit(1), last))).withColumn("f", F.when(d.between(60, 305), ((d - 59) * (306 - d)).cast("double")).otherwise(0.0))
    return c.join(c.groupBy("species", "year").agg(F.sum("f").alias("s")), ["species", "year"]).select("species", "year", "dayno", (F.col("f") / F.col("s")).alias("nm"))


@query("day_grid", "T-01", sql=f"WITH {VIS} SELECT species, site, year, month, week, day_week, count(*) AS days, sum(count) AS count, sum(anchor) AS anchor, sum(dayno) AS dayno, sum(day) AS day FROM grid GROUP BY ALL",
       r="count:2", i="site year month week day_week days anchor dayno day")
def day_grid(spark, sf):
    # a weekday of a week is one day of a site's year, and the grid has a row for each: every group is one row, and none is held or moved
    return op.day_grid(_visits(spark, sf)).select("species", "site", "year", "month", "week", "day_week", F.lit(1).cast("long").alias("days"), "count",
                                                  *[F.col(c).cast("long").alias(c) for c in ("anchor", "dayno", "day")])


@query("flight_curve", "T-02")
def flight_curve(spark, sf):
    return op.flight_curve(_visits(spark, sf))


@query("abundance_index", "T-03", sql=f"""WITH {VIS}, {CURVE}, g AS (SELECT grid.*, nm, CASE WHEN nm <> 0 THEN grid.count END AS c FROM grid JOIN cv USING (species, year, dayno)),
lv AS (SELECT species, site, year, sum(c) / sum(nm) AS lev FROM g WHERE c IS NOT NULL AND nm > 0 GROUP BY ALL),
h AS (SELECT g.*, coalesce(c, lev * nm) AS imp, max(CAST(c IS NOT NULL AS INT)) OVER (PARTITION BY g.species, g.site, g.year, g.week) AS seen FROM g LEFT JOIN lv USING (species, site, year)),
k AS (SELECT * FROM h WHERE c IS NOT NULL OR (day_week = 4 AND seen = 0)),
t AS (SELECT species, site, year, (imp + lag(imp) OVER w) / 2 * (dayno - lag(dayno) OVER w) AS ar FROM k WHERE imp IS NOT NULL WINDOW w AS (PARTITION BY species, site, year ORDER BY dayno)),
wk AS (SELECT species, site, year, week, sum(nm) AS s FROM g GROUP BY ALL HAVING count(count) = 0), ps AS (SELECT species, site, year, 1 - sum(s) AS p FROM wk GROUP BY ALL)
SELECT t.species, t.site, t.year, round(coalesce(sum(ar), 0) / 7, 1) AS regional_index, any_value(p) AS prop_pheno_sampled FROM t LEFT JOIN ps USING (species, site, year) GROUP BY ALL""",
       r="regional_index:1 prop_pheno_sampled", i="site year")
def abundance_index(spark, sf):
    v = _visits(spark, sf)
    return op.abundance_index(v, _curve(v))


@query("trapezoid", "T-04", sql=f"""WITH {OBS}, d AS (SELECT species, epoch(date) / 86400 AS x, sum(abundance) AS y FROM obs GROUP BY ALL),
t AS (SELECT species, (y + lag(y) OVER w) / 2 * (x - lag(x) OVER w) AS ar FROM d WINDOW w AS (PARTITION BY species ORDER BY x)) SELECT species, sum(ar) AS area FROM t GROUP BY species""", r="area:2")
def trapezoid(spark, sf):
    d = observations(spark, sf).groupBy("species", F.unix_date("date").alias("x")).agg(F.sum("abundance").alias("y"))
    return op.trapezoid(d, "x", "y", ["species"])


@query("phenology_sampled", "T-05", sql=f"""WITH {VIS}, {CURVE}, wk AS (SELECT species, site, year, week, sum(nm) AS s FROM grid JOIN cv USING (species, year, dayno) GROUP BY ALL HAVING count(count) = 0)
SELECT species, site, year, 1 - sum(s) AS prop_pheno_sampled FROM wk GROUP BY ALL""", r="prop_pheno_sampled", i="site year")
def phenology_sampled(spark, sf):
    v = _visits(spark, sf)
    return op.phenology_sampled(v, _curve(v))


# Every site has a count in every year here, so the fit equals the ratio of yearly totals.
FULL = f"""{OBS}, yr AS (SELECT year, sum(abundance) AS t FROM obs GROUP BY year), ix AS (SELECT year, ln(t / first_value(t) OVER (ORDER BY year)) AS e FROM yr)"""


@query("collated_index", "T-06", sql=f"""WITH {FULL} SELECT 'all' AS species, year, e AS estimate, (e - avg(e) OVER ()) / ln(10) + 2 AS collated_index, true AS converged FROM ix""", r="estimate collated_index", i="year")
def collated_index(spark, sf):
    d = observations(spark, sf).withColumn("species", F.lit("all"))
    return op.collated_index(d, index="abundance")


@query("linear_trend", "T-07", sql=f"""WITH {OBS}, y AS (SELECT species, year, sum(abundance) AS n FROM obs GROUP BY ALL)
SELECT species, regr_slope(n, year) AS slope, regr_intercept(n, year) AS intercept, regr_r2(n, year) AS r2, count(*) AS n,
  sqrt((regr_syy(n, year) - pow(regr_sxy(n, year), 2) / regr_sxx(n, year)) / (count(*) - 2) / regr_sxx(n, year)) AS std_error FROM y GROUP BY species""", r="slope:5 intercept:3 r2 std_error:5", i="n")
def linear_trend(spark, sf):
    d = observations(spark, sf).groupBy("species", "year").agg(F.sum("abundance").alias("index"))
    return op.linear_trend(d, by=["species"]).drop("p_value")


@query("autocorrelation", "T-08", sql=f"""WITH {OBS}, s AS (SELECT kind, epoch(date) / 86400 AS x, sum(abundance) AS v FROM obs GROUP BY ALL),
r AS (SELECT kind, v - avg(v) OVER (PARTITION BY kind) AS c, row_number() OVER (PARTITION BY kind ORDER BY x) AS i FROM s), n AS (SELECT kind, sum(c * c) AS ss, count(*) AS n FROM r GROUP BY kind)
SELECT a.kind, b.i - a.i AS lag, sum(a.c * b.c) / any_value(ss) AS acf, 1.959963984540054 / sqrt(any_value(n)) AS band FROM r a JOIN r b ON a.kind = b.kind AND b.i BETWEEN a.i AND a.i + 5 JOIN n ON n.kind = a.kind GROUP BY ALL""",
       r="acf band", i="lag")
def autocorrelation(spark, sf):
    d = observations(spark, sf).groupBy("kind", F.unix_date("date").alias("x")).agg(F.sum("abundance").alias("v"))
    return op.autocorrelation(d, "v", "x", ["kind"], 5)


@query("annual_variation", "T-09 M-02", sql=f"""WITH {FULL}, n AS (SELECT year, count(DISTINCT site) AS squares, sum(abundance) AS total FROM obs GROUP BY year)
SELECT 'all' AS species, year, exp(e) AS relative_abundance, squares, squares AS squares_occupied, total, true AS converged FROM ix JOIN n USING (year)""", r="relative_abundance total:2", i="year squares squares_occupied")
def annual_variation(spark, sf):
    d = observations(spark, sf).withColumn("species", F.lit("all"))
    return op.annual_variation(d).select("species", "year", "relative_abundance", "squares", "squares_occupied", "total", "converged")


@query("annual_variation_by_species", "T-09")
def annual_variation_by_species(spark, sf):
    return op.annual_variation(observations(spark, sf))


@query("overall_trend", "T-10 T-11 T-12")
def overall_trend(spark, sf):
    d = cut_lineage(observations(spark, sf).groupBy("species", "site", "year").agg(F.sum("abundance").alias("abundance")))
    return op.overall_trend(d)


@query("reliability", "T-11", sql=f"""WITH {OBS}, d AS (SELECT site || '' AS species, max(abundance) / 20 AS a, min(discount) * 50 AS b, count(*) / 40 AS m FROM obs GROUP BY site)
SELECT species, CASE WHEN m < 14 OR a > 2 OR b > 2 THEN 'Incertain' ELSE 'bon' END AS valid, concat_ws(' et ', CASE WHEN m < 14 THEN 'espece trop rare' END, CASE WHEN a > 2 OR b > 2 THEN 'deviance' END) AS reason FROM d""")
def reliability(spark, sf):
    d = observations(spark, sf).groupBy(F.col("site").cast("string").alias("species")).agg(
        (F.max("abundance") / 20).alias("ratio_trend"), (F.min("discount") * 50).alias("ratio_annual"), (F.count(F.lit(1)) / 40).alias("median_occupied"))
    return op.reliability(d).select("species", "valid", "reason")


@query("trend_category", "T-12", sql=f"""WITH {OBS}, d AS (SELECT part, avg(abundance) / 25 AS t, min(tax) AS p, avg(abundance) / 25 - stddev_samp(abundance) / 200 AS lo, avg(abundance) / 25 + stddev_samp(abundance) / 200 AS hi FROM obs GROUP BY part)
SELECT part, CASE WHEN p > 0.05 THEN CASE WHEN lo < 0.95 OR hi > 1.05 THEN 'Incertain' ELSE 'Stable' END WHEN t < 1 THEN CASE WHEN hi < 0.95 THEN 'Fort declin' ELSE 'Declin moderee' END
  WHEN lo > 1.05 THEN 'Forte augmentation' ELSE 'Augmentation modere' END AS category FROM d""", i="part")
def trend_category(spark, sf):
    m, s = F.avg("abundance") / 25, F.stddev_samp("abundance") / 200
    d = observations(spark, sf).groupBy("part").agg(m.alias("t"), F.min("tax").alias("p"), (m - s).alias("lo"), (m + s).alias("hi"))
    return d.select("part", op.trend_category("t", "p", "lo", "hi").alias("category"))


GI = f"""WITH {OBS}, y AS (SELECT species, year, sum(abundance) AS t FROM obs GROUP BY ALL),
a AS (SELECT species, year, t / first_value(t) OVER (PARTITION BY species ORDER BY year) AS r FROM y),
tr AS (SELECT species, count(*) / 100 AS m, CASE WHEN species LIKE '%2%' THEN 'Incertain' ELSE 'bon' END AS valid, length(species) || 'x' AS "group" FROM obs GROUP BY species),
d AS (SELECT a.*, m, valid, "group", CASE WHEN valid = 'bon' THEN 1 WHEN m >= 20 THEN 0.8 WHEN m >= 5 THEN 0.4 WHEN m >= 0 THEN 0.1 END AS w FROM a JOIN tr USING (species)),
n AS (SELECT "group", count(DISTINCT species) FILTER (valid = 'bon') AS species_good, count(DISTINCT species) FILTER (valid <> 'bon') AS species_uncertain FROM d GROUP BY "group"),
g AS (SELECT "group", year, round(exp(sum(w * ln(r)) / sum(w)), 3) AS relative_abundance FROM d GROUP BY ALL)"""


def _group_inputs(spark, sf):
    o = observations(spark, sf)
    y = o.groupBy("species", "year").agg(F.sum("abundance").alias("t"))
    first = y.groupBy("species").agg(F.min_by("t", "year").alias("t0"))
    r = F.col("t") / F.col("t0")
    a = y.join(first, "species").select("species", "year", r.alias("relative_abundance"), r.alias("ci_low"), r.alias("ci_high"))
    tr = o.groupBy("species").agg((F.count(F.lit(1)) / 100).alias("median_occupied")).withColumn("valid", F.when(F.col("species").like("%2%"), "Incertain").otherwise("bon"))
    g = tr.select("species", F.concat(F.length("species").cast("string"), F.lit("x")).alias("group"))
    bias = spark.createDataFrame([(0.0, 0.1), (5.0, 0.4), (20.0, 0.8)], "threshold double, bias double")
    return a, tr, g, bias


@query("group_index", "T-13 O-23", sql=f"""{GI} SELECT g.*, relative_abundance AS ci_low, relative_abundance AS ci_high, species_good, species_uncertain FROM g JOIN n USING ("group")""",
       r="relative_abundance:3 ci_low:3 ci_high:3", i="year species_good species_uncertain")
def group_index(spark, sf):
    return op.group_index(*_group_inputs(spark, sf))[0]


@query("group_trend", "T-13", sql=f"""{GI} SELECT "group", regr_slope(relative_abundance, year) AS trend, species_good, species_uncertain FROM g JOIN n USING ("group") GROUP BY ALL""", r="trend:3", i="species_good species_uncertain")
def group_trend(spark, sf):
    return op.group_index(*_group_inputs(spark, sf))[1].drop("change_percent")


IT = f"""WITH {OBS}, v AS (SELECT site, year, sum(size_class * abundance) / sum(abundance) AS v FROM obs GROUP BY ALL),
d AS (SELECT *, v - avg(v) OVER (PARTITION BY site) AS dv, year - avg(year) OVER (PARTITION BY site) AS dy FROM v)"""


def _trait(spark, sf):
    tr = table(spark, sf, "part").select(F.col("p_partkey").alias("species"), F.col("p_size").alias("cti"))
    return community.community_trait_mean(observations(spark, sf).drop("species").withColumnRenamed("part", "species"), tr, ["cti"])


@query("indicator_trend_yearly", "T-14", sql=f"{IT} SELECT year, avg(dv) + (SELECT avg(v) FROM v) AS mean, stddev_samp(dv) / sqrt(count(*)) AS std_error, count(*) AS n FROM d GROUP BY year", r="mean std_error", i="year n")
def indicator_trend_yearly(spark, sf):
    return op.indicator_trend(_trait(spark, sf), "cti")[0]


@query("indicator_trend_linear", "T-14", sql=f"""{IT} SELECT sum(dv * dy) / sum(dy * dy) AS slope, sqrt((sum(dv * dv) - pow(sum(dv * dy), 2) / sum(dy * dy)) / (count(*) - count(DISTINCT site) - 1) / sum(dy * dy)) AS std_error, count(*) AS n FROM d""",
       r="slope std_error", i="n")
def indicator_trend_linear(spark, sf):
    return op.indicator_trend(_trait(spark, sf), "cti")[1].drop("p_value")


@query("back_transform", "T-15", sql=f"""WITH {OBS} SELECT part, exp(avg(discount)) AS a, exp(avg(tax) - 0.05) AS b FROM obs GROUP BY part""", r="a b", i="part")
def back_transform(spark, sf):
    d = observations(spark, sf).groupBy("part").agg(F.avg("discount").alias("a"), (F.avg("tax") - 0.05).alias("b"))
    return op.back_transform(d, "quasipoisson", ["a", "b"])
