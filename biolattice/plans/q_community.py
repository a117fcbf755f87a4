"""Community, diversity and dissimilarity queries (O)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import community as op, coverage, permutation
from .registry import query
from .views import DET, OBS, PIX, SIGHTINGS, detections, observations, pixels, sightings, table

PER = f"""WITH {OBS}, per AS (SELECT site, year, species, sum(abundance) AS n FROM obs GROUP BY ALL),
tot AS (SELECT site, year, sum(n) AS t FROM per GROUP BY ALL), p AS (SELECT per.*, t, n / t AS p FROM per JOIN tot USING (site, year))"""


@query("community_metrics", "O-03 O-07", sql=f"""{PER}
SELECT site, year, sum(n) AS number, count(*) AS species_richness, sum(p * p) AS simpson, 1 - sum(p * p) AS simpson_l,
  -sum(p * ln(p)) AS shannon, CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) END AS pielou,
  (1 - sum(p * p)) / exp(-sum(p * ln(p))) AS hill FROM p GROUP BY site, year""",
       r="number:2 simpson simpson_l shannon pielou hill", d=10, i="site year species_richness")
def community_metrics(spark, sf):
    return op.community_metrics(observations(spark, sf), ["site", "year"], "species", "abundance")


@query("community_matrix", "O-01", sql=f"""WITH {OBS}
SELECT site, year, {', '.join(f"coalesce(sum(CASE WHEN kind = '{k}' THEN abundance END), 0) AS {k.lower()}" for k in
                              ('ECONOMY', 'SMALL', 'MEDIUM', 'PROMO', 'STANDARD', 'LARGE'))}
FROM obs GROUP BY site, year""", r="economy:2 small:2 medium:2 promo:2 standard:2 large:2", i="site year")
def community_matrix(spark, sf):
    m = op.to_community_matrix(observations(spark, sf), ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE"], species="kind")
    return m.toDF(*[c.lower() for c in m.columns])


@query("community_long", "O-01", sql=f"""WITH {OBS}, m AS (SELECT DISTINCT site, year FROM obs), k AS (SELECT DISTINCT kind FROM obs)
SELECT m.site, m.year, k.kind AS species, coalesce(sum(abundance), 0) AS abundance FROM m CROSS JOIN k
LEFT JOIN obs o ON o.site = m.site AND o.year = m.year AND o.kind = k.kind GROUP BY ALL""", r="abundance:2", i="site year")
def community_long(spark, sf):
    m = op.to_community_matrix(observations(spark, sf), ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE"], species="kind")
    return op.to_long(m)


@query("complete_absences", "O-02", sql=f"""WITH {OBS}, u AS (SELECT DISTINCT site FROM obs), s AS (SELECT DISTINCT size_class FROM obs)
SELECT u.site AS unit, s.size_class AS species, coalesce(sum(abundance), 0) AS abundance FROM u CROSS JOIN s
LEFT JOIN obs o ON o.site = u.site AND o.size_class = s.size_class GROUP BY ALL""", r="abundance:2", i="unit species")
def complete_absences(spark, sf):
    d = observations(spark, sf).select(F.col("site").alias("unit"), F.col("size_class").alias("species"), "abundance")
    return op.complete_absences(d)


@query("abundance", "O-03", sql=f"""WITH {OBS} SELECT site, species, coalesce(sum(CASE WHEN discount > 0.02 THEN abundance END), 0) AS number
FROM obs GROUP BY ALL""", r="number:2", i="site")
def abundance(spark, sf):
    d = observations(spark, sf).withColumn("number", F.when(F.col("discount") > 0.02, F.col("abundance")))
    return op.abundance(d, ["site", "species"])


@query("rotation_abundance", "O-04", sql=f"""WITH {OBS}, valid AS (SELECT DISTINCT site AS u, rotation AS r FROM obs),
cells AS (SELECT DISTINCT site AS u, species FROM obs),
rot AS (SELECT c.u, c.species, v.r, coalesce(sum(o.abundance), 0) AS n FROM cells c JOIN valid v ON v.u = c.u
  LEFT JOIN obs o ON o.site = c.u AND o.species = c.species AND o.rotation = v.r GROUP BY ALL)
SELECT u AS observation_unit, species, avg(n) AS number, max(n) AS number_max, stddev_samp(n) AS number_sd, count(*) AS rotations
FROM rot GROUP BY ALL""", r="number number_max number_sd", i="observation_unit rotations")
def rotation_abundance(spark, sf):
    d = observations(spark, sf).select(F.col("site").alias("observation_unit"), "species", "rotation", F.col("abundance").alias("number"))
    return op.rotation_abundance(d, ["observation_unit", "species"])


@query("aggregate_metric", "O-05", sql=f"""WITH {OBS}, d AS (SELECT *, CASE WHEN discount > 0.01 THEN size_class END AS len FROM obs),
rot AS (SELECT site, species, rotation, sum(abundance) AS n FROM obs GROUP BY ALL),
r2 AS (SELECT site, species, max(n) AS number_max, stddev_samp(n) AS number_sd FROM rot GROUP BY ALL)
SELECT d.site, d.species, sum(biomass) AS biomass, sum(len * abundance) / sum(CASE WHEN len IS NOT NULL THEN abundance END) AS mean_length,
  max(CAST(len > 25 AS INTEGER)) AS presence, any_value(number_max) AS number_max, any_value(number_sd) AS number_sd
FROM d JOIN r2 ON r2.site = d.site AND r2.species = d.species GROUP BY d.site, d.species""",
       r="biomass:2 mean_length number_max number_sd", i="site presence")
def aggregate_metric(spark, sf):
    d = observations(spark, sf).withColumn("mean.length", F.when(F.col("discount") > 0.01, F.col("size_class"))).withColumnRenamed("abundance", "number")
    d = d.withColumnRenamed("mean.length", "mean_length").withColumn("presence", F.col("mean_length") - 25)
    k = ["site", "species"]
    parts = [op.aggregate_metric(d, "biomass", k), op.aggregate_metric(d, "mean_length", k, rule="w.mean"),
             op.aggregate_metric(d, "presence", k, rule="pres"), op.aggregate_metric(d, "number_max", k, rule="nbMax"),
             op.aggregate_metric(d, "number_sd", k, rule="nbSD")]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, k)
    return out


@query("size_class_share", "O-05", sql=f"""WITH {OBS}, u AS (SELECT site, species, size_class // 10 AS sc, sum(abundance) AS n FROM obs GROUP BY ALL),
t AS (SELECT site, species, sum(n) AS tot FROM u GROUP BY ALL)
SELECT u.site, u.sc AS size_class, sum(n) / sum(tot) * 100 AS abundance_share FROM u JOIN t USING (site, species) GROUP BY ALL""",
       r="abundance_share", i="site size_class")
def size_class_share(spark, sf):
    u = (observations(spark, sf).groupBy("site", "species", F.floor(F.col("size_class") / 10).alias("size_class"))
         .agg(F.sum("abundance").alias("number")))
    t = u.groupBy("site", "species").agg(F.sum("number").alias("number_total"))
    d = u.join(t, ["site", "species"]).withColumn("abundance_share", F.col("number") / F.col("number_total"))
    return op.aggregate_metric(d, "abundance_share", ["site", "size_class"], rule="w.mean.prop")


@query("presence_absence", "O-06", sql=f"""WITH {OBS} SELECT site, species, sum(CASE WHEN discount > 0.05 THEN abundance ELSE 0 END) AS number,
  CAST(sum(CASE WHEN discount > 0.05 THEN abundance ELSE 0 END) > 0 AS INTEGER) AS presence_absence FROM obs GROUP BY ALL""",
       r="number:2", i="site presence_absence")
def presence_absence(spark, sf):
    d = observations(spark, sf).withColumn("number", F.when(F.col("discount") > 0.05, F.col("abundance")).otherwise(0.0))
    return op.presence_absence(op.abundance(d, ["site", "species"]))


ES = "sum(1 - coalesce(list_reduce(list_prepend(1.0::DOUBLE, [CASE WHEN n0 - n >= 50 THEN (n0 - n - j) / (n0 - j) ELSE 0 END FOR j IN range(0, 50)]), lambda x, y: x * y), 0))"


@query("grid_indicators", "O-08 O-09", sql=f"""WITH {SIGHTINGS}, s2 AS (SELECT c_custkey AS k, o_orderpriority AS species FROM customer JOIN orders ON o_custkey = c_custkey),
c AS (SELECT CAST(floor((sin(radians(lat)) + 1) / 2 * (360.0 / 20.0 / pi())) AS BIGINT) || ':' || CAST(floor((lon + 180) / 20.0) AS BIGINT) AS cell, s2.species
  FROM sightings JOIN s2 ON s2.k = sighting_id),
t AS (SELECT cell, species, CAST(count(*) AS DOUBLE) AS n FROM c GROUP BY ALL), tot AS (SELECT cell, sum(n) AS n0 FROM t GROUP BY ALL),
p AS (SELECT t.*, n0, n / n0 AS p FROM t JOIN tot USING (cell))
SELECT cell, n0 AS n, count(*) AS sp, -sum(p * ln(p)) AS shannon, sum(p * p) AS simpson, max(p) AS maxp,
  CASE WHEN n0 >= 50 THEN {ES} END AS es, exp(-sum(p * ln(p))) AS hill_1, 1 / sum(p * p) AS hill_2, 1 / max(p) AS hill_inf
FROM p GROUP BY cell, n0""", r="n:2 shannon simpson maxp es:8 hill_1 hill_2 hill_inf", d=10, i="sp")
def grid_indicators(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("sighting_id"), F.col("o_orderpriority").alias("kind"))
    d = op.assign_cell(sightings(spark, sf).drop("species"), 20.0).join(o, "sighting_id").withColumn("one", F.lit(1))
    return op.grid_indicators(d, species="kind", records="one", esn=50)


@query("equal_area_cell", "O-09", sql=f"""WITH {SIGHTINGS}
SELECT sighting_id, CAST(floor((sin(radians(lat)) + 1) / 2 * (360.0 / 7.0 / pi())) AS BIGINT) || ':' || CAST(floor((lon + 180) / 7.0) AS BIGINT) AS cell
FROM sightings""", i="sighting_id")
def equal_area_cell(spark, sf):
    return op.assign_cell(sightings(spark, sf), 7.0).select("sighting_id", "cell")


@query("species_diversity", "O-10", sql=f"""{PER}
SELECT site, year, count(*) AS richness, 1 - sum(p * p) AS gini_simpson, sum(p * p) AS simpson, -sum(p * ln(p)) AS shannon,
  (count(*) - 1) / ln(sum(n)) AS margalef, count(*) / sqrt(sum(n)) AS menhinick,
  (sum(n) - sqrt(sum(n * n))) / (sum(n) - sqrt(sum(n))) AS mcintosh FROM p GROUP BY site, year""",
       r="gini_simpson simpson shannon margalef menhinick mcintosh", d=10, i="site year richness")
def species_diversity(spark, sf):
    return op.species_diversity(observations(spark, sf), ["site", "year"], number="abundance")


@query("parametric_diversity", "O-11", sql=f"""{PER}, q AS (SELECT unnest([0, 0.25, 0.5, 1, 2, 4, 8])::DOUBLE AS q)
SELECT site, q, CASE WHEN q = 1 THEN exp(-sum(p * ln(p))) ELSE pow(sum(pow(p, q)), 1 / (CASE WHEN q = 1 THEN 0.5 ELSE 1 - q END)) END AS diversity
FROM (SELECT site, species, sum(n) / any_value(st) AS p FROM p JOIN (SELECT site, sum(n) AS st FROM p GROUP BY ALL) USING (site) GROUP BY site, species)
CROSS JOIN q GROUP BY site, q""", r="q diversity", i="site")
def parametric_diversity(spark, sf):
    return op.parametric_diversity(observations(spark, sf), ["site"], number="abundance")


@query("turned_block_score", "O-12", sql=f"""WITH q AS (SELECT l_suppkey AS site, CAST(year(l_shipdate) AS INTEGER) AS year,
  l_linenumber - 1 AS turned, CAST(l_quantity AS BIGINT) % 4 AS unturned FROM lineitem),
k AS (SELECT *, turned * 100.0::DOUBLE / (turned + unturned) AS share FROM q WHERE NOT (turned = 0 AND unturned = 0)),
s AS (SELECT *, CASE WHEN share < 5 THEN 0 WHEN share < 25 THEN 1 WHEN share < 45 THEN 2 WHEN share < 65 THEN 3 WHEN share < 85 THEN 4 ELSE 5 END AS score,
  100 - share AS rest FROM k)
SELECT site, year, {', '.join(f"{f}({c}) AS {c}_{n}" for c in ('score', 'share', 'rest') for f, n in
                              (('avg', 'mean'), ('stddev_samp', 'sd'), ('min', 'min'), ('max', 'max'), ('median', 'median')))}, count(*) AS n
FROM s GROUP BY site, year""", r=" ".join(f"{c}_{n}" for c in ("score", "share", "rest") for n in ("mean", "sd", "min", "max", "median")), i="site year n")
def turned_block_score(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("site"), F.year("l_shipdate").alias("year"),
                                            (F.col("l_linenumber") - 1).alias("turned"), (F.col("l_quantity").cast("long") % 4).alias("unturned"))
    return op.turned_block_score(l, ["site", "year"])


@query("rarefaction", "O-13", sql=f"""WITH {OBS}, t AS (SELECT site, kind, CAST(count(*) AS DOUBLE) AS n FROM obs GROUP BY ALL),
tot AS (SELECT site, sum(n) AS n0 FROM t GROUP BY ALL), m AS (SELECT site, n0, unnest(range(1, CAST(n0 AS BIGINT) + 1, 10)) AS m FROM tot)
SELECT site, m AS sample_size, sum(1 - CASE WHEN n0 - n >= m THEN exp(lgamma(n0 - n + 1) - lgamma(n0 - n - m + 1) - lgamma(n0 + 1) + lgamma(n0 - m + 1)) ELSE 0 END) AS expected_species
FROM t JOIN m USING (site) GROUP BY site, m""", r="expected_species", i="site sample_size")
def rarefaction(spark, sf):
    d = observations(spark, sf).withColumn("one", F.lit(1))
    return op.rarefy(d, unit=["site"], species="kind", number="one", step=10)


@query("location_summary", "O-14", sql=f"""WITH {SIGHTINGS} SELECT nation, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
  count(DISTINCT sighting_id) AS locations, count(DISTINCT species) AS species FROM sightings GROUP BY nation""",
       r="lat_min lat_max lon_min lon_max", i="nation locations species")
def location_summary(spark, sf):
    return op.location_summary(sightings(spark, sf), ["nation"], location="sighting_id")


HEL = f"""WITH {OBS}, t AS (SELECT site, species, sum(abundance) AS n FROM obs GROUP BY ALL),
y0 AS (SELECT site, species, sqrt(n / sum(n) OVER (PARTITION BY site)) AS y FROM t),
y AS (SELECT s.site, k.species, coalesce(y0.y, 0) AS y FROM (SELECT DISTINCT site FROM t) s CROSS JOIN (SELECT DISTINCT species FROM t) k
  LEFT JOIN y0 ON y0.site = s.site AND y0.species = k.species),
d AS (SELECT site, species, pow(y - avg(y) OVER (PARTITION BY species), 2) AS ss FROM y)"""


@query("beta_diversity_total", "O-15", sql=f"""{HEL} SELECT sum(ss) AS ss_total, sum(ss) / (count(DISTINCT site) - 1) AS bd_total FROM d""",
       r="ss_total bd_total:8")
def beta_total(spark, sf):
    return op.beta_diversity(observations(spark, sf), number="abundance")[0]


@query("lcbd", "O-15", sql=f"{HEL} SELECT site, sum(ss) / (SELECT sum(ss) FROM d) AS lcbd FROM d GROUP BY site", r="lcbd:9", i="site")
def lcbd(spark, sf):
    return op.beta_diversity(observations(spark, sf), number="abundance")[1]


@query("scbd", "O-15", sql=f"""{HEL}, s AS (SELECT species, sum(ss) / (SELECT sum(ss) FROM d) AS scbd FROM d GROUP BY species)
SELECT species, scbd, scbd >= (SELECT avg(scbd) FROM s) AS above_mean FROM s""", r="scbd:9")
def scbd(spark, sf):
    return op.beta_diversity(observations(spark, sf), number="abundance")[2]


@query("lcbd_permutation", "O-16")
def lcbd_permutation(spark, sf):
    return permutation.lcbd_permutation(observations(spark, sf), seed=7, number="abundance")


@query("lcbd_over_time", "O-17", sql=f"""WITH {OBS}, t AS (SELECT site || '-' || year AS unit, year, species, sum(abundance) AS n FROM obs GROUP BY ALL),
y0 AS (SELECT unit, year, species, sqrt(n / sum(n) OVER (PARTITION BY unit)) AS y FROM t),
y AS (SELECT s.unit, s.year, k.species, coalesce(y0.y, 0) AS y FROM (SELECT DISTINCT unit, year FROM t) s CROSS JOIN (SELECT DISTINCT species FROM t) k
  LEFT JOIN y0 ON y0.unit = s.unit AND y0.species = k.species),
d AS (SELECT unit, year, pow(y - avg(y) OVER (PARTITION BY species), 2) AS ss FROM y),
l AS (SELECT unit, year, sum(ss) / (SELECT sum(ss) FROM d) AS lcbd FROM d GROUP BY ALL)
SELECT year, avg(lcbd) AS lcbd_mean, stddev_samp(lcbd) AS lcbd_sd FROM l GROUP BY year""", r="lcbd_mean:9 lcbd_sd:9", i="year")
def lcbd_over_time(spark, sf):
    d = observations(spark, sf).withColumn("unit", F.concat_ws("-", "site", "year"))
    l = op.beta_diversity(d, site="unit", number="abundance")[1]
    return op.lcbd_over(l.withColumn("year", F.split_part("unit", F.lit("-"), F.lit(2)).cast("int")), ["year"])


BC = f"""WITH {OBS}, t AS (SELECT visit, rotation, rotation % 2 AS block, kind AS species, sqrt(sum(abundance)) AS v FROM obs GROUP BY visit, rotation, kind),
s AS (SELECT visit, rotation, block, sum(v) AS tt FROM t GROUP BY ALL),
pr AS (SELECT a.visit, a.rotation AS ra, b.rotation AS rb, a.tt + b.tt AS den FROM s a JOIN s b ON a.visit = b.visit AND a.rotation < b.rotation AND a.block <> b.block),
sh AS (SELECT a.visit, a.rotation AS ra, b.rotation AS rb, sum(least(a.v, b.v)) AS m FROM t a JOIN t b ON a.visit = b.visit AND a.species = b.species AND a.rotation < b.rotation GROUP BY ALL),
bc AS (SELECT pr.visit, pr.ra, pr.rb, 1 - 2 * coalesce(m, 0) / den AS dissimilarity FROM pr LEFT JOIN sh ON sh.visit = pr.visit AND sh.ra = pr.ra AND sh.rb = pr.rb)"""


def _bc(spark, sf):
    d = observations(spark, sf).withColumn("block", F.col("rotation") % 2)
    return op.bray_curtis(d, ["visit"], "rotation", "kind", "abundance", differ="block")


@query("bray_curtis", "O-18 J-13", sql=f"{BC} SELECT visit, ra AS rotation_a, rb AS rotation_b, dissimilarity FROM bc", r="dissimilarity", i="visit rotation_a rotation_b")
def bray_curtis(spark, sf):
    return _bc(spark, sf).select("visit", "rotation_a", "rotation_b", "dissimilarity")


@query("dissimilarity_summary", "O-19", sql=f"""{BC} SELECT ra AS rotation_a, avg(dissimilarity) AS mean, stddev_samp(dissimilarity) AS sd, min(dissimilarity) AS min,
  max(dissimilarity) AS max, count(*) AS n, count(dissimilarity) AS n_value, median(dissimilarity) AS median FROM bc GROUP BY ra""",
       r="mean sd min max median", i="rotation_a n n_value")
def dissimilarity_summary(spark, sf):
    return op.dissimilarity_summary(_bc(spark, sf), ["rotation_a"])


@query("quartile_class_means", "O-19", sql=f"""{BC}, q AS (SELECT quantile_cont(dissimilarity, 0.25) AS a, quantile_cont(dissimilarity, 0.5) AS b, quantile_cont(dissimilarity, 0.75) AS c FROM bc)
SELECT CASE WHEN dissimilarity <= a THEN 1 WHEN dissimilarity <= b THEN 2 WHEN dissimilarity <= c THEN 3 ELSE 4 END AS quartile, avg(dissimilarity) AS threshold
FROM bc, q GROUP BY 1""", r="threshold:4", i="quartile")
def quartile_class_means(spark, sf):
    d = _bc(spark, sf)
    return op.quartile_class_means(d)


INDVAL = f"""WITH {OBS}, c AS (SELECT site, site % 4 AS cluster, species, sum(CASE WHEN discount > 0.09 THEN abundance ELSE 0 END) AS n FROM obs GROUP BY ALL),
z AS (SELECT cluster, count(DISTINCT site) AS size FROM c GROUP BY ALL),
g AS (SELECT species, c.cluster, sum(n) / any_value(size) AS m, count(*) FILTER (n > 0) / any_value(size)::DOUBLE AS fid FROM c JOIN z ON z.cluster = c.cluster GROUP BY species, c.cluster HAVING sum(n) > 0)"""


@query("indicator_values", "O-20", sql=f"""{INDVAL} SELECT species, cluster, m / sum(m) OVER (PARTITION BY species) AS specificity, fid AS fidelity,
  sqrt(m / sum(m) OVER (PARTITION BY species) * fid) AS indval FROM g""", r="specificity fidelity indval", i="cluster")
def indicator_values(spark, sf):
    d = observations(spark, sf).withColumn("cluster", F.col("site") % 4)
    d = d.withColumn("abundance", F.when(F.col("discount") > 0.09, F.col("abundance")).otherwise(0.0))
    return permutation.indicator_values(d, number="abundance")


@query("indicator_species", "O-20")
def indicator_species(spark, sf):
    d = observations(spark, sf).withColumn("cluster", F.col("site") % 4)
    return permutation.indicator_species(d, reps=999, seed=3, number="abundance")


def _ratios(spark, sf):
    d = observations(spark, sf).groupBy(F.col("site").alias("region"), F.col("kind").alias("category"), F.col("year").alias("period")).agg(
        F.avg("abundance").alias("mean"), (1.96 * F.stddev_samp("abundance") / F.sqrt(F.count(F.lit(1)))).alias("half_width"))
    d = d.filter("half_width > 0")
    return permutation.geometric_mean_uncertainty(d, reps=10000, seed=5, reference=F.lit(1995))


@query("geometric_mean_uncertainty", "O-21")
def geometric_mean_uncertainty(spark, sf):
    return _ratios(spark, sf)[1]


@query("geometric_mean_by_region", "O-21")
def geometric_mean_by_region(spark, sf):
    return _ratios(spark, sf)[0]


@query("evolution_rate", "O-22", sql=f"""WITH {OBS}, v AS (SELECT kind, year, avg(abundance) AS v FROM obs WHERE year IN (1995, 1999) GROUP BY ALL)
SELECT kind, round_even(avg(CASE WHEN year = 1995 THEN v END), 0) AS before, round_even(avg(CASE WHEN year = 1999 THEN v END), 0) AS after,
  round_even(avg(CASE WHEN year = 1999 THEN v END), 0) - round_even(avg(CASE WHEN year = 1995 THEN v END), 0) AS evolution FROM v GROUP BY kind""",
       r="before after evolution")
def evolution_rate(spark, sf):
    d = observations(spark, sf).groupBy("kind", "year").agg(F.avg("abundance").alias("v"))
    return op.evolution_rate(d, ["kind"], "year", "v", 1995, 1999)


@query("weighted_geometric_mean", "O-23", sql=f"""WITH {OBS} SELECT site, year, exp(sum(size_class * ln(CASE WHEN discount = 0 THEN 1e-6 ELSE discount END)) / sum(size_class)) AS gm
FROM obs GROUP BY ALL""", r="gm:8", i="site year")
def weighted_geometric_mean(spark, sf):
    return observations(spark, sf).groupBy("site", "year").agg(op.weighted_geometric_mean("discount", "size_class").alias("gm"))


@query("community_trait_mean", "O-24", sql=f"""WITH {OBS}, tr AS (SELECT p_brand AS species, CASE WHEN p_brand LIKE '%3' THEN NULL ELSE avg(p_retailprice) END AS csi, avg(p_size) AS cti FROM part GROUP BY p_brand)
SELECT site, year, sum(csi * abundance) / sum(CASE WHEN csi IS NOT NULL THEN abundance END) AS csi, sum(cti * abundance) / sum(abundance) AS cti
FROM obs JOIN tr USING (species) GROUP BY ALL""", r="csi:5 cti:5", i="site year")
def community_trait_mean(spark, sf):
    tr = table(spark, sf, "part").groupBy(F.col("p_brand").alias("species")).agg(F.avg("p_retailprice").alias("csi"), F.avg("p_size").alias("cti"))
    tr = tr.withColumn("csi", F.when(~F.col("species").like("%3"), F.col("csi")))
    return op.community_trait_mean(observations(spark, sf), tr, ["csi", "cti"])


@query("detection_top", "O-25", sql=f"""WITH {DET}, s AS (SELECT event_id, taxon, prob, (k % 5) / 4.0::DOUBLE AS fox, (k % 3) / 3.0::DOUBLE AS deer FROM det)
SELECT event_id, CASE WHEN taxon = 'signup' THEN 'signup' WHEN greatest(fox * prob, deer * prob) = 0 THEN 'blank' WHEN fox * prob >= deer * prob THEN 'fox' ELSE 'deer' END AS species,
  CASE WHEN taxon = 'signup' THEN prob ELSE greatest(fox * prob, deer * prob) END AS score FROM s""", r="score", i="event_id")
def detection_top(spark, sf):
    d = detections(spark, sf).withColumn("scores", F.create_map(F.lit("fox"), (F.col("k") % 5) / 4.0, F.lit("deer"), (F.col("k") % 3) / 3.0))
    return op.detection_top(d, detector="prob", kind="taxon", bypass=["signup"]).select("event_id", "species", "score")


@query("detection_recap", "O-26", sql=f"""WITH {DET} SELECT file, taxon AS species, array_to_string(list_sort(list(k)), ',') AS frames, count(*) AS count, round(avg(prob), 4) AS conf_mean,
  round(min(prob), 4) AS conf_min, round(max(prob), 4) AS conf_max FROM det GROUP BY file, taxon""", r="conf_mean:3 conf_min:3 conf_max:3", i="count")
def detection_recap(spark, sf):
    d = op.detection_recap(detections(spark, sf), species="taxon", frame="k", score="prob").withColumnRenamed("taxon", "species")
    return d.withColumn("frames", F.array_join("frames", ","))


def _boxes(spark, sf):
    p = pixels(spark, sf)
    x, y = F.col("B2") / 1000, F.col("B3") / 1000
    w, h = F.col("B4") / 1000, F.col("B5") / 1000
    pt = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return p.select((F.col("row") * 100 + F.col("col")).alias("position"), F.concat(F.lit("img"), (F.col("row") % 40).cast("string")).alias("image"),
                    F.col("code").alias("class_id"), F.array(x, y, x + w, y + h).alias("bbox"),
                    F.array(pt(x, y), pt(x + w, y), pt(x + w, y + h), pt(x, y + h)).alias("polygon"))


@query("annotations_coco", "O-27", sql=f"""WITH {PIX}, a AS (SELECT row * 100 + col AS pos, 'img' || (row % 40) AS image, code, B2 / 1000 AS x, B3 / 1000 AS y, B4 / 1000 AS w, B5 / 1000 AS h FROM pix),
i AS (SELECT image, row_number() OVER (ORDER BY min(pos)) AS image_id FROM a GROUP BY image)
SELECT row_number() OVER (ORDER BY pos) AS id, image_id, code + 1 AS category_id, w * h AS area, x AS box_x, y AS box_y, w AS box_w, h AS box_h FROM a JOIN i USING (image)""",
       r="area box_x box_y box_w box_h", i="id image_id category_id")
def annotations_coco(spark, sf):
    _, a = coverage.annotations_to_coco(_boxes(spark, sf))
    return a.select("id", "image_id", "category_id", "area", *[F.col("bbox")[i].alias(n) for i, n in enumerate(("box_x", "box_y", "box_w", "box_h"))])


@query("annotations_yolo", "O-27", sql=f"""WITH {PIX}, a AS (SELECT row * 100 + col AS position, code, B2 / 1000 AS x, B3 / 1000 AS y, B4 / 1000 AS w, B5 / 1000 AS h FROM pix)
SELECT position, code || ' ' || printf('%.6f', (x + (x + w)) / 2) || ' ' || printf('%.6f', (y + (y + h)) / 2) || ' ' || printf('%.6f', x + w - x) || ' ' || printf('%.6f', y + h - y) AS line FROM a""",
       i="position")
def annotations_yolo(spark, sf):
    return coverage.annotations_to_yolo(_boxes(spark, sf)).select("position", "line")


@query("profile_codes", "O-28", sql="""SELECT 'o_orderstatus' AS attribute, o_orderstatus AS code, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL UNION ALL SELECT 'p_name', p_name, count(*) FROM part GROUP BY ALL""", i="n")
def profile_codes(spark, sf):
    o, p = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority"), table(spark, sf, "part").select("p_name")
    return coverage.profile_codes(o).union(coverage.profile_codes(p))


@query("profile_table", "O-28", sql="""
SELECT 'o_orderstatus' AS attribute, 'character' AS class, count(o_orderstatus) AS n, count(DISTINCT o_orderstatus) AS n_distinct, min(o_orderstatus) AS min, max(o_orderstatus) AS max FROM orders
UNION ALL SELECT 'o_orderpriority', 'character', count(o_orderpriority), count(DISTINCT o_orderpriority), min(o_orderpriority), max(o_orderpriority) FROM orders
UNION ALL SELECT 'o_custkey', 'numeric', count(o_custkey), count(DISTINCT o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'day', 'Date', count(o_orderdate), count(DISTINCT CAST(o_orderdate AS DATE)), CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR), CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders""", i="n n_distinct")
def profile_table(spark, sf):
    d = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return coverage.profile_table(d)


@query("geographic_coverage", "O-29", sql=f"WITH {SIGHTINGS} SELECT species AS site, max(lat) AS north, min(lat) AS south, max(lon) AS east, min(lon) AS west FROM sightings GROUP BY species",
       r="north south east west")
def geographic_coverage(spark, sf):
    return coverage.geographic_coverage(sightings(spark, sf).withColumnRenamed("species", "site"))


@query("taxonomic_coverage", "O-30", sql="""WITH a AS (SELECT p_name AS taxon, min(p_partkey) AS ida FROM part WHERE p_size < 3 GROUP BY p_name),
b AS (SELECT p_name AS taxon, min(p_partkey) AS idb FROM part WHERE p_size > 10 GROUP BY p_name)
SELECT t.taxon, CASE WHEN ida IS NOT NULL THEN 'first' WHEN idb IS NOT NULL THEN 'second' END AS authority, CAST(coalesce(ida, idb) AS VARCHAR) AS authority_id
FROM (SELECT DISTINCT p_name AS taxon FROM part) t LEFT JOIN a USING (taxon) LEFT JOIN b USING (taxon)""")
def taxonomic_coverage(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_name").alias("taxon"), F.col("p_partkey").alias("authority_id"), "p_size")
    return coverage.taxonomic_coverage(p, [("first", p.filter("p_size < 3")), ("second", p.filter("p_size > 10"))])


@query("metadata_coverage", "O-31", sql=f"""WITH {SIGHTINGS} SELECT sighting_id, 'place ' || sighting_id AS name, round(lon, 2) AS west,
  CASE WHEN nation < 10 THEN round(lon, 2) ELSE round(lon + 1, 2) END AS east, CASE WHEN nation < 10 THEN round(lat, 2) ELSE round(lat + 1, 2) END AS north, round(lat, 2) AS south,
  CASE WHEN nation < 10 THEN 'point' ELSE 'rectangle' END AS shape FROM sightings""", r="west:2 east:2 north:2 south:2", i="sighting_id")
def metadata_coverage(spark, sf):
    s = sightings(spark, sf)
    one = F.when(F.col("nation") < 10, 0.0).otherwise(1.0)
    tag = lambda n, v: F.concat(F.lit(f"<{n}>"), v.cast("string"), F.lit(f"</{n}>"))
    box = F.concat(tag("westBoundingCoordinate", F.round("lon", 2)), tag("eastBoundingCoordinate", F.round(F.col("lon") + one, 2)),
                   tag("northBoundingCoordinate", F.round(F.col("lat") + one, 2)), tag("southBoundingCoordinate", F.round("lat", 2)))
    xml = F.concat(F.lit("<eml><dataset><coverage><geographicCoverage>"), tag("geographicDescription", F.concat(F.lit("place "), F.col("sighting_id").cast("string"))),
                   tag("boundingCoordinates", box), F.lit("</geographicCoverage></coverage></dataset></eml>"))
    return coverage.metadata_coverage(s.select("sighting_id", xml.alias("xml")), key="sighting_id")


@query("barcode_records", "O-32", sql="""SELECT p_partkey || '|' || CASE WHEN p_size % 3 <> 0 THEN p_name WHEN p_size % 2 <> 0 THEN p_brand ELSE p_type END || '|' || p_type || '|' || p_brand AS name,
  upper(p_name) AS seq FROM part WHERE p_type IN ('SMALL', 'PROMO', 'LARGE')""")
def barcode_records(spark, sf):
    p = table(spark, sf, "part")
    s = F.col("p_size")
    d = p.select(F.col("p_partkey").alias("record_id"), F.col("p_type").alias("marker"), F.col("p_brand").alias("accession"),
                 F.when(s % 3 != 0, F.col("p_name")).otherwise("").alias("species"), F.when(s % 2 != 0, F.col("p_brand")).otherwise(" ").alias("genus"),
                 F.col("p_type").alias("family"), F.lit("").alias("order"), F.lit("").alias("class"), F.lit("").alias("phylum"), F.upper("p_name").alias("seq"))
    return coverage.barcode_records(d, ["SMALL", "PROMO", "LARGE"])


@query("layer_catalog", "O-33", sql="SELECT p_partkey AS layer, p_type AS realm, p_brand AS scenario, 1900 + p_size AS year FROM part WHERE p_type = 'PROMO' AND p_size = 14", i="layer year")
def layer_catalog(spark, sf):
    d = table(spark, sf, "part").select(F.col("p_partkey").alias("layer"), F.col("p_type").alias("realm"), F.col("p_brand").alias("scenario"),
                                        (1900 + F.col("p_size")).alias("year"), F.lit("e").alias("epoch"), F.lit("v").alias("version"))
    return coverage.layer_catalog(d, realm="PROMO", year=1914).select("layer", "realm", "scenario", "year")


@query("describe_by", "O-34", sql=f"""WITH {OBS} SELECT species, year, min(biomass) AS min, avg(biomass) AS mean, max(biomass) AS max, stddev_samp(biomass) AS sd, count(biomass) AS n,
  quantile_cont(biomass, 0.25) AS q1, quantile_cont(biomass, 0.5) AS median, quantile_cont(biomass, 0.75) AS q3 FROM obs GROUP BY species, year""",
       r="min:3 mean:3 max:3 sd:3 q1:5 median:5 q3:5", i="year n")
def describe_by(spark, sf):
    return op.describe_by(observations(spark, sf), "biomass", ["species", "year"])


@query("describe_overall", "O-34", sql=f"""WITH {OBS} SELECT min(biomass) AS min, avg(biomass) AS mean, max(biomass) AS max, stddev_samp(biomass) AS sd, count(biomass) AS n,
  quantile_cont(biomass, 0.25) AS q1, quantile_cont(biomass, 0.5) AS median, quantile_cont(biomass, 0.75) AS q3 FROM obs""",
       r="min:3 mean:3 max:3 sd:3 q1:5 median:5 q3:5", i="n")
def describe_overall(spark, sf):
    return op.describe_by(observations(spark, sf), "biomass")


@query("collinearity_by_species", "O-35", sql=f"""WITH {OBS}, g AS (SELECT part AS species, count(*) AS n, corr(abundance, biomass) AS r1, corr(abundance, tax) AS r2, corr(biomass, tax) AS r3 FROM obs GROUP BY part)
SELECT species, n, 'abundance' AS var_a, 'biomass' AS var_b, CASE WHEN n >= 3 THEN r1 END AS r FROM g
UNION ALL SELECT species, n, 'abundance', 'tax', CASE WHEN n >= 3 THEN r2 END FROM g UNION ALL SELECT species, n, 'biomass', 'tax', CASE WHEN n >= 3 THEN r3 END FROM g""", r="r:5", i="species n")
def collinearity_by_species(spark, sf):
    return op.collinearity_by_species(observations(spark, sf), ["abundance", "biomass", "tax"], "part").withColumnRenamed("part", "species")
