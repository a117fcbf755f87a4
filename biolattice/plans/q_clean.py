"""Cleaning and validation queries (C)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as op
from .registry import query
from .views import DET, OBS, SIGHTINGS, detections, observations, sightings, table


@query("tidy_detections", "C-01", sql=f"""WITH {DET}, d AS (SELECT *, CASE WHEN taxon = 'error' THEN 'empty' ELSE taxon END AS tx,
  row_number() OVER (PARTITION BY file, CASE WHEN taxon = 'error' THEN 'empty' ELSE taxon END ORDER BY event_id) AS rn FROM det)
SELECT event_id AS position, file, tx AS taxon, CASE WHEN event_id % 10 = 0 THEN 0 ELSE prob END AS probability, 'ABCDEFGHIJKLMNOPQRSTUVWX' AS participation
FROM d WHERE rn = 1 OR tx = 'empty'""", r="probability", i="position")
def tidy_detections(spark, sf):
    d = detections(spark, sf).select(
        F.col("event_id").alias("position"), "file", F.when(F.col("taxon") == "error", "empty").otherwise(F.col("taxon")).alias("taxon"),
        F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("prob").cast("string")).alias("probability"))
    return op.tidy_detections(d, "participation-ABCDEFGHIJKLMNOPQRSTUVWX-observations.csv")


@query("resolve_identification", "C-02", sql=f"""WITH {DET} SELECT event_id, CASE WHEN id_valid <> '' THEN id_valid WHEN k % 2 = 0 THEN taxon ELSE '' END AS id_valid,
  CASE WHEN conf_valid <> '' THEN conf_valid WHEN k % 2 = 0 THEN 'POSSIBLE' ELSE '' END AS conf_valid FROM det""", i="event_id")
def resolve_identification(spark, sf):
    d = detections(spark, sf).select("event_id", F.when(F.col("k") % 2 == 0, F.col("taxon")).alias("observer_taxon"),
                                     F.when(F.col("k") % 2 == 0, "POSSIBLE").alias("observer_conf"),
                                     F.nullif("id_valid", F.lit("")).alias("validator_taxon"), F.col("conf_valid").alias("validator_conf"))
    return op.resolve_identification(d).select("event_id", "id_valid", "conf_valid")


def _named(spark, sf):
    d = detections(spark, sf)
    ms = F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")
    walk = F.concat(F.lit("Cir2440-2014-Pass1-Tron"), (F.col("k") % 12).cast("string"), F.lit("-Chiro_1_"),
                    F.lpad((F.col("event_id") % 800 + 1).cast("string"), 5, "0"), F.lit("_"), ms)
    still = F.concat(F.lit("Car170517-2014-Pass1-C1-OB_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), ms)
    return d.withColumn("name", F.when(F.col("k") % 2 == 0, walk).otherwise(still))


@query("recording_time", "C-03", sql=f"""WITH {DET}, d AS (SELECT *, date_trunc('second', ts) - INTERVAL 2 HOUR AS rt FROM det)
SELECT event_id, CASE WHEN k % 2 = 0 THEN CAST(k % 12 AS VARCHAR) ELSE strftime(CASE WHEN hour(rt) < 12 THEN rt - INTERVAL 1 DAY ELSE rt END, '%d/%m/%Y') END AS session,
  CASE WHEN k % 2 = 0 THEN (k % 12) * 800 + (event_id % 800 + 1) + (event_id % 1000) / 1000.0::DOUBLE ELSE floor(epoch(rt)) + (event_id % 1000) / 1000.0::DOUBLE END AS time_num
FROM d""", r="time_num:3", i="event_id")
def recording_time(spark, sf):
    return op.recording_time(_named(spark, sf).drop("time_num"), "name").select("event_id", "session", "time_num")


@query("dedupe_by_priority", "C-04", sql=f"""WITH {DET} SELECT file, taxon, event_id, prob FROM (SELECT *, row_number() OVER (PARTITION BY file, taxon ORDER BY conf_valid DESC, prob DESC, event_id DESC) AS rn FROM det) WHERE rn = 1""",
       r="prob", i="event_id")
def dedupe_by_priority(spark, sf):
    return op.dedupe_by_priority(detections(spark, sf), ["file", "taxon"], ["conf_valid", "prob", "event_id"]).select("file", "taxon", "event_id", "prob")


@query("observation_unit", "C-05", sql=f"""WITH {OBS} SELECT year || '_' || kind AS observation_unit, CAST(year AS VARCHAR) AS year, kind AS location, sum(abundance) AS n FROM obs GROUP BY year, kind""", r="n:2")
def observation_unit(spark, sf):
    d = op.observation_unit(observations(spark, sf).withColumnRenamed("kind", "location")).drop("year", "location")
    return op.split_unit(d.groupBy("observation_unit").agg(F.sum("abundance").alias("n")))


@query("drop_nonspecies", "C-06", sql=rf"""WITH {OBS} SELECT site, species, sum(abundance) AS n FROM obs WHERE NOT regexp_matches(species, '(sp\.|[1-9])$') GROUP BY ALL""", r="n:2", i="site")
def drop_nonspecies(spark, sf):
    return op.drop_nonspecies(observations(spark, sf)).groupBy("site", "species").agg(F.sum("abundance").alias("n"))


@query("filter_absent_species", "C-07", sql=f"""WITH {OBS}, d AS (SELECT site || '-' || size_class AS species, visit, rotation, CASE WHEN discount > 0.08 THEN abundance ELSE 0 END AS n FROM obs)
SELECT species, count(*) AS rows, sum(n) AS total FROM d GROUP BY species HAVING sum(n) > 0""", r="total:2", i="rows")
def filter_absent_species(spark, sf):
    d = observations(spark, sf).select(F.concat_ws("-", "site", "size_class").alias("species"),
                                       F.when(F.col("discount") > 0.08, F.col("abundance")).otherwise(0.0).alias("abundance"))
    return op.filter_absent_species(d).groupBy("species").agg(F.count(F.lit(1)).alias("rows"), F.sum("abundance").alias("total"))


RARE = f"""WITH {OBS}, d AS (SELECT site || '-' || size_class AS species, year, sum(abundance) AS n FROM obs GROUP BY ALL),
yr AS (SELECT year, row_number() OVER (ORDER BY year) AS r FROM (SELECT DISTINCT year FROM obs)),
g AS (SELECT s.species, yr.r, coalesce(d.n, 0) > 0 AS here FROM (SELECT DISTINCT species FROM d) s CROSS JOIN yr LEFT JOIN d ON d.species = s.species AND d.year = yr.year),
i AS (SELECT *, r - row_number() OVER (PARTITION BY species, here ORDER BY r) AS run FROM g),
l AS (SELECT species, here, run, count(*) AS len FROM i GROUP BY ALL),
f AS (SELECT species, bool_or(here AND r = 1) AS first_year FROM g GROUP BY species),
o AS (SELECT l.species, any_value(first_year) AS first_year, coalesce(max(CASE WHEN NOT here THEN len END), 0) AS longest_gap, coalesce(max(CASE WHEN here THEN len END), 0) AS longest_run
  FROM l JOIN f ON f.species = l.species GROUP BY l.species)"""


@query("rare_species_flags", "C-08", sql=f"{RARE} SELECT *, first_year AND longest_gap <= 3 AND longest_run >= 3 AS keep FROM o", i="longest_gap longest_run")
def rare_species_flags(spark, sf):
    return op.rare_species_flags(observations(spark, sf).withColumn("species", F.concat_ws("-", "site", "size_class")))


@query("filter_rare_species", "C-08", sql=f"""{RARE} SELECT d.species, d.year, d.n AS abundance FROM d JOIN o ON o.species = d.species
WHERE first_year AND longest_gap <= 3 AND longest_run >= 3""", r="abundance:2", i="year")
def filter_rare_species(spark, sf):
    d = observations(spark, sf).withColumn("species", F.concat_ws("-", "site", "size_class"))
    return op.filter_rare_species(d.groupBy("species", "year").agg(F.sum("abundance").alias("abundance")))


@query("exclude_species", "C-09", sql=f"WITH {OBS} SELECT species, count(*) AS n FROM obs WHERE species NOT IN ('Brand#1', 'Brand#12') GROUP BY species", i="n")
def exclude_species(spark, sf):
    return op.exclude_species(observations(spark, sf), ["Brand#1", "Brand#12"]).groupBy("species").agg(F.count(F.lit(1)).alias("n"))


@query("site_visit_filter", "C-10", sql=f"""WITH {OBS}, d AS (SELECT part AS site, year, CASE WHEN discount > 0.03 THEN abundance ELSE 0 END AS n FROM obs)
SELECT site, year, count(*) AS visits, sum(n) AS total FROM d GROUP BY ALL HAVING count(*) >= 5 AND count(*) FILTER (n > 0) >= 4""", r="total:2", i="site year visits")
def site_visit_filter(spark, sf):
    d = observations(spark, sf).select(F.col("part").alias("site"), "year", F.when(F.col("discount") > 0.03, F.col("abundance")).otherwise(0.0).alias("count"))
    return op.site_visit_filter(d, 5, 4).groupBy("site", "year").agg(F.count(F.lit(1)).alias("visits"), F.sum("count").alias("total"))


@query("clean_taxa", "C-11", sql="""SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS taxon FROM part WHERE p_size % 3 <> 1""", i="p_partkey")
def clean_taxa(spark, sf):
    s = F.col("p_size") % 3
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)"))
    d = table(spark, sf, "part").select("p_partkey", F.concat(name, F.when(s == 0, " (Linnaeus, 1758)").when(s == 1, " sp2").otherwise(" Cuvier ")).alias("taxon"))
    return op.clean_taxa(d)


@query("model_availability", "C-12", sql=f"""WITH {OBS} SELECT part AS taxon, CASE WHEN part IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') THEN 'Yes' ELSE 'No' END AS model, sum(abundance) AS occurrences
FROM obs GROUP BY part""", r="occurrences:2", i="taxon")
def model_availability(spark, sf):
    d = observations(spark, sf).select(F.col("part").alias("taxon"), F.col("abundance").alias("count"))
    return op.model_availability(d, table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("taxon")))


@query("occurrence_search", "C-13", sql=f"""WITH {SIGHTINGS}, d AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY sighting_id) AS rn FROM sightings
  WHERE species = 'BUILDING' AND lon BETWEEN -150 AND 150 AND lat BETWEEN -60 AND 70) SELECT sighting_id, nation, lat, lon FROM d WHERE rn <= 3""", r="lat lon", i="sighting_id nation")
def occurrence_search(spark, sf):
    d = op.occurrence_search(sightings(spark, sf), name="BUILDING", bbox=(-150, -60, 150, 70), limit=3, source="nation", order=["sighting_id"])
    return d.select("sighting_id", "nation", "lat", "lon")


@query("profile_select", "C-14", sql=f"""WITH {SIGHTINGS} SELECT o_orderkey AS profile, lat, lon, o_totalprice / 1000 AS pressure FROM orders JOIN sightings ON sighting_id = o_custkey
WHERE lon BETWEEN -100 AND 120 AND lat BETWEEN -50 AND 60 AND o_totalprice / 1000 BETWEEN 50 AND 400 AND o_orderdate >= '1996-01-01' AND o_orderdate < '2000-01-01'""", r="lat lon pressure", i="profile")
def profile_select(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("sighting_id"), F.col("o_orderkey").alias("profile"), F.col("o_orderdate").alias("time"),
                                          (F.col("o_totalprice") / 1000).alias("pressure"))
    d = o.join(sightings(spark, sf), "sighting_id")
    return op.profile_select(d, region=(-100, 120, -50, 60), pressure=(50, 400), dates=("1996-01-01", "2000-01-01")).select("profile", "lat", "lon", "pressure")


@query("anonymize_coordinates", "C-15")
def anonymize_coordinates(spark, sf):
    return op.anonymize_coordinates(sightings(spark, sf).select("sighting_id", "lat", "lon"), lon="lon", lat="lat", seed=11)


@query("relabel_by_pattern", "C-16", sql="""SELECT p_partkey, CASE WHEN p_name LIKE '%red%' THEN 'R_RED' WHEN p_name LIKE '%small%' THEN 'S_SMALL' WHEN p_name LIKE '%ring%' THEN 'Z_RING' ELSE p_name END AS site,
  CASE WHEN p_name LIKE '%red%' THEN 'Red place' WHEN p_name LIKE '%small%' THEN 'Small place' WHEN p_name LIKE '%ring%' THEN 'Z_RING' ELSE p_name END AS site_name FROM part""", i="p_partkey")
def relabel_by_pattern(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("site"))
    return op.relabel_by_pattern(d, [("red", "R_RED"), ("small", "S_SMALL"), ("ring", "Z_RING")], {"R_RED": "Red place", "S_SMALL": "Small place"})


@query("impute_replicates", "C-17", sql="""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity % 5 <> 0 THEN l_quantity % 7 END AS a, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 3 END AS b,
  CASE WHEN l_suppkey % 6 <> 0 THEN l_suppkey % 5 END AS c, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber * 100 END AS t FROM lineitem),
m AS (SELECT *, floor((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT, 0) * 100) AS mean FROM d)
SELECT l_partkey, l_suppkey, sum(CASE WHEN t IS NULL THEN mean WHEN mean <> 0 AND t <> mean THEN mean ELSE t END) AS total, count(*) AS n FROM m GROUP BY ALL""", i="l_partkey l_suppkey total n")
def impute_replicates(spark, sf):
    d = table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", F.when(F.col("l_quantity") % 5 != 0, F.col("l_quantity") % 7).alias("a"), F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey") % 3).alias("b"),
        F.when(F.col("l_suppkey") % 6 != 0, F.col("l_suppkey") % 5).alias("c"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber") * 100).alias("t"))
    return op.impute_replicates(d, ["a", "b", "c"], "t").groupBy("l_partkey", "l_suppkey").agg(F.sum("t").alias("total"), F.count(F.lit(1)).alias("n"))


@query("clip_and_fill", "C-18", sql=f"""WITH {OBS}, d AS (SELECT site, kind, CASE WHEN discount > 0.01 THEN abundance * 3 END AS cover FROM obs)
SELECT site, kind, count(coalesce(cover, CASE WHEN kind IN ('PROMO', 'SMALL') THEN 0 END)) AS n, sum(CASE WHEN cover IS NOT NULL THEN least(cover, 100) END) AS total, max(cover) > 100 AS clipped FROM d GROUP BY ALL""", r="total:2", i="site n")
def clip_and_fill(spark, sf):
    d = observations(spark, sf).select("site", "kind", F.when(F.col("discount") > 0.01, F.col("abundance") * 3).alias("cover"))
    c = op.clip_and_fill(d.withColumn("raw", F.col("cover")), ["cover"], 100.0, 0.0, "kind", ["PROMO", "SMALL"])
    return c.groupBy("site", "kind").agg(F.count("cover").alias("n"), F.sum("cover").alias("total"), (F.max("raw") > 100).alias("clipped"))


@query("accretion_correct", "C-19", sql=f"""WITH {OBS}, u AS (SELECT visit, rotation % 3 AS block, max(kind IN ('PROMO', 'SMALL')) AS bright, max(size_class % 2) AS mus FROM obs WHERE rotation <= 3 GROUP BY ALL),
l AS (SELECT o.*, rotation % 3 AS block FROM obs o WHERE rotation > 3)
SELECT l.visit, l.rotation, l.part, l.site, sum(CASE WHEN fix AND floor(discount * 1000) = 100 THEN 0 WHEN fix THEN least(100, abundance / (100 - floor(discount * 1000)) * 100) ELSE least(100, abundance) END) AS cover
FROM (SELECT l.*, coalesce(bright, false) AND (kind NOT IN ('LARGE', 'MEDIUM') OR (floor(discount * 1000) <> 0 AND mus = 0)) AS fix FROM l LEFT JOIN u ON u.visit = l.visit AND u.block = l.block) l GROUP BY ALL""", r="cover", i="visit rotation part site")
def accretion_correct(spark, sf):
    d = observations(spark, sf).select("visit", (F.col("rotation") % 3).alias("block"), "rotation", "part", "site", F.when(F.col("rotation") <= 3, "upper").otherwise("lower").alias("face"),
                                       F.col("kind").alias("colour"), F.floor(F.col("discount") * 1000).alias("covered"), (F.col("size_class") % 2).alias("mussels"),
                                       F.col("kind").alias("region"), F.col("abundance").alias("cover"))
    out = op.accretion_correct(d, ["cover"], ["visit", "block"], strict_regions=["LARGE", "MEDIUM"], colours=["PROMO", "SMALL"])
    return out.filter("face = 'lower'").groupBy("visit", "rotation", "part", "site").agg(F.sum("cover").alias("cover"))


@query("assign_quadrat", "C-20", sql="""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q BETWEEN 1 AND 5 THEN 'Q' || q END AS quadrat, CASE WHEN month(l_shipdate) < 7 THEN 'first' ELSE 'second' END AS period
FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN (l_linenumber + 1) // 2 ELSE l_linenumber END AS q FROM lineitem)""", i="l_orderkey l_linenumber l_partkey")
def assign_quadrat(spark, sf):
    d = table(spark, sf, "lineitem").withColumn("m", F.month("l_shipdate"))
    return op.assign_quadrat(d, "l_linenumber", "l_returnflag", "A", "m").select("l_orderkey", "l_linenumber", "l_partkey", "quadrat", "period")


@query("harmonize_columns", "C-21", sql=f"""WITH {SIGHTINGS} SELECT o_orderkey AS profile, CASE WHEN lon + 180 >= 180 THEN lon ELSE lon END AS lon, lat, epoch(o_orderdate) / 86400 + 7305 AS time, o_totalprice AS temperature_raw,
  CASE WHEN nation % 2 = 0 THEN 'psu' ELSE 'decibar' END AS unit FROM orders JOIN sightings ON sighting_id = o_custkey""", r="lon lat time temperature_raw:2", i="profile")
def harmonize_columns(spark, sf):
    d = table(spark, sf, "orders").join(sightings(spark, sf), F.col("sighting_id") == F.col("o_custkey")).select(
        F.col("o_orderkey").alias("profile"), F.pmod(F.col("lon"), F.lit(360.0)).alias("LONGITUDE"), F.col("lat").alias("lat"), F.col("o_orderdate").alias("JULD"),
        F.col("o_totalprice").alias("TEMP"), F.when(F.col("nation") % 2 == 0, "PSU").otherwise("dbar").alias("unit"))
    return op.harmonize_columns(d, state="raw", unit_cols=["unit"])


@query("map_semantics", "C-22", sql="SELECT s_suppkey AS station, s_acctbal AS oxygen FROM supplier", r="oxygen:2", i="station")
def map_semantics(spark, sf):
    d = op.map_semantics(table(spark, sf, "supplier"), {"station": ["stn", "S_SUPPKEY"], "oxygen": ["doxy", "s_AcctBal"]})
    return d.select("station", "oxygen")


MC = """WITH d AS (SELECT l_orderkey AS cast_id, l_linenumber AS level, CASE WHEN l_partkey % 2 = 0 THEN l_quantity END AS oxygen, CASE WHEN l_partkey % 3 = 0 THEN l_tax END AS salt FROM lineitem),
e AS (SELECT * FROM d WHERE oxygen IS NOT NULL OR salt IS NOT NULL), g AS (SELECT cast_id, level, min(oxygen) AS a, max(oxygen) AS z, min(salt) AS b, max(salt) AS y FROM e GROUP BY ALL)"""


@query("merge_complementary", "C-23", sql=f"""{MC} SELECT cast_id, level, a AS oxygen, b AS salt FROM g WHERE a IS NOT DISTINCT FROM z AND b IS NOT DISTINCT FROM y
UNION ALL SELECT e.* FROM e JOIN g USING (cast_id, level) WHERE NOT (a IS NOT DISTINCT FROM z AND b IS NOT DISTINCT FROM y)""", r="oxygen salt", i="cast_id level")
def merge_complementary(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("cast_id"), F.col("l_linenumber").alias("level"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_quantity")).alias("oxygen"),
                                            F.when(F.col("l_partkey") % 3 == 0, F.col("l_tax")).alias("salt"))
    return op.merge_complementary(d, ["cast_id", "level"])


@query("complete_rows", "C-24", sql=f"""WITH {OBS} SELECT site, count(*) AS n FROM obs WHERE discount > 0.04 AND tax < 0.06 GROUP BY site""", i="site n")
def complete_rows(spark, sf):
    d = observations(spark, sf).withColumn("a", F.when(F.col("discount") > 0.04, 1)).withColumn("b", F.when(F.col("tax") < 0.06, 1))
    return op.complete_rows(d, ["a", "b"]).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("ordered_filters", "C-25", sql=f"""WITH {OBS}, a AS (SELECT * FROM obs WHERE tax < 0.07), b AS (SELECT * FROM a WHERE discount > 0.02), c AS (SELECT * FROM b WHERE abundance > 5)
SELECT 0 AS step, 'start' AS filter, count(*) AS rows, count(DISTINCT species) AS species FROM obs UNION ALL SELECT 1, 'tax', count(*), count(DISTINCT species) FROM a
UNION ALL SELECT 2, 'discount', count(*), count(DISTINCT species) FROM b UNION ALL SELECT 3, 'abundance', count(*), count(DISTINCT species) FROM c""", i="step rows species")
def ordered_filters(spark, sf):
    f = {"tax": lambda d: d.filter("tax < 0.07"), "discount": lambda d: d.filter("discount > 0.02"), "abundance": lambda d: d.filter("abundance > 5")}
    return op.ordered_filters(observations(spark, sf), ["tax", "discount", "abundance"], f, {"rows": F.count(F.lit(1)), "species": F.count_distinct("species")})[1]


@query("one_hot", "C-26", sql="SELECT o_orderkey, o_totalprice AS price, " + ", ".join(f"CAST(o_orderstatus = '{s}' AS INTEGER) AS status_{s}" for s in "FOP") + " FROM orders",
       r="price:2", i="o_orderkey status_F status_O status_P")
def one_hot(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderstatus").alias("status"))
    return op.one_hot(d, ["price", "status"])
