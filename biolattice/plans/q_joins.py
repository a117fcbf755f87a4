"""Lookup, nearest and range-join queries (J)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as op, phylogeny
from .registry import query
from .views import (DET, DIST, GEN, GRID, OBS, SIGHTINGS, STATIONS, VAR, detections, genotypes, observations, ocean_grid,
                    sightings, stations, table, variants)


@query("lookup_first", "J-01", sql="""WITH r AS (SELECT p_brand, arg_min(p_name, p_partkey) AS name FROM part WHERE p_size > 40 GROUP BY p_brand)
SELECT s_suppkey, 'Brand#' || (s_suppkey % 30) AS p_brand, name FROM supplier LEFT JOIN r ON r.p_brand = 'Brand#' || (s_suppkey % 30)""", i="s_suppkey")
def lookup_first(spark, sf):
    d = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 30).cast("string")).alias("p_brand"))
    r = table(spark, sf, "part").filter("p_size > 40").select("p_brand", F.col("p_name").alias("name"), "p_partkey")
    return op.lookup(d, r, "p_brand", position="p_partkey")


@query("match_inner", "J-02", sql="SELECT c_custkey AS k, c_nationkey AS nation, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL", i="k nation n")
def match_inner(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
    return op.match_rows(c, table(spark, sf, "orders"), ["k"], ["o_custkey"]).groupBy("k", "nation").agg(F.count(F.lit(1)).alias("n"))


@query("match_full", "J-03", sql="""SELECT coalesce(s_suppkey, c_custkey) AS k, s_acctbal AS a, c_acctbal AS b FROM (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) s FULL JOIN customer ON c_custkey = s_suppkey * 20""" .replace("coalesce(s_suppkey, c_custkey)", "coalesce(s_suppkey * 20, c_custkey)"),
       r="a:2 b:2", i="k")
def match_full(spark, sf):
    s = table(spark, sf, "supplier").filter("s_suppkey % 2 = 0").select((F.col("s_suppkey") * 20).alias("k"), F.col("s_acctbal").alias("a"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("b"))
    return op.match_rows(s, c, ["k"], ["c_custkey"], "full")


@query("match_anti", "J-03", sql="SELECT c_custkey AS k FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')", i="k")
def match_anti(spark, sf):
    return op.match_rows(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'"),
                         ["k"], ["o_custkey"], "left_anti")


@query("expand_header", "J-04", sql="""SELECT o_orderkey AS visit, o_orderpriority AS surveyor, sum(l_quantity) AS n, count(*) AS rows FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""", r="n:2", i="visit rows")
def expand_header(spark, sf):
    h = table(spark, sf, "orders").select(F.col("o_orderkey").alias("visit"), F.col("o_orderpriority").alias("surveyor"))
    d = op.expand_header(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "visit"), h, ["visit"])
    return d.groupBy("visit", "surveyor").agg(F.sum("l_quantity").alias("n"), F.count(F.lit(1)).alias("rows"))


@query("nearest_point", "J-05", sql=f"""WITH {SIGHTINGS}, {STATIONS} SELECT a.sighting_id, arg_min(b.station_id, {DIST}) AS nearest_station_id, min({DIST}) AS distance_m
FROM sightings a CROSS JOIN stations b GROUP BY a.sighting_id""", r="distance_m:2", i="sighting_id nearest_station_id")
def nearest_point(spark, sf):
    return op.nearest_point(sightings(spark, sf).select("sighting_id", "lat", "lon"), stations(spark, sf), "sighting_id", "station_id").drop("lat", "lon")


NEAR = f"""WITH {DET}, v AS (SELECT taxon, time_num AS t, max(id_valid) AS id FROM det WHERE id_valid <> '' GROUP BY ALL),
lo AS (SELECT d.event_id, d.time_num, d.taxon, v.t AS tl, v.id AS il FROM det d ASOF LEFT JOIN v ON d.taxon = v.taxon AND d.time_num >= v.t),
b AS (SELECT lo.*, v.t AS th, v.id AS ih FROM lo ASOF LEFT JOIN v ON lo.taxon = v.taxon AND lo.time_num <= v.t)"""


@query("nearest_in_time", "J-06", sql=f"""{NEAR} SELECT event_id, CASE WHEN th IS NOT NULL AND (tl IS NULL OR th - time_num <= time_num - tl) THEN ih ELSE il END AS near_id,
  CASE WHEN th IS NOT NULL AND (tl IS NULL OR th - time_num <= time_num - tl) THEN th ELSE tl END AS near_time FROM b""", i="event_id near_time")
def nearest_in_time(spark, sf):
    d = detections(spark, sf).withColumn("mark", F.col("id_valid") != "")
    n = op.nearest_in_time(d, ["taxon"], "time_num", "mark", ["id_valid"])
    return n.select("event_id", F.col("near_id_valid").alias("near_id"), F.col("near_time_num").alias("near_time"))


@query("rounded_coordinate_join", "J-07", sql="""WITH a AS (SELECT s_suppkey AS station, round(s_suppkey % 7 / 3.0::DOUBLE, 2) AS lat, round(s_suppkey % 5 / 7.0::DOUBLE, 2) AS lon FROM supplier),
b AS (SELECT c_custkey % 3 AS cluster, round(c_custkey % 7 / 3.0::DOUBLE + 0.001, 2) AS lat, round(c_custkey % 5 / 7.0::DOUBLE, 2) AS lon, c_acctbal AS v FROM customer)
SELECT station, cluster, avg(v) AS v FROM a JOIN b ON a.lat = b.lat AND a.lon = b.lon GROUP BY ALL""", r="v:4", i="station cluster")
def rounded_coordinate_join(spark, sf):
    k = F.col("s_suppkey")
    a = table(spark, sf, "supplier").select(k.alias("station"), (k % 7 / 3.0).alias("lat"), (k % 5 / 7.0).alias("lon"))
    k = F.col("c_custkey")
    b = table(spark, sf, "customer").select((k % 3).alias("cluster"), (k % 7 / 3.0 + 0.001).alias("lat"), (k % 5 / 7.0).alias("lon"), F.col("c_acctbal").alias("v"))
    return op.rounded_coordinate_join(a, b, ["station", "cluster"], ["v"])


@query("enrich_with_grid", "J-08", sql=f"""WITH {GRID}, o AS (SELECT o_orderkey AS id, o_orderdate AS ts, 30 + o_custkey % 95 / 10.0::DOUBLE AS lat, -10 + o_custkey % 110 / 10.0::DOUBLE AS lon FROM orders),
ts AS (SELECT DISTINCT time FROM grid), n AS (SELECT o.*, a.time AS tl, b.time AS th FROM o ASOF LEFT JOIN ts a ON o.ts >= a.time ASOF LEFT JOIN ts b ON o.ts <= b.time),
k AS (SELECT *, CASE WHEN th IS NOT NULL AND (tl IS NULL OR th - ts <= ts - tl) THEN th ELSE tl END AS nt FROM n)
SELECT k.id, avg(g.chl) AS chl FROM k LEFT JOIN grid g ON g.time = k.nt AND g.lat BETWEEN k.lat - 0.6 AND k.lat + 0.6 AND g.lon BETWEEN k.lon - 0.6 AND k.lon + 0.6 GROUP BY k.id""", r="chl:8", i="id")
def enrich_with_grid(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("time"), (30 + F.col("o_custkey") % 95 / 10.0).alias("lat"),
                                          (-10 + F.col("o_custkey") % 110 / 10.0).alias("lon"))
    return op.enrich_with_grid(o, ocean_grid(spark, sf), ["chl"], 1.2, "id").select("id", "chl")


@query("match_tree_and_community", "J-09", sql=f"""WITH {OBS} SELECT part AS species, sum(abundance) AS n FROM obs WHERE part IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY part""", r="n:2", i="species")
def match_tree_and_community(spark, sf):
    tips = table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("tip"))
    _, com = op.match_tree_and_community(tips, observations(spark, sf).drop("species").withColumnRenamed("part", "species"))
    return com.groupBy("species").agg(F.sum("abundance").alias("n"))


@query("join_traits", "J-10", sql="""WITH t AS (SELECT l_partkey AS taxon, CAST(l_quantity AS BIGINT) AS value, l_returnflag AS trait, l_orderkey * 100000 + l_linenumber * 10000 + l_suppkey * 10 AS pos FROM lineitem),
m AS (SELECT taxon, max(CASE WHEN trait = 'A' THEN struct_pack(p := pos, v := value) END).v AS A, max(CASE WHEN trait = 'R' THEN struct_pack(p := pos, v := value) END).v AS R FROM t GROUP BY taxon)
SELECT p_partkey AS taxon, A, R FROM part LEFT JOIN m ON taxon = p_partkey""", i="taxon A R")
def join_traits(spark, sf):
    l = table(spark, sf, "lineitem")
    pos = F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("l_suppkey") * 10
    # a place in the input, unique per row of a taxon: ties are broken by the value itself
    t = l.select(F.col("l_partkey").alias("taxon"), F.col("l_quantity").cast("long").alias("value"), F.col("l_returnflag").alias("trait"),
                 F.struct(pos.alias("p"), F.col("l_quantity").alias("q")).alias("position"))
    return op.join_traits(table(spark, sf, "part").select(F.col("p_partkey").alias("taxon")), t, ["A", "R"])


@query("keep_individuals", "J-11", sql=f"WITH {VAR} SELECT ind, count(*) AS n FROM var WHERE ind IN (SELECT 'i' || s_suppkey FROM supplier WHERE s_acctbal > 3000) GROUP BY ind", i="n")
def keep_individuals(spark, sf):
    names = table(spark, sf, "supplier").filter("s_acctbal > 3000").select(F.concat(F.lit(" i"), F.col("s_suppkey").cast("string")).alias("x"))
    return op.keep_remove_individuals(variants(spark, sf), names, "keep").groupBy("ind").agg(F.count(F.lit(1)).alias("n"))


@query("remove_individuals", "J-11", sql=f"WITH {VAR} SELECT ind, count(*) AS n FROM var WHERE ind NOT IN (SELECT 'i' || s_suppkey FROM supplier WHERE s_acctbal > 3000) GROUP BY ind", i="n")
def remove_individuals(spark, sf):
    names = table(spark, sf, "supplier").filter("s_acctbal > 3000").select(F.concat(F.lit("i"), F.col("s_suppkey").cast("string")).alias("x"))
    return op.keep_remove_individuals(variants(spark, sf), names, "remove").groupBy("ind").agg(F.count(F.lit(1)).alias("n"))


@query("split_by_population", "J-12", sql=f"""WITH {VAR} SELECT CAST(s_nationkey AS VARCHAR) AS pop, count(*) AS n FROM var JOIN supplier ON ind = 'i' || s_suppkey WHERE s_acctbal > 0 GROUP BY s_nationkey""", i="n")
def split_by_population(spark, sf):
    m = table(spark, sf, "supplier").select(F.concat(F.lit("i"), F.col("s_suppkey").cast("string")).alias("ind"),
                                            F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).otherwise(" ").alias("pop"))
    return op.with_population(variants(spark, sf), m).groupBy("pop").agg(F.count(F.lit(1)).alias("n"))


@query("pairs_within", "J-13", sql="""SELECT a.o_custkey AS site, a.o_orderkey AS id_a, b.o_orderkey AS id_b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey""", i="site id_a id_b")
def pairs_within(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("id"))
    return op.pairs_within(d, ["site"], "id", block=8)


@query("attach_factors", "J-14", sql=f"""WITH {OBS}, d AS (SELECT site, part, sum(abundance) AS density FROM obs WHERE discount > 0.02 GROUP BY ALL)
SELECT site, part, density * 100 AS density, s_nationkey AS nation, p_type AS family FROM d LEFT JOIN supplier ON s_suppkey = site LEFT JOIN part ON p_partkey = part""", r="density:2", i="site part nation")
def attach_factors(spark, sf):
    d = observations(spark, sf).groupBy("site", "part").agg(F.sum(F.when(F.col("discount") > 0.02, F.col("abundance"))).alias("density"))
    u = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site"), F.col("s_nationkey").alias("nation"))
    s = table(spark, sf, "part").select(F.col("p_partkey").alias("part"), F.col("p_type").alias("family"))
    return op.attach_factors(d, u, s, "density", unit="site", code="part")
