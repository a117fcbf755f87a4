"""The given tables seen as survey data: the same views as DataFrames and as SQL."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; timestamps without zone are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def scratch(spark: SparkSession) -> str:
    """A new folder path beside the checkpoints (shared on a cluster), for write-and-read queries."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="scratch-")
    return os.path.join(base, f"q-{uuid.uuid4().hex}")


# ---- long observations: site, year, species, abundance -------------------------------------

def observations(spark, sf) -> DataFrame:
    l, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return (l.join(p, l.l_partkey == p.p_partkey)
             .select(F.col("l_suppkey").alias("site"), F.year("l_shipdate").alias("year"), F.col("p_brand").alias("species"),
                     F.col("p_type").alias("kind"), F.col("p_size").alias("size_class"), F.col("l_quantity").alias("abundance"),
                     F.col("l_extendedprice").alias("biomass"), F.col("l_linenumber").alias("rotation"),
                     F.col("l_orderkey").alias("visit"), F.to_date("l_shipdate").alias("date"), F.col("l_partkey").alias("part"),
                     F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")))


OBS = """obs AS (SELECT l_suppkey AS site, CAST(year(l_shipdate) AS INTEGER) AS year, p_brand AS species, p_type AS kind,
  p_size AS size_class, l_quantity AS abundance, l_extendedprice AS biomass, l_linenumber AS rotation, l_orderkey AS visit,
  CAST(l_shipdate AS DATE) AS date, l_partkey AS part, l_discount AS discount, l_tax AS tax
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# ---- places with coordinates ---------------------------------------------------------------


def _coords(key: str):
    k = F.col(key)
    return ((k * 7919 + 13) % 16007 / F.lit(100.0) - 80.0).alias("lat"), ((k * 104729 + 7) % 35993 / F.lit(100.0) - 179.9).alias("lon")


def stations(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station_id"), *_coords("s_suppkey"),
                                               F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("reading"))


def sightings(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("sighting_id"), *_coords("c_custkey"), F.col("c_mktsegment").alias("species"),
                    F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("records"))


def _coords_sql(k: str) -> str:
    return (f"({k} * 7919 + 13) % 16007 / 100.0::DOUBLE - 80.0 AS lat, "
            f"({k} * 104729 + 7) % 35993 / 100.0::DOUBLE - 179.9 AS lon")


STATIONS = f"""stations AS (SELECT s_suppkey AS station_id, {_coords_sql('s_suppkey')}, s_nationkey AS nation,
  s_acctbal AS reading FROM supplier)"""
SIGHTINGS = f"""sightings AS (SELECT c_custkey AS sighting_id, {_coords_sql('c_custkey')}, c_mktsegment AS species,
  c_nationkey AS nation, c_acctbal AS records FROM customer)"""
DIST = """(2 * 6371010.0 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))))"""

# ---- acoustic detections -------------------------------------------------------------------


def detections(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return e.select(
        "event_id", "ts", F.concat_ws("-", F.concat(F.lit("f"), F.col("user_id").cast("string")), F.to_date("ts").cast("string")).alias("file"),
        F.col("event_type").alias("taxon"), (F.col("value") / 500.0).alias("prob"), F.unix_seconds("ts").cast("double").alias("time_num"),
        F.when(k % 9 != 0, "").when(k % 6 == 0, "click").otherwise(F.col("event_type")).alias("id_valid"),
        F.when(k % 9 != 0, "").when(k % 4 == 0, "SUR").when(k % 4 == 1, "PROBABLE").otherwise("POSSIBLE").alias("conf_valid"),
        F.to_date("ts").alias("night"), F.hour("ts").alias("hour"), k.alias("k"))


DET = r"""det AS (SELECT event_id, ts, 'f' || user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS file, event_type AS taxon,
  value / 500.0::DOUBLE AS prob, CAST(floor(epoch(ts)) AS DOUBLE) AS time_num, k,
  CASE WHEN k % 9 <> 0 THEN '' WHEN k % 6 = 0 THEN 'click' ELSE event_type END AS id_valid,
  CASE WHEN k % 9 <> 0 THEN '' WHEN k % 4 = 0 THEN 'SUR' WHEN k % 4 = 1 THEN 'PROBABLE' ELSE 'POSSIBLE' END AS conf_valid,
  CAST(ts AS DATE) AS night, CAST(hour(ts) AS INTEGER) AS hour
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events))"""

# ---- genotypes: ind, pop, locus, a1, a2; variants ------------------------------------------

LOCI = 6


def genotypes(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey"), F.col("c_nationkey"), F.explode(F.sequence(F.lit(1), F.lit(LOCI))).alias("l"))
    k, l = F.col("c_custkey"), F.col("l")
    skew = F.col("c_nationkey") % 3
    miss = (k * 31 + l * 17) % 29 == 0
    a1 = 100 + ((k * (7 * l + 3)) % 101) % (3 + skew)
    a2 = 100 + ((k * (11 * l + 5)) % 97) % (2 + skew)
    return c.select(k.alias("ind"), F.col("c_nationkey").alias("pop"), F.concat(F.lit("L"), l.cast("string")).alias("locus"),
                    F.when(~miss, a1).cast("int").alias("a1"), F.when(~miss, a2).cast("int").alias("a2"))


GEN = f"""gen AS (SELECT c_custkey AS ind, c_nationkey AS pop, 'L' || l AS locus,
  CASE WHEN (c_custkey * 31 + l * 17) % 29 <> 0 THEN CAST(100 + ((c_custkey * (7 * l + 3)) % 101) % (3 + c_nationkey % 3) AS INTEGER) END AS a1,
  CASE WHEN (c_custkey * 31 + l * 17) % 29 <> 0 THEN CAST(100 + ((c_custkey * (11 * l + 5)) % 97) % (2 + c_nationkey % 3) AS INTEGER) END AS a2
  FROM customer, (SELECT unnest(range(1, {LOCI + 1})) AS l))"""


def variants(spark, sf) -> DataFrame:
    """One row per (part, supplier): position, individual and a call."""
    v = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min("l_quantity").alias("q"), F.max("l_linenumber").alias("a"), F.min("l_linenumber").alias("b"), F.max("l_tax").alias("t"))
    gone = F.col("q") % 11 == 0
    gt = F.array((F.col("a") % 3 == 0).cast("int"), (F.col("b") % 2 == 0).cast("int"))
    return v.select(F.concat(F.lit("c"), (F.col("l_partkey") % 5).cast("string")).alias("chrom"), F.col("l_partkey").alias("pos"),
                    F.concat(F.lit("rs"), F.col("l_partkey").cast("string")).alias("id"), F.lit("A").alias("ref"),
                    F.when(F.col("l_partkey") % 10 == 0, F.array(F.lit("GT"))).when(F.col("l_partkey") % 10 == 1, F.array(F.lit("G"), F.lit("T")))
                    .otherwise(F.array(F.lit("G"))).alias("alt"),
                    F.concat(F.lit("i"), F.col("l_suppkey").cast("string")).alias("ind"), F.when(~gone, gt).alias("gt"),
                    F.round(F.col("t") * 1000).alias("gq"), F.col("q").alias("dp"))


VAR = """var AS (SELECT 'c' || (l_partkey % 5) AS chrom, l_partkey AS pos, 'i' || l_suppkey AS ind,
  CASE WHEN q % 11 <> 0 THEN CAST(a % 3 = 0 AS INTEGER) END AS g1, CASE WHEN q % 11 <> 0 THEN CAST(b % 2 = 0 AS INTEGER) END AS g2,
  CASE WHEN l_partkey % 10 = 1 THEN 2 ELSE 1 END AS n_alt, l_partkey % 10 <> 0 AS snp, round(t * 1000) AS gq, q AS dp
  FROM (SELECT l_partkey, l_suppkey, min(l_quantity) AS q, max(l_linenumber) AS a, min(l_linenumber) AS b, max(l_tax) AS t
        FROM lineitem GROUP BY ALL))"""

# ---- grids and pixels ----------------------------------------------------------------------


def ocean_grid(spark, sf) -> DataFrame:
    """Monthly grid: time, lat, lon, chl (mean price, scaled, NULL in a tenth of the cells)."""
    l = table(spark, sf, "lineitem")
    g = l.groupBy(F.trunc("l_shipdate", "month").alias("m"), (F.col("l_suppkey") % 19).alias("i"), (F.col("l_partkey") % 23).alias("j")).agg(
        F.avg("l_extendedprice").alias("v"))
    hole = (F.col("i") * 5 + F.col("j") * 3) % 10 == 0
    return g.select(F.col("m").cast("timestamp").alias("time"), (30 + F.col("i") * 0.5).alias("lat"), (-10 + F.col("j") * 0.5).alias("lon"),
                    F.when(~hole, F.col("v") / 1009).alias("chl"))


GRID = """grid AS (SELECT CAST(m AS TIMESTAMP) AS time, 30 + i * 0.5::DOUBLE AS lat, -10 + j * 0.5::DOUBLE AS lon,
  CASE WHEN (i * 5 + j * 3) % 10 <> 0 THEN v / 1009 END AS chl
  FROM (SELECT date_trunc('month', l_shipdate) AS m, l_suppkey % 19 AS i, l_partkey % 23 AS j, avg(l_extendedprice) AS v
        FROM lineitem GROUP BY ALL))"""

BANDS = {"B2": 7, "B3": 11, "B4": 13, "B5": 17, "B6": 19, "B7": 23, "B8": 29, "B8A": 31, "B11": 37, "B12": 41}


def pixels(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    c = F.floor(F.col("o_totalprice") * 100)
    return o.select((F.floor(F.col("o_orderkey") / 100)).alias("row"), (F.col("o_orderkey") % 100).alias("col"),
                    *[((c % (F.lit(m) * 199)) + 500).cast("double").alias(b) for b, m in BANDS.items()],
                    (F.col("o_custkey") % 9).cast("int").alias("code"), F.col("o_orderpriority").alias("priority"))


PIX = "pix AS (SELECT o_orderkey // 100 AS row, o_orderkey % 100 AS col, " + ", ".join(
    f"CAST(floor(o_totalprice * 100) % ({m} * 199) + 500 AS DOUBLE) AS {b}" for b, m in BANDS.items()) + (
    ", CAST(o_custkey % 9 AS INTEGER) AS code, o_orderpriority AS priority FROM orders)")
