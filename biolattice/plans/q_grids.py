"""Grid and raster queries (R)."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.scale import cut_lineage
from ..operators import distribution as dist, grids as op, pixels as px
from .registry import query
from .views import BANDS, GRID, PIX, SIGHTINGS, ocean_grid, pixels, sightings, table



@query("grid_filter_value", "R-01", sql=f"WITH {GRID} SELECT time, lat, lon, CASE WHEN chl BETWEEN 40 AND 60 THEN chl END AS chl FROM grid", r="lat lon chl:6")
def grid_filter_value(spark, sf):
    return op.grid_filter(ocean_grid(spark, sf), "chl#bi#40#60", "chl")


@query("grid_filter_slice", "R-01 R-03", sql=f"WITH {GRID} SELECT time, lat, lon, chl FROM grid WHERE lat >= 33 AND lat BETWEEN 31 AND 36.5 AND lon BETWEEN -8 AND -1", r="lat lon chl:6")
def grid_filter_slice(spark, sf):
    d = op.grid_filter(ocean_grid(spark, sf), "lat#ge#33", "chl")
    return op.area_select(d, 31, 36.5, -8, -1)


@query("grid_filter_nearest", "R-01", sql=f"WITH {GRID} SELECT time, lat, lon, chl FROM grid WHERE lat = 33.5", r="lat lon chl:6")
def grid_filter_nearest(spark, sf):
    return op.grid_filter(ocean_grid(spark, sf), "lat#e#33.4", "chl")


@query("time_select", "R-02", sql=f"""WITH {GRID} SELECT 'sl' AS op, count(*) AS n, sum(chl) AS chl FROM grid WHERE time BETWEEN '1996-02-01' AND '1997-03-15' UNION ALL SELECT 'to', count(*), sum(chl) FROM grid WHERE time <= '1996-02-01'
UNION ALL SELECT 'from', count(*), sum(chl) FROM grid WHERE time >= '1999-05-05' UNION ALL SELECT 'is', count(*), sum(chl) FROM grid WHERE time = '1998-07-01'""", r="chl:2", i="n")
def time_select(spark, sf):
    g = ocean_grid(spark, sf)
    parts = [op.time_select(g, o, a, b).agg(F.lit(o).alias("op"), F.count(F.lit(1)).alias("n"), F.sum("chl").alias("chl"))
             for o, a, b in (("sl", "1996-02-01", "1997-03-15"), ("to", "1996-02-01", None), ("from", "1999-05-05", None), ("is", "1998-07-09", None))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("nearest_cell", "R-04", sql=f"""WITH {GRID}, b AS (SELECT lat, lon FROM grid WHERE time = (SELECT min(time) FROM grid) AND chl IS NOT NULL ORDER BY pow(lat - 33.27, 2) + pow(lon + 4.81, 2), lat, lon LIMIT 1)
SELECT time, lat, lon, chl FROM grid JOIN b USING (lat, lon)""", r="lat lon chl:6")
def nearest_cell(spark, sf):
    return op.nearest_cell(ocean_grid(spark, sf), 33.27, -4.81, "chl", with_value=True)


PLACES = "pl AS (SELECT c_custkey AS place, 29.9 + c_custkey % 97 / 10.0::DOUBLE AS plat, -10.2 + c_custkey % 113 / 10.0::DOUBLE AS plon FROM customer)"


def _places(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("place"), (29.9 + k % 97 / 10.0).alias("lat"), (-10.2 + k % 113 / 10.0).alias("lon"))


@query("select_at_points", "R-05", sql=f"""WITH {GRID}, {PLACES}, la AS (SELECT place, arg_max(lat, (-abs(lat - plat), lat)) AS lat FROM pl, (SELECT DISTINCT lat FROM grid) GROUP BY place),
lo AS (SELECT place, arg_max(lon, (-abs(lon - plon), lon)) AS lon FROM pl, (SELECT DISTINCT lon FROM grid) GROUP BY place)
SELECT place, count(*) AS n, sum(chl) AS chl FROM la JOIN lo USING (place) JOIN grid USING (lat, lon) GROUP BY place""", r="chl:3", i="place n")
def select_at_points(spark, sf):
    d = op.select_at_points(ocean_grid(spark, sf), _places(spark, sf), "chl")
    return d.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("chl").alias("chl"))


@query("index_select", "R-06", sql=f"WITH {GRID}, r AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM grid)) SELECT time, lat, lon, chl FROM grid JOIN r USING (time) WHERE i >= 5 AND i < 12", r="lat lon chl:6")
def index_select(spark, sf):
    return op.index_select(ocean_grid(spark, sf), "time", 5, 12)


@query("grid_where", "R-07 R-08", sql=f"WITH {GRID} SELECT time, lat, lon, CASE WHEN coalesce(chl > 45 AND lat < 35, false) THEN chl ELSE -1 END * 2 AS chl FROM grid", r="lat lon chl:6")
def grid_where(spark, sf):
    return op.scale(op.where(ocean_grid(spark, sf), "chl > 45 and lat < 35", ["chl"], other=-1.0), ["chl"], 2.0)


@query("timeseries", "R-09", sql=f"WITH {GRID} SELECT time, lon, lat, chl FROM grid WHERE lat = 34.0 AND lon = -5.5 AND time BETWEEN '1996-01-01' AND '2000-01-01' AND chl IS NOT NULL", r="lat lon chl:6")
def timeseries(spark, sf):
    return op.timeseries(ocean_grid(spark, sf), "chl", 33.9, -5.6, "1996-01-01", "2000-01-01")


@query("dimension_summary", "R-10", sql=f"WITH {GRID} SELECT 'chl' AS variable, 3 AS n_dims, 'time=' || count(DISTINCT time) || ',lat=' || count(DISTINCT lat) || ',lon=' || count(DISTINCT lon) AS dims FROM grid UNION ALL SELECT 'lat', 1, 'lat=' || count(DISTINCT lat) FROM grid", i="n_dims")
def dimension_summary(spark, sf):
    d = op.dimension_summary(ocean_grid(spark, sf), ["time", "lat", "lon"], {"chl": ["time", "lat", "lon"], "lat": ["lat"]})
    return d.withColumn("dims", F.array_join(F.transform("dims", lambda x: F.concat_ws("=", x["dim"], x["size"].cast("string"))), ","))


@query("coordinate_values", "R-10", sql=f"WITH {GRID} SELECT row_number() OVER (ORDER BY lat) - 1 AS position, lat AS value FROM (SELECT DISTINCT lat FROM grid)", r="value", i="position")
def coordinate_values(spark, sf):
    return op.coordinate_values(ocean_grid(spark, sf), "lat")


def _sql_formula(text: str) -> str:
    """The formula with NULL for a zero divisor: each operand after a slash goes through nullif."""
    out, i = "", 0
    while i < len(text):
        if text[i] != "/":
            out, i = out + text[i], i + 1
            continue
        j = i + 1
        while text[j] == " ":
            j += 1
        k = j
        while k < len(text) and (text[k].isalnum() or text[k] in "._"):
            k += 1
        if k < len(text) and text[k] == "(":
            depth = 1
            while depth:
                k += 1
                depth += (text[k] == "(") - (text[k] == ")")
            k += 1
        out, i = f"{out}/ nullif({_sql_formula(text[j:k])}, 0)", k
    return out


NAMES = px.ALL_INDICES + ["NDWI"]
# on these bands the two with a root or logarithm of differences can leave their domain
SQL_INDICES = ", ".join(f"{_sql_formula(px.INDEX_FORMULAS[n])} AS {n}" for n in NAMES if n not in ("LAI_SAVI",))


@query("spectral_indices", "R-11", sql=f"WITH {PIX}, rf AS (SELECT row, col, " + ", ".join(f"{b} / 10000 AS {b}" for b in BANDS) + f" FROM pix) SELECT row, col, {SQL_INDICES} FROM rf",
       r=" ".join(f"{n}:6" for n in NAMES if n != "LAI_SAVI"), i="row col")
def spectral_indices(spark, sf):
    return px.spectral_indices(pixels(spark, sf), NAMES).drop("code", "priority", "LAI_SAVI")


@query("closest_bands", "R-12", i="vec_id", sql="""WITH w AS (SELECT n, w FROM (VALUES ('B2', 496.6), ('B3', 560.0), ('B4', 664.5), ('B5', 703.9), ('B6', 740.2), ('B7', 782.5), ('B8', 835.1), ('B8A', 864.8), ('B11', 1613.7), ('B12', 2202.4)) t(n, w)),
s AS (SELECT vec_id, i, 400 + (vec_id % 7) * 3 + i * 29.0::DOUBLE AS x, v FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS i FROM embeddings)),
k AS (SELECT vec_id, n, i, v, row_number() OVER (PARTITION BY vec_id, n ORDER BY abs(x - w), i) AS r FROM w, s)
SELECT vec_id, n AS wanted, 'e' || i AS band, CAST(v AS DOUBLE) AS value FROM k WHERE r = 1""", r="value")
def closest_bands(spark, sf):
    spectra = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "value")).select(
        "vec_id", F.concat(F.lit("e"), F.col("i").cast("string")).alias("band"), "i", (400 + F.col("vec_id") % 7 * 3 + F.col("i") * 29.0).alias("wavelength"), "value")
    return px.nearest_bands(spectra, ["vec_id"], order="i").select("vec_id", "wanted", "band", "value")


@query("index_from_expression", "R-13", sql=f"WITH {PIX} SELECT row, col, (B8 - B4) / nullif(B8 + B4 + 0.5, 0) AS index FROM pix", r="index", i="row col")
def index_from_expression(spark, sf):
    return px.index_from_expression(pixels(spark, sf), "(B8 - B4) / (B8 + B4 + 0.5)").select("row", "col", "index")


@query("continuum_removal", "R-14", sql=f"WITH {PIX} SELECT row, col, B5 / (B4 + (B8 - B4) * ((703.9 - 664.5) / (835.1 - 664.5)::DOUBLE)) AS cr FROM pix", r="cr:5", i="row col")
def continuum_removal(spark, sf):
    return px.continuum_removal(pixels(spark, sf), "B5", "B4", "B8").select("row", "col", "cr")


@query("area_under_continuum", "R-14", sql=f"""WITH {PIX}, d AS (SELECT row, col, 1 - B5 / (B4 + (B7 - B4) * ((703.9 - 664.5) / 118.0::DOUBLE)) AS d5, 1 - B6 / (B4 + (B7 - B4) * ((740.2 - 664.5) / 118.0::DOUBLE)) AS d6 FROM pix)
SELECT row, col, d5 / 2 * (703.9 - 664.5) + (d5 + d6) / 2 * (740.2 - 703.9) + d6 / 2 * (782.5 - 740.2) AS auc FROM d""", r="auc:6", i="row col")
def area_under_continuum(spark, sf):
    return px.area_under_continuum(pixels(spark, sf), "B4", "B7").select("row", "col", "auc")


@query("block_aggregate", "R-15", sql=f"WITH {PIX} SELECT row // 10 AS row, col // 10 AS col, avg(B8) AS B8, avg(B4) AS B4 FROM pix GROUP BY ALL", r="B8:4 B4:4", i="row col")
def block_aggregate(spark, sf):
    return px.block_aggregate(pixels(spark, sf), 10, ["B8", "B4"])


@query("moving_diversity", "R-16", sql=f"""WITH {PIX}, v AS (SELECT row, col, CAST(B2 AS BIGINT) % 6 AS v FROM pix), o AS (SELECT i, j FROM range(-2, 3) a(i), range(-2, 3) b(j)),
n AS (SELECT c.row, c.col, w.v, count(*)::DOUBLE AS n FROM v w, o, v c WHERE c.row = w.row + i AND c.col = w.col + j GROUP BY ALL), t AS (SELECT *, n / sum(n) OVER (PARTITION BY row, col) AS p FROM n),
u AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY row, col ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, lag(v) OVER (PARTITION BY row, col ORDER BY v) AS pv FROM t)
SELECT row, col, -sum(p * ln(p)) AS shannon, -ln(sum(p * p)) AS renyi, max(p) AS berger_parker, CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) END AS pielou, 1 / sum(p * p) AS hill,
  2 * sum(p * v * (below + below + p - 1)) AS rao, coalesce(sum(CASE WHEN pv IS NOT NULL AND below < 1 THEN -(1 - below) * ln(1 - below) * (v - pv) END), 0) AS cre FROM u GROUP BY row, col""",
       r="shannon renyi berger_parker pielou hill rao cre", i="row col", d=5)
def moving_diversity(spark, sf):
    d = pixels(spark, sf).select("row", "col", (F.col("B2").cast("long") % 6).alias("value"))
    return px.moving_diversity(d, window=5)


@query("spectral_species", "R-17")
def spectral_species(spark, sf):
    d = dist.spectral_species(cut_lineage(pixels(spark, sf).select("row", "col", "B2", "B3", "B4", "B8")), ["B2", "B3", "B4", "B8"], k=12, components=3)
    return d.groupBy("spectral_species").agg(F.count(F.lit(1)).alias("n"))


@query("plot_diversity", "R-17", sql=f"""WITH {PIX}, s AS (SELECT row // 10 AS tr, col // 10 AS tc, CAST(B3 AS BIGINT) % 17 AS sp FROM pix), t AS (SELECT tr, tc, sp, count(*)::DOUBLE AS n FROM s GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY tr, tc) AS p FROM t)
SELECT tr, tc, count(*) AS richness, -sum(p * ln(p)) AS shannon, 1 - sum(p * p) AS simpson FROM p GROUP BY ALL""", r="shannon simpson", i="tr tc richness")
def plot_diversity(spark, sf):
    d = pixels(spark, sf).select(F.floor(F.col("row") / 10).alias("tr"), F.floor(F.col("col") / 10).alias("tc"), (F.col("B3").cast("long") % 17).alias("spectral_species"))
    return dist.plot_diversity(d, ["tr", "tc"]).drop("fisher")


@query("window_dissimilarity", "R-17", sql=f"""WITH {PIX}, t AS (SELECT row // 10 AS tile, col // 10 AS win, CAST(B3 AS BIGINT) % 17 AS sp, count(*)::DOUBLE AS n FROM pix GROUP BY ALL), z AS (SELECT tile, win, sum(n) AS s FROM t GROUP BY ALL),
sh AS (SELECT a.tile, a.win AS wa, b.win AS wb, sum(least(a.n, b.n)) AS m FROM t a JOIN t b ON a.tile = b.tile AND a.sp = b.sp AND a.win < b.win GROUP BY ALL)
SELECT x.tile, x.win AS win_a, y.win AS win_b, 1 - 2 * coalesce(m, 0) / (x.s + y.s) AS dissimilarity FROM z x JOIN z y ON x.tile = y.tile AND x.win < y.win LEFT JOIN sh ON sh.tile = x.tile AND wa = x.win AND wb = y.win""", r="dissimilarity", i="tile win_a win_b")
def window_dissimilarity(spark, sf):
    d = pixels(spark, sf).select(F.floor(F.col("row") / 10).alias("tile"), F.floor(F.col("col") / 10).alias("win"), (F.col("B3").cast("long") % 17).alias("spectral_species"))
    return dist.window_dissimilarity(d, ["tile"], "win")


@query("ordinate", "R-18")
def ordinate(spark, sf):
    d = pixels(spark, sf).select(F.lit(1).alias("tile"), (F.col("col") % 12).alias("win"), (F.col("B3").cast("long") % 17).alias("spectral_species"))
    w = cut_lineage(dist.window_dissimilarity(d, ["tile"], "win"))
    return dist.ordinate(w.select(F.col("win_a").alias("a"), F.col("win_b").alias("b"), F.col("dissimilarity").alias("distance")), 2)


@query("reclassify", "R-19", sql=f"WITH {PIX} SELECT row, col, CASE code WHEN 1 THEN 10 WHEN 2 THEN 10 WHEN 5 THEN 30 ELSE code END AS code FROM pix", i="row col code")
def reclassify(spark, sf):
    return px.reclassify(pixels(spark, sf).select("row", "col", "code"), {1: 10, 2: 10, 5: 30}, "code")


@query("land_cover_transition", "R-20", sql=f"""WITH {PIX}, d AS (SELECT row, col, CASE WHEN code < 3 THEN 1 WHEN code < 6 THEN 2 ELSE 3 END AS before, CASE WHEN CAST(B2 AS BIGINT) % 9 < 4 THEN 1 WHEN CAST(B2 AS BIGINT) % 9 < 7 THEN 2 ELSE 3 END AS after FROM pix)
SELECT row, col, before, after, CASE before * 10 + after WHEN 11 THEN 1 WHEN 22 THEN 2 WHEN 33 THEN 3 ELSE before * 10 + after END AS transition,
  CASE WHEN before * 10 + after IN (12, 13) THEN -1 WHEN before * 10 + after IN (21, 31) THEN 1 WHEN before * 10 + after IN (11, 22, 33) THEN 0 ELSE before * 10 + after END AS degradation FROM d""", i="row col before after transition degradation")
def land_cover_transition(spark, sf):
    p = pixels(spark, sf)
    b = p.select("row", "col", F.when(F.col("code") < 3, 110).when(F.col("code") < 6, 120).otherwise(130).alias("code"))
    k = F.col("B2").cast("long") % 9
    a = p.select("row", "col", F.when(k < 4, 110).when(k < 7, 120).otherwise(130).alias("code"))
    return px.land_cover_transition(b, a, {110: 100, 120: 200, 130: 300}, [100, 200, 300], {12: -1, 13: -1, 21: 1, 31: 1, 11: 0, 22: 0, 33: 0}, {11: 1, 22: 2, 33: 3})


@query("mosaic", "R-21", sql=f"WITH {PIX} SELECT row, col, CASE WHEN priority LIKE '1%' AND code <> 0 THEN B4 ELSE B3 END AS value FROM pix", r="value:2", i="row col")
def mosaic(spark, sf):
    p = pixels(spark, sf)
    a = p.select("row", "col", F.col("B3").alias("value"))
    b = p.filter("priority LIKE '1%'").select("row", "col", F.when(F.col("code") != 0, F.col("B4")).otherwise(-1.0).alias("value"))
    return px.mosaic([a, b], nodata=-1.0)


@query("stack_bands", "R-22", sql=f"WITH {PIX} SELECT row, col, B2 AS blue, CASE WHEN code > 2 THEN B4 END AS red FROM pix", r="blue:2 red:2", i="row col")
def stack_bands(spark, sf):
    p = pixels(spark, sf)
    return px.stack_bands({"blue": p.select("row", "col", F.col("B2").alias("value")), "red": p.filter("code > 2").select("row", "col", F.col("B4").alias("value"))})


@query("overviews", "R-23", sql=f"WITH {PIX} SELECT level, row // level AS row, col // level AS col, avg(B8) AS B8 FROM pix, (SELECT unnest([2, 4, 8]) AS level) GROUP BY ALL", r="B8:4", i="level row col")
def overviews(spark, sf):
    return px.overviews(pixels(spark, sf), [2, 4, 8], ["B8"])


@query("resample", "R-24", sql=f"""WITH {PIX}, e AS (SELECT CAST(ceil((max(row) + 1) / 1.6) AS BIGINT) AS h, CAST(ceil((max(col) + 1) / 2.5) AS BIGINT) AS w FROM pix),
t AS (SELECT r, c, 0.0 + (c + 0.5) * 2.5 AS x, 100.0 - (r + 0.5) * 1.6 AS y FROM (SELECT unnest(range(0, (SELECT h FROM e))) AS r) a, (SELECT unnest(range(0, (SELECT w FROM e))) AS c) b)
SELECT r AS row, c AS col, B8 FROM t JOIN pix ON pix.col = CAST(floor(x) AS BIGINT) AND pix.row = CAST(floor(100.0 - y) AS BIGINT)""", r="B8:2", i="row col")
def resample(spark, sf):
    p = pixels(spark, sf)
    rows, cols = p.agg(F.max("row") + 1, F.max("col") + 1).first()
    return px.resample(p, (0, 100, 1, 1), (0, 100, 2.5, 1.6), (math.ceil(rows / 1.6), math.ceil(cols / 2.5)), ["B8"])


@query("project_points", "R-24", sql=f"""WITH {SIGHTINGS}, p AS (SELECT sighting_id, radians(lat) AS la, radians(((lon - 10 + 180) % 360 + 360) % 360 - 180) AS lo, radians(52) AS p0 FROM sightings),
k AS (SELECT *, sqrt(2 / (1 + sin(p0) * sin(la) + cos(p0) * cos(la) * cos(lo))) AS k FROM p)
SELECT sighting_id, k * cos(la) * sin(lo) * 6371007.0 AS x, k * (cos(p0) * sin(la) - sin(p0) * cos(la) * cos(lo)) * 6371007.0 AS y FROM k""", r="x:2 y:2", i="sighting_id")
def project_points(spark, sf):
    return px.project_points(sightings(spark, sf), "lambert_azimuthal", 52, 10).select("sighting_id", "x", "y")


_N = 1 / 298.257223563 / (2 - 1 / 298.257223563)
_E, _AA = 2 * math.sqrt(_N) / (1 + _N), 6378137.0 / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_AL = px.TM["forward"]
UTM = f"""u AS (SELECT sighting_id, lat, lon, CAST(floor(((lon + 180) % 360 + 360) % 360 / 6) + 1 AS INTEGER) AS zone FROM sightings),
u1 AS (SELECT *, radians(((lon - (zone * 6 - 183) + 180) % 360 + 360) % 360 - 180) AS lo, sin(radians(lat)) AS s FROM u),
u2 AS (SELECT *, sinh(atanh(s) - {_E!r}::DOUBLE * atanh({_E!r}::DOUBLE * s)) AS t FROM u1),
u3 AS (SELECT *, atan2(t, cos(lo)) AS xi, atanh(sin(lo) / sqrt(1 + t * t)) AS eta FROM u2)"""


@query("utm_there_and_back", "R-24", sql=f"""WITH {SIGHTINGS}, {UTM}
SELECT sighting_id, zone, 500000 + 0.9996::DOUBLE * {_AA!r}::DOUBLE * (eta + {' + '.join(f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(_AL, 1))}) AS x,
  0.9996::DOUBLE * {_AA!r}::DOUBLE * (xi + {' + '.join(f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(_AL, 1))}) + CASE WHEN lat < 0 THEN 10000000 ELSE 0 END AS y,
  lat, lon FROM u3""", r="x:2 y:2 lat:6 lon:6", i="sighting_id zone")
def utm_there_and_back(spark, sf):
    d = px.to_utm(sightings(spark, sf).withColumn("zone", px.utm_zone()))
    d = d.select("sighting_id", "zone", "x", "y", (F.col("lat") < 0).alias("south"))
    return px.from_utm(d).drop("south")


@query("raster_stats", "R-25", sql=f"WITH {PIX} SELECT 'B2' AS band, min(B2) AS min, max(B2) AS max, avg(B2) AS mean, stddev_samp(B2) AS sd, count(B2) AS n, min(row) AS row_min, max(row) AS row_max, min(col) AS col_min, max(col) AS col_max FROM pix "
       "UNION ALL SELECT 'B8', min(B8), max(B8), avg(B8), stddev_samp(B8), count(B8), min(row), max(row), min(col), max(col) FROM pix", r="min:2 max:2 mean:4 sd:4", i="n row_min row_max col_min col_max")
def raster_stats(spark, sf):
    return px.raster_stats(pixels(spark, sf), ["B2", "B8"])


@query("raster_histogram", "R-25", sql=f"WITH {PIX} SELECT least(floor((B8 - 500) / 6000 * 32), 31) AS bin, count(*) AS n FROM pix WHERE B8 BETWEEN 500 AND 6500 GROUP BY 1", i="bin n")
def raster_histogram(spark, sf):
    return px.raster_histogram(pixels(spark, sf), "B8", 500, 6500, 32)


@query("points_to_geojson", "R-26", sql=f"""WITH {SIGHTINGS} SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || (nation * 2) || '.0,' || (nation + 3) || '.0]}},"properties":{{"sighting_id":' || sighting_id || ',"species":"' || species || '"}}}}' AS feature FROM sightings""")
def points_to_geojson(spark, sf):
    d = sightings(spark, sf).select("sighting_id", "species", (F.col("nation") + 3.0).alias("lat"), (F.col("nation") * 2.0).alias("lon"))
    return px.points_to_geojson(d)


@query("bracketing_cells", "R-27", sql=f"WITH {GRID} SELECT max(CASE WHEN lon < -7.3 THEN lon END) AS west, min(CASE WHEN lon > -2.2 THEN lon END) AS east, max(CASE WHEN lat < 32.1 THEN lat END) AS south, min(CASE WHEN lat > 36.2 THEN lat END) AS north FROM grid", r="west east south north")
def bracketing_cells(spark, sf):
    return op.bracketing_cells(ocean_grid(spark, sf), -7.3, -2.2, 32.1, 36.2)


@query("shift_longitude", "R-28", sql=f"WITH {SIGHTINGS} SELECT sighting_id, lon FROM sightings", r="lon", i="sighting_id")
def shift_longitude(spark, sf):
    d = sightings(spark, sf).select("sighting_id", F.pmod("lon", F.lit(360.0)).alias("lon"))
    return op.shift_longitude(d)
