"""Rasters as pixel tables: row, col and bands (R-11 .. R-16, R-19 .. R-26)."""
from __future__ import annotations

import ast
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Centre wavelengths (nm) of the bands used by the indices.
BAND_WAVELENGTHS = {"B2": 496.6, "B3": 560.0, "B4": 664.5, "B5": 703.9, "B6": 740.2, "B7": 782.5, "B8": 835.1,
                    "B8A": 864.8, "B11": 1613.7, "B12": 2202.4}

# Index formulas on reflectance, as published; a zero denominator gives NULL.
INDEX_FORMULAS = {
    "ARI1": "1 / B3 - 1 / B5",
    "ARI2": "B8 / B2 - B8 / B3",
    "ARVI": "(B8 - (2 * B4 - B2)) / (B8 + (2 * B4 - B2))",
    "BAI": "1 / (pow(0.1 - B4, 2) + pow(0.06 - B8, 2))",
    "BAIS2": "(1 - sqrt(B6 * B7 * B8A / B4)) * ((B12 - B8A) / sqrt(B12 + B8A) + 1)",
    "CCCI": "((B8 - B5) / (B8 + B5)) / ((B8 - B4) / (B8 + B4))",
    "CHL_RE": "B5 / B8",
    "CRI1": "1 / B2 - 1 / B3",
    "CRI2": "1 / B2 - 1 / B5",
    "EVI": "2.5 * (B8 - B4) / (B8 + 6 * B4 - 7.5 * B2 + 1)",
    "EVI2": "2.5 * (B8 - B4) / (B8 + 2.4 * B4 + 1)",
    "GRVI1": "(B4 - B3) / (B4 + B3)",
    "GNDVI": "(B8 - B3) / (B8 + B3)",
    "IRECI": "(B7 - B4) * (B6 / B5)",
    "LAI_SAVI": "-ln(0.371 + 1.5 * (B8 - B4) / (B8 + B4 + 0.5)) / 2.4",
    "MCARI": "1 - 0.2 * (B5 - B3) / (B5 - B4)",
    "mNDVI705": "(B6 - B5) / (B6 + B5 - 2 * B2)",
    "MSAVI2": "(B8 + 1) - 0.5 * sqrt(pow(2 * B8 - 1, 2) + 8 * B4)",
    "MSI": "B11 / B8A",
    "mSR705": "(B6 - B2) / (B5 - B2)",
    "MTCI": "(B6 - B5) / (B5 + B4)",
    "nBR_RAW": "(B8 - B12) / (B8 + B12)",
    "NDI_45": "(B5 - B4) / (B5 + B4)",
    "NDII": "(B8A - B11) / (B8A + B11)",
    "NDSI": "(B3 - B11) / (B3 + B11)",
    "NDVI": "(B8 - B4) / (B8 + B4)",
    "NDVI_G": "B3 * (B8 - B4) / (B8 + B4)",
    "NDVI705": "(B6 - B5) / (B6 + B5)",
    "NDWI": "(B3 - B8) / (B3 + B8)",
    "NDWI1": "(B8A - B11) / (B8A + B11)",
    "NDWI2": "(B8A - B12) / (B8A + B12)",
    "PSRI": "(B4 - B2) / B5",
    "PSRI_NIR": "(B4 - B2) / B8",
    "RE_NDVI": "(B8 - B6) / (B8 + B6)",
    "RE_NDWI": "(B4 - B6) / (B4 + B6)",
    "S2REP": "705 + 35 * (0.5 * (B8 + B5) - B6) / (B7 - B6)",
    "SAVI": "1.5 * (B8 - B5) / (B8 + B5 + 0.5)",
    "SIPI": "(B8 - B2) / (B8 - B4)",
    "SR": "B8 / B4",
    "CR_SWIR": "B11 / (B8A + (1613.7 - 864.8) * (B12 - B8A) / (2202.4 - 864.8))",
}
ALL_INDICES = [n for n in INDEX_FORMULAS if n != "NDWI"]


def formula(text: str) -> Column:
    """Arithmetic on band names as a column; a zero divisor gives NULL."""
    calls = {"sqrt": F.sqrt, "ln": F.ln, "log": F.ln, "log10": F.log10, "exp": F.exp, "abs": F.abs, "pow": F.pow,
             "least": F.least, "greatest": F.greatest}
    binary = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b,
              ast.Div: F.try_divide, ast.Pow: F.pow}

    def walk(n) -> Column:
        if isinstance(n, ast.BinOp) and type(n.op) in binary:
            return binary[type(n.op)](walk(n.left), walk(n.right))
        if isinstance(n, ast.UnaryOp) and isinstance(n.op, ast.USub):
            return -walk(n.operand)
        if isinstance(n, ast.Call) and isinstance(n.func, ast.Name) and n.func.id in calls:
            return calls[n.func.id](*[walk(a) for a in n.args])
        if isinstance(n, ast.Name):
            return F.col(n.id).cast("double")
        if isinstance(n, ast.Constant) and isinstance(n.value, (int, float)):
            return F.lit(float(n.value))
        raise ValueError(f"not a band formula: {text!r}")

    return walk(ast.parse(text.strip(), mode="eval").body)


def spectral_indices(df: DataFrame, names: Sequence[str] | str = "ALL", scale: float = 10000.0) -> DataFrame:
    """R-11: vegetation, water and soil indices as columns, from band columns B2 .. B12."""
    names = ALL_INDICES if names == "ALL" else list(names)
    refl = df.withColumns({b: F.col(b).cast("double") / scale for b in BAND_WAVELENGTHS if b in df.columns})
    keep = [c for c in df.columns if c not in BAND_WAVELENGTHS]
    return refl.select(*keep, *[formula(INDEX_FORMULAS[n]).alias(n) for n in names])


def closest_bands(wavelengths: Mapping[str, float], wanted: Mapping[str, float] = BAND_WAVELENGTHS) -> dict[str, str]:
    """R-12: for every reference band the sensor band of nearest wavelength (first on ties)."""
    return {w: min(wavelengths, key=lambda b: abs(wavelengths[b] - v)) for w, v in wanted.items()}


def nearest_bands(spectra: DataFrame, by: Sequence[str], band: str = "band", wavelength: str = "wavelength", value: str = "value",
                  order: str | None = None, wanted: Mapping[str, float] = BAND_WAVELENGTHS) -> DataFrame:
    """R-12 on data: for every spectrum (rows of band, wavelength, value) and reference band the band of nearest wavelength, the
    first in `order` on ties: by, wanted, band, value. One partial aggregate."""
    ref = F.array(*[F.struct(F.lit(n).alias("wanted"), F.lit(float(w)).alias("_w")) for n, w in wanted.items()])
    d = spectra.select(*by, band, wavelength, value, *([order] if order else []), F.inline(ref))
    first = F.struct(F.abs(F.col(wavelength) - F.col("_w")), F.col(order or band))
    return (d.groupBy(*by, "wanted").agg(F.min_by(F.struct(F.col(band), F.col(value)), first).alias("_b"))
             .select(*by, "wanted", F.col(f"_b.{band}").alias("band"), F.col(f"_b.{value}").alias("value")))


def index_from_expression(df: DataFrame, text: str, out: str = "index") -> DataFrame:
    """R-13: any band formula."""
    return df.withColumn(out, formula(text))


def continuum_ratio(target, w, low, w_low, high, w_high) -> Column:
    """R-14: band over the straight line between two bands."""
    line = low + (high - low) * ((w - w_low) / (w_high - w_low))
    return F.try_divide(target, line)


def continuum_removal(df: DataFrame, target: str, low: str, high: str, wavelengths: Mapping[str, float] = BAND_WAVELENGTHS,
                      out: str = "cr") -> DataFrame:
    """R-14: continuum-removed value of one band."""
    c = lambda b: F.col(b).cast("double")
    return df.withColumn(out, continuum_ratio(c(target), wavelengths[target], c(low), wavelengths[low], c(high), wavelengths[high]))


def area_under_continuum(df: DataFrame, low: str, high: str, wavelengths: Mapping[str, float] = BAND_WAVELENGTHS,
                         out: str = "auc") -> DataFrame:
    """R-14: trapezoid area between 1 and the continuum-removed bands inside (low, high)."""
    bands = [b for b, w in sorted(wavelengths.items(), key=lambda kv: kv[1]) if wavelengths[low] <= w <= wavelengths[high]]
    c = lambda b: F.col(b).cast("double")
    depth = {b: 1 - continuum_ratio(c(b), wavelengths[b], c(low), wavelengths[low], c(high), wavelengths[high]) for b in bands[1:-1]}
    area = F.lit(0.0)
    for a, b in zip(bands, bands[1:]):
        area = area + (depth.get(a, F.lit(0.0)) + depth.get(b, F.lit(0.0))) / 2 * (wavelengths[b] - wavelengths[a])
    return df.withColumn(out, area)


def block_aggregate(df: DataFrame, factor: int, bands: Sequence[str], row: str = "row", col: str = "col") -> DataFrame:
    """R-15: mean over factor x factor pixels."""
    return df.groupBy(F.floor(F.col(row) / factor).alias(row), F.floor(F.col(col) / factor).alias(col)).agg(
        *[F.avg(b).alias(b) for b in bands])


def window_counts(df: DataFrame, value: str, window: int, row: str, col: str) -> DataFrame:
    """How often each value occurs in the window around each pixel that exists.

    The window is summed first along columns and then along rows, so a pixel is copied
    2 x window times instead of window squared, and equal values merge in between.
    """
    h = window // 2
    off = F.explode(F.sequence(F.lit(-h), F.lit(h)))
    a = (df.select(row, F.col(col).alias("_c"), F.col(value).alias("_v"), off.alias("_o"))
           .groupBy(row, (F.col("_c") + F.col("_o")).alias(col), "_v").agg(F.count(F.lit(1)).alias("_n")))
    b = (a.select(F.col(row).alias("_r"), col, "_v", "_n", off.alias("_o"))
          .groupBy((F.col("_r") + F.col("_o")).alias(row), col, "_v").agg(F.sum("_n").alias("_n")))
    return b.join(df.select(row, col).distinct(), [row, col], "left_semi")


def moving_diversity(df: DataFrame, value: str = "value", window: int = 9, alpha: float = 2.0, row: str = "row", col: str = "col",
                     nodata: Sequence[float] | None = None, no_range: tuple[float, float] | None = (252, 255)) -> DataFrame:
    """R-16: Shannon, Renyi, Berger-Parker, Pielou, Hill, parametric Rao and cumulative residual
    entropy of the values in a moving window.

    Values in (252, 255] are missing by default. Rao and the residual entropy use the sorted values
    of one window (at most window squared), through running shares instead of value pairs.
    """
    d = df.filter(F.col(value).isNotNull())
    if no_range:
        d = d.filter(~((F.col(value) > no_range[0]) & (F.col(value) <= no_range[1])))
    if nodata:
        d = d.filter(~F.col(value).isin(list(nodata)))
    c = window_counts(d, value, window, row, col)
    n = F.col("_n").cast("double")
    g = c.groupBy(row, col).agg(
        F.sum(n).alias("_t"), (F.ln(F.sum(n)) - F.sum(n * F.ln(n)) / F.sum(n)).alias("shannon"),
        F.sum(F.pow(n, F.lit(float(alpha)))).alias("_a"), F.max(n).alias("_m"), F.count(F.lit(1)).alias("_s"),
        F.array_sort(F.collect_list(F.struct(F.col("_v").cast("double").alias("v"), n.alias("n")))).alias("_l"))
    t = F.col("_t")
    pa = F.col("_a") / F.pow(t, F.lit(float(alpha)))
    renyi = F.col("shannon") if alpha == 1 else F.ln(pa) / (1 - alpha)
    # running sums over sorted values: cum = share below, rao = sum p_i v_i (F_before + F_after - 1)
    start = F.struct(F.lit(0.0).alias("cum"), F.lit(0.0).alias("rao"), F.lit(0.0).alias("cre"), F.lit(None).cast("double").alias("last"))

    def merge(acc, x):
        p = x["n"] / t
        after = acc["cum"] + p
        left = 1 - acc["cum"]
        gain = F.when(acc["last"].isNotNull() & (left > 0), -left * F.ln(left) * (x["v"] - acc["last"])).otherwise(0.0)
        return F.struct(after.alias("cum"), (acc["rao"] + 2 * p * x["v"] * (acc["cum"] + after - 1)).alias("rao"),
                        (acc["cre"] + gain).alias("cre"), x["v"].alias("last"))

    g = g.withColumn("_f", F.aggregate("_l", start, merge))
    return g.select(row, col, "shannon", renyi.alias("renyi"), (F.col("_m") / t).alias("berger_parker"),
                    F.when(F.col("_s") > 1, F.col("shannon") / F.ln("_s")).alias("pielou"),
                    F.exp(renyi).alias("hill"), F.col("_f.rao").alias("rao"), F.col("_f.cre").alias("cre"))


def reclassify(df: DataFrame, mapping: Mapping[int, int] | DataFrame, col: str, out: str | None = None) -> DataFrame:
    """R-19: code to code, others unchanged. A table (old, new) joins instead of a literal map."""
    out = out or col
    if isinstance(mapping, DataFrame):
        m = mapping.select(F.col("old").alias(col), F.col("new").alias("_new"))
        d = df.join(m, col, "left")
        return d.withColumn(out, F.coalesce("_new", F.col(col))).drop("_new")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col).cast("int")), F.col(col).cast("int")))


def land_cover_transition(before: DataFrame, after: DataFrame, nesting: Mapping[int, int], class_codes: Sequence[int],
                          degradation: Mapping[int, int], persistence: Mapping[int, int], multiplier: int = 10,
                          code: str = "code", row: str = "row", col: str = "col") -> DataFrame:
    """R-20: transition code of two years by class positions, and its degradation class (-1, 0, 1)."""
    pos = {c: i + 1 for i, c in enumerate(sorted(class_codes))}
    prep = lambda d, n: reclassify(reclassify(d, nesting, code), pos, code).select(row, col, F.col(code).alias(n))
    d = prep(before, "before").join(prep(after, "after"), [row, col])
    d = d.withColumn("_t", F.col("before") * multiplier + F.col("after"))
    d = reclassify(d, persistence, "_t", "transition")
    return reclassify(d, degradation, "_t", "degradation").drop("_t")


def mosaic(images: Sequence[DataFrame], value: str = "value", nodata: float | None = None,
           extent: tuple[int, int, int, int] | None = None, row: str = "row", col: str = "col") -> DataFrame:
    """R-21: later images win; nodata never does; the extent is (row0, row1, col0, col1)."""
    parts = [d.select(row, col, value, F.lit(i).alias("_p")) for i, d in enumerate(images)]
    d = reduce(DataFrame.unionByName, parts).filter(F.col(value).isNotNull())
    if nodata is not None:
        d = d.filter(F.col(value) != nodata)
    if extent:
        d = d.filter(F.col(row).between(extent[0], extent[1]) & F.col(col).between(extent[2], extent[3]))
    return d.groupBy(row, col).agg(F.max_by(value, "_p").alias(value))


def stack_bands(images: Mapping[str, DataFrame], value: str = "value", row: str = "row", col: str = "col") -> DataFrame:
    """R-22: images as band columns of one table; one shuffle for any number of images."""
    parts = [d.select(row, col, F.lit(n).alias("_b"), F.col(value).alias("_v")) for n, d in images.items()]
    d = reduce(DataFrame.unionByName, parts)
    return d.groupBy(row, col).agg(*[F.max(F.when(F.col("_b") == n, F.col("_v"))).alias(n) for n in images])


def overviews(df: DataFrame, levels: Sequence[int], bands: Sequence[str], row: str = "row", col: str = "col") -> DataFrame:
    """R-23: coarser copies for several levels in one pass."""
    d = df.withColumn("level", F.explode(F.array(*[F.lit(int(l)) for l in levels])))
    return d.groupBy("level", F.floor(F.col(row) / F.col("level")).alias(row), F.floor(F.col(col) / F.col("level")).alias(col)).agg(
        *[F.avg(b).alias(b) for b in bands])


def resample(df: DataFrame, source: Sequence[float], target: Sequence[float], shape: tuple[int, int], bands: Sequence[str],
             row: str = "row", col: str = "col") -> DataFrame:
    """R-24: nearest-pixel resampling between two north-up grids (x0, y0, pixel width, pixel height).

    Every source pixel writes the target pixels whose centres it covers, so nothing is joined.
    """
    sx, sy, sw, sh = source
    tx, ty, tw, th = target
    first = lambda lo, t0, ts: F.ceil((lo - t0) / ts - 0.5)
    x_lo, y_hi = sx + F.col(col) * sw, sy - F.col(row) * sh
    c0, c1 = first(x_lo, tx, tw), first(x_lo + sw, tx, tw) - 1
    r0, r1 = F.ceil((ty - y_hi) / th - 0.5), F.ceil((ty - (y_hi - sh)) / th - 0.5) - 1
    span = lambda a, b: F.when(b >= a, F.sequence(a.cast("long"), b.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    d = df.select(*bands, F.explode(span(r0, r1)).alias("_r"), c0.alias("_c0"), c1.alias("_c1"))
    d = d.select(*bands, F.col("_r").alias(row), F.explode(span(F.col("_c0"), F.col("_c1"))).alias(col))
    return d.filter(F.col(row).between(0, shape[0] - 1) & F.col(col).between(0, shape[1] - 1)).select(row, col, *bands)


def _tm_series(a: float, inv_f: float) -> dict:
    """Coefficients of the transverse Mercator series in the third flattening, to its fourth power."""
    f = 1 / inv_f
    n = f / (2 - f)
    return {
        "e": 2 * math.sqrt(n) / (1 + n), "A": a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64),
        "forward": [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
                    61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280],
        "back": [n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360, n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440,
                 17 * n ** 3 / 480 - 37 * n ** 4 / 840, 4397 * n ** 4 / 161280],
        "lat": [2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45, 7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45,
                56 * n ** 3 / 15 - 136 * n ** 4 / 35, 4279 * n ** 4 / 630]}


TM = _tm_series(6378137.0, 298.257223563)
UTM_SCALE, UTM_EAST, UTM_NORTH = 0.9996, 500000.0, 10000000.0


def utm_zone(lon: str = "lon") -> Column:
    """Number of the 6 degree zone, 1 .. 60."""
    return (F.floor(F.pmod(F.col(lon) + 180, F.lit(360.0)) / 6) + 1).cast("int")


def to_utm(df: DataFrame, zone: str = "zone", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-24: metres east `x` and north `y` in the given zone; southern points have 10,000 km added."""
    lo = F.radians(F.pmod(F.col(lon) - (F.col(zone) * 6 - 183) + 180, F.lit(360.0)) - 180)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - TM["e"] * F.atanh(TM["e"] * s))
    xi, eta = F.atan2(t, F.cos(lo)), F.atanh(F.sin(lo) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(TM["forward"], 1):
        x, y = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta), y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    m = UTM_SCALE * TM["A"]
    return df.withColumns({"x": UTM_EAST + m * x, "y": m * y + F.when(F.col(lat) < 0, UTM_NORTH).otherwise(0.0)})


def from_utm(df: DataFrame, zone: str = "zone", south: str = "south", x: str = "x", y: str = "y", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-24: latitude and longitude of metres in a zone; `south` marks points of the southern half."""
    m = UTM_SCALE * TM["A"]
    xi = (F.col(y) - F.when(F.col(south), UTM_NORTH).otherwise(0.0)) / m
    eta = (F.col(x) - UTM_EAST) / m
    u, v = xi, eta
    for j, b in enumerate(TM["back"], 1):
        u, v = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta), v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    c = F.asin(F.sin(u) / F.cosh(v))
    la = c
    for j, d in enumerate(TM["lat"], 1):
        la = la + d * F.sin(2 * j * c)
    lo = F.degrees(F.atan2(F.sinh(v), F.cos(u))) + (F.col(zone) * 6 - 183)
    return df.withColumns({lat: F.degrees(la), lon: F.pmod(lo + 180, F.lit(360.0)) - 180})


def project_points(df: DataFrame, projection: str, lat0: float = 0.0, lon0: float = 0.0, lat: str = "lat", lon: str = "lon",
                   radius: float = 6371007.0) -> DataFrame:
    """R-24: equirectangular, Mercator or Lambert azimuthal equal-area coordinates on the sphere."""
    la, lo = F.radians(lat), F.radians(F.pmod(F.col(lon) - lon0 + 180, F.lit(360.0)) - 180)
    p0 = math.radians(lat0)
    if projection == "equirectangular":
        x, y = lo * math.cos(p0), la - p0
    elif projection == "mercator":
        x, y = lo, F.ln(F.tan(F.lit(math.pi / 4) + la / 2))
    elif projection == "lambert_azimuthal":
        k = F.sqrt(F.try_divide(F.lit(2.0), 1 + math.sin(p0) * F.sin(la) + math.cos(p0) * F.cos(la) * F.cos(lo)))
        x = k * F.cos(la) * F.sin(lo)
        y = k * (math.cos(p0) * F.sin(la) - math.sin(p0) * F.cos(la) * F.cos(lo))
    else:
        raise ValueError(f"unknown projection {projection!r}")
    return df.withColumn("x", x * radius).withColumn("y", y * radius)


def raster_stats(df: DataFrame, bands: Sequence[str], row: str = "row", col: str = "col") -> DataFrame:
    """R-25: min, max, mean, sd and number per band, with the extent."""
    stats = ("min", "max", "mean", "sd", "n")
    f = {"min": F.min, "max": F.max, "mean": F.avg, "sd": F.stddev_samp, "n": F.count}
    g = df.agg(*[f[s](b).alias(f"{b}_{s}") for b in bands for s in stats], F.min(row).alias("row_min"), F.max(row).alias("row_max"),
               F.min(col).alias("col_min"), F.max(col).alias("col_max"))
    rows = F.array(*[F.struct(F.lit(b).alias("band"), *[F.col(f"{b}_{s}").alias(s) for s in stats]) for b in bands])
    return g.select(F.inline(rows), "row_min", "row_max", "col_min", "col_max")


def raster_histogram(df: DataFrame, band: str, low: float, high: float, bins: int = 256) -> DataFrame:
    """R-25: counts in equal bins; values outside the range are left out."""
    b = F.least(F.floor((F.col(band) - low) / (high - low) * bins), F.lit(bins - 1))
    return (df.filter(F.col(band).between(low, high)).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))


def points_to_geojson(df: DataFrame, lat: str = "lat", lon: str = "lon", properties: Sequence[str] | None = None) -> DataFrame:
    """R-26: one GeoJSON feature per row, as text."""
    props = list(properties) if properties is not None else [c for c in df.columns if c not in (lat, lon)]
    geom = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"),
                                        F.struct(*props).alias("properties"))).alias("feature"))


def write_geojson(df: DataFrame, path: str, mode: str = "error", **kw) -> None:
    """R-26: newline-delimited features, one file per partition."""
    points_to_geojson(df, **kw).write.mode(mode).text(path)
