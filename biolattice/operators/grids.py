"""Selection from labelled grids in long form (R-01 .. R-10, R-27, R-28)."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import nearest_marked, value_index
from .joins import nearest_point


def _nearest_value(df: DataFrame, dim: str, target) -> Column:
    """The coordinate value nearest to target (the larger one on a tie), as a scalar."""
    t = target if isinstance(target, Column) else F.lit(target)
    gap = (F.abs(F.unix_micros(F.col(dim)) - F.unix_micros(t.cast("timestamp")))
           if dict(df.dtypes)[dim].startswith("timestamp") else F.abs(F.col(dim) - t))
    return df.agg(F.max_by(F.col(dim), F.struct(-gap, F.col(dim)))).scalar()


def grid_filter(df: DataFrame, spec: str, variable: str) -> DataFrame:
    """R-01: `name#op#a#b`. On the variable, values outside become NULL; on a dimension rows are
    cut (bi, le, ge) or the nearest coordinate is taken (e)."""
    name, op, *args = spec.split("#")
    a = float(args[0])
    b = float(args[1]) if op == "bi" else None
    c = F.col(name)
    tests = {"bi": lambda: c.between(a, b), "le": lambda: c <= a, "ge": lambda: c >= a, "e": lambda: c == a}
    if op not in tests:
        raise ValueError(f"unknown operator {op!r} in {spec!r}")
    if name == variable:
        return df.withColumn(name, F.when(tests[op](), c))
    if op == "e":
        return df.filter(c == _nearest_value(df, name, a))
    return df.filter(tests[op]())


def time_select(df: DataFrame, op: str, a: str, b: str | None = None, time: str = "time") -> DataFrame:
    """R-02: `sl` between, `to`, `from`, `is` (nearest)."""
    t = F.col(time)
    A = F.lit(a).cast("timestamp")
    if op == "sl":
        return df.filter(t.between(A, F.lit(b).cast("timestamp")))
    if op == "to":
        return df.filter(t <= A)
    if op == "from":
        return df.filter(t >= A)
    if op == "is":
        return df.filter(t == _nearest_value(df, time, A))
    raise ValueError(f"unknown time operator {op!r}")


def area_select(df: DataFrame, south: float, north: float, west: float, east: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-03: box with its edges."""
    return df.filter(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def nearest_cell(df: DataFrame, at_lat: float, at_lon: float, variable: str, tolerance: float = 0.0, with_value: bool = False,
                 dims: Sequence[str] = ("time",), lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-04: the series of the nearest grid point, or of the nearest one that has a value.

    The mask is the first slice of the other dimensions. A positive tolerance leaves nothing when
    the point is farther in latitude or longitude.
    """
    if with_value:
        first = df
        for d in dims:
            first = first.filter(F.col(d) == df.agg(F.min(d)).scalar())
        gap = F.pow(F.col(lat) - at_lat, 2) + F.pow(F.col(lon) - at_lon, 2)
        best = first.filter(F.col(variable).isNotNull()).agg(F.min(F.struct(gap.alias("g"), F.col(lat).alias("la"), F.col(lon).alias("lo"))).alias("b"))
        la, lo = best.select("b.la").scalar(), best.select("b.lo").scalar()
    else:
        la, lo = _nearest_value(df, lat, at_lat), _nearest_value(df, lon, at_lon)
    out = df.filter((F.col(lat) == la) & (F.col(lon) == lo))
    if tolerance > 0:
        out = out.filter((F.abs(F.col(lat) - at_lat) <= tolerance) & (F.abs(F.col(lon) - at_lon) <= tolerance))
    return out


def select_at_points(df: DataFrame, places: DataFrame, variable: str, place: str = "place", with_value: bool = False,
                     dims: Sequence[str] = ("time",), lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-05: one series per place, from its nearest grid point.

    On the rectangular grid the nearest latitude and longitude are looked up separately among the
    coordinate values; with `with_value` the nearest point that has a value in the first slice is
    found by the cube descent of nearest_point.
    """
    if with_value:
        first = df
        for d in dims:
            first = first.filter(F.col(d) == df.agg(F.min(d)).scalar())
        pts = first.filter(F.col(variable).isNotNull()).select(F.concat_ws("|", lat, lon).alias("pt"), lat, lon)
        near = nearest_point(places, pts, place, "pt", lat, lon).select(place, "nearest_pt")
        keys = df.withColumn("nearest_pt", F.concat_ws("|", lat, lon))
        return near.join(keys, "nearest_pt").drop("nearest_pt")
    p = places.select(place, F.col(lat).cast("double").alias("_pla"), F.col(lon).cast("double").alias("_plo"))
    for dim, c in ((lat, "_pla"), (lon, "_plo")):
        vals = df.select(F.col(dim).cast("double").alias("_v")).distinct().withColumn("_m", F.lit(True))
        both = vals.unionByName(p.select(F.col(c).alias("_v")).distinct().withColumn("_m", F.lit(False)))
        near = nearest_marked(both, [], "_v", "_m", [], "_near").filter("NOT _m").select(F.col("_v").alias(c), F.col("_near_v").alias(f"_g{c}"))
        p = p.join(near, c)
    g = df.withColumn("_g_pla", F.col(lat).cast("double")).withColumn("_g_plo", F.col(lon).cast("double"))
    return p.select(place, "_g_pla", "_g_plo").join(g, ["_g_pla", "_g_plo"]).drop("_g_pla", "_g_plo")


def index_select(df: DataFrame, dim: str, start: int, stop: int) -> DataFrame:
    """R-06: rows whose coordinate is at position start .. stop - 1 among the sorted values."""
    vals = df.select(dim).distinct()
    num = F.unix_micros(F.col(dim)) if dict(df.dtypes)[dim].startswith("timestamp") else F.col(dim)
    idx = value_index(vals.withColumn("_num", num), [], "_num", [dim], "_i").filter(F.col("_i").between(start, stop - 1))
    return df.join(idx.select(dim), dim, "left_semi")


_WORDS = {"and", "or", "not", "is", "null", "between", "in", "like", "true", "false", "abs", "sqrt", "exp", "ln", "log10",
          "pow", "round", "floor", "ceil", "least", "greatest", "case", "when", "then", "else", "end"}


def checked_expr(df: DataFrame, text: str) -> Column:
    """A user's expression over the table's own columns and plain arithmetic."""
    bare = re.sub(r"'[^']*'", " ", text)
    if ";" in bare or "--" in bare or "/*" in bare:
        raise ValueError(f"not an expression: {text!r}")
    unknown = [w for w in re.findall(r"[A-Za-z_]\w*", bare)
               if w not in df.columns and w.lower() not in _WORDS and not re.fullmatch(r"[eE]\d*", w)]
    if unknown:
        raise ValueError(f"unknown name(s) {unknown} in {text!r}")
    return F.expr(text)


def where(df: DataFrame, condition: str, variables: Sequence[str], other: float | None = None, drop: bool = False) -> DataFrame:
    """R-07: outside the condition values become NULL or `other`, or rows are dropped."""
    ok = F.coalesce(checked_expr(df, condition), F.lit(False))
    if drop:
        return df.filter(ok)
    return df.withColumns({v: F.when(ok, F.col(v)).otherwise(F.lit(other)) for v in variables})


def scale(df: DataFrame, variables: Sequence[str], factor: float) -> DataFrame:
    """R-08: multiply."""
    return df.withColumns({v: F.col(v) * factor for v in variables})


def timeseries(df: DataFrame, variable: str, at_lat: float, at_lon: float, start: str | None = None, end: str | None = None,
               time: str = "time", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-09: the nearest cell's values over a period, missing ones dropped."""
    d = nearest_cell(df, at_lat, at_lon, variable, lat=lat, lon=lon)
    if start:
        d = time_select(d, "from", start, time=time)
    if end:
        d = time_select(d, "to", end, time=time)
    return d.filter(F.col(variable).isNotNull()).select(time, lon, lat, variable)


def dimension_summary(df: DataFrame, dims: Sequence[str], variables: Mapping[str, Sequence[str]]) -> DataFrame:
    """R-10: per variable the number of dimensions and the size of each."""
    sizes = df.agg(*[F.count_distinct(d).alias(d) for d in dims])
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(len(ds)).alias("n_dims"),
                              F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("size")) for d in ds]).alias("dims"))
                     for v, ds in variables.items()])
    return sizes.select(F.inline(rows))


def coordinate_values(df: DataFrame, dim: str) -> DataFrame:
    """R-10: position and value of each coordinate."""
    num = F.unix_micros(F.col(dim)) if dict(df.dtypes)[dim].startswith("timestamp") else F.col(dim)
    return value_index(df.select(dim).distinct().withColumn("_num", num), [], "_num", [dim], "position").select("position", F.col(dim).alias("value"))


def bracketing_cells(df: DataFrame, west: float, east: float, south: float, north: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """R-27: the grid lines just outside a box."""
    la, lo = F.col(lat), F.col(lon)
    return df.agg(F.max(F.when(lo < west, lo)).alias("west"), F.min(F.when(lo > east, lo)).alias("east"),
                  F.max(F.when(la < south, la)).alias("south"), F.min(F.when(la > north, la)).alias("north"))


def shift_longitude(df: DataFrame, lon: str = "lon") -> DataFrame:
    """R-28: longitude to -180 .. 180."""
    return df.withColumn(lon, F.pmod(F.col(lon) + 180, F.lit(360.0)) - 180)
