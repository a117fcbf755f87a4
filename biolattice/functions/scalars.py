"""Column expressions shared by several operators."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EARTH_RADIUS_M = 6371010.0


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def great_circle_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres (haversine)."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp, dl = p2 - p1, F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.when(h.isNotNull(), F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def unit_vector(lat, lon) -> list[Column]:
    """x, y, z on the unit sphere; straight-line order equals great-circle order."""
    la, lo = F.radians(as_col(lat)), F.radians(as_col(lon))
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def ln_choose_ratio(total, ni, n) -> Column:
    """ln( C(total - ni, n) / C(total, n) ); NULL when the upper term is zero.

    Four log-gammas by Stirling's series, arranged so that their large parts cancel by algebra and not by
    subtraction: the time does not depend on the counts, nor does the precision.
    """
    total, ni, n = (as_col(x).cast("double") for x in (total, ni, n))
    top = total + 1
    a, b, d = top - ni, top - ni - n, top - n
    lead = (a - 0.5) * F.log1p(-ni / top) - (b - 0.5) * F.log1p(-(ni + n) / top) + (d - 0.5) * F.log1p(-n / top)
    value = lead + stirling_rest(a) - stirling_rest(b) - stirling_rest(top) + stirling_rest(d)
    return F.when(n == 0, F.lit(0.0)).when(total - ni >= n, value)


def ln_gamma(z: Column) -> Column:
    """ln gamma(z) for z > 0."""
    return (z - 0.5) * F.ln(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + stirling_rest(z)


def stirling_rest(z: Column, least: int = 12) -> Column:
    """ln gamma(z) less ((z - 1/2) ln z - z + ln(2 pi)/2), for z > 0; below `least` by steps of one."""
    series = lambda x: 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    up = series(z + least)
    for k in range(least):
        up = up + (z + (k + 0.5)) * F.log1p(1 / (z + k)) - 1
    return F.when(z >= least, series(z)).otherwise(up)


def hill_number(q: float, sum_p_q, shannon) -> Column:
    if q == 1:
        return F.exp(as_col(shannon))
    return F.pow(as_col(sum_p_q), F.lit(1.0 / (1.0 - q)))


def week_of_year(d) -> Column:
    """Monday-based week number; days before the first Monday are week 0."""
    return F.floor((F.dayofyear(as_col(d)) + 6 - F.weekday(as_col(d))) / 7).cast("int")


def night_of(ts) -> Column:
    """Date of the evening a recording belongs to: before noon counts for the day before."""
    ts = as_col(ts)
    return F.when(F.hour(ts) < 12, F.date_sub(F.to_date(ts), 1)).otherwise(F.to_date(ts))


def area_between(x0, y0, x1, y1) -> Column:
    return (as_col(y0) + as_col(y1)) / 2 * (as_col(x1) - as_col(x0))
