"""Abundance, diversity, dissimilarity and summary statistics (O-01 .. O-35)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import hill_number, ln_choose_ratio, safe_div
from ..functions.scale import cut_lineage, dense_index, describe_exact, exact_quantiles, join_keys, join_small, middle_values
from .joins import pairs_within


# ---------------------------------------------------------------- shape and zeros

def to_community_matrix(df: DataFrame, species_list: Sequence[str] | None = None,
                        rows: Sequence[str] = ("site", "year"), species: str = "species",
                        abundance: str = "abundance") -> DataFrame:
    """O-01: the long form (rows, species, abundance summed); with a species list one column for each, missing is 0."""
    if species_list is None:
        return df.groupBy(*rows, species).agg(F.sum(abundance).alias(abundance))
    return df.groupBy(*rows).pivot(species, list(species_list)).agg(F.sum(abundance)).fillna(0)


def to_long(wide: DataFrame, rows: Sequence[str] = ("site", "year"), species: str = "species",
            abundance: str = "abundance") -> DataFrame:
    """O-01 reversed."""
    return wide.unpivot(list(rows), [c for c in wide.columns if c not in rows], species, abundance)


def complete_absences(df: DataFrame, unit: str = "unit", species: str = "species",
                      abundance: str = "abundance", chunk: int = 256) -> DataFrame:
    """O-02: zeros for units in which a species was never seen.

    The answer has units x species rows by definition. Species are numbered and packed into
    chunks; every unit meets every chunk through an equi-join on the chunk number, so both sides
    are spread by key and no side is collected. Operators that only need the effect of zeros
    (trends, LCBD) use closed forms instead of this table.
    """
    tot = df.groupBy(unit, species).agg(F.sum(abundance).alias(abundance))
    levels = dense_index(df, species, "_i")
    chunks = levels.groupBy((F.floor(F.col("_i") / chunk)).alias("_c")).agg(F.collect_list(species).alias("_s"))
    n_chunks = levels.agg(F.ceil((F.max("_i") + 1) / chunk)).scalar()
    full = (df.select(unit).distinct()
              .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)))
              .join(chunks, "_c").select(unit, F.explode("_s").alias(species)))
    return (full.join(tot, [unit, species], "left")
                .withColumn(abundance, F.coalesce(F.col(abundance), F.lit(0))))


# ---------------------------------------------------------------- abundance metrics

def abundance(df: DataFrame, factors: Sequence[str], number: str = "number") -> DataFrame:
    """O-03: sums with missing ignored; a group of only missing values gives 0."""
    return df.groupBy(*factors).agg(F.coalesce(F.sum(number), F.lit(0)).alias(number))


def rotation_abundance(df: DataFrame, factors: Sequence[str], unit: str = "observation_unit",
                       rotation: str = "rotation", number: str = "number") -> DataFrame:
    """O-04: mean, max and sd over the valid rotations of the unit, and their number.

    A rotation without the species counts 0 if the unit has it. Those zeros enter through the
    number of valid rotations, so they are never written out.
    """
    factors = list(factors)
    valid = (df.groupBy(unit, rotation).agg(F.lit(1).alias("_1"))
               .groupBy(unit).agg(F.count(F.lit(1)).alias("rotations")))
    per = df.groupBy(*factors, rotation).agg(F.coalesce(F.sum(number), F.lit(0)).cast("double").alias("_n"))
    g = per.groupBy(*factors).agg(F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_s"),
                                  F.sum(F.col("_n") * F.col("_n")).alias("_q"), F.max("_n").alias("_m"),
                                  F.avg("_n").alias("_a"), F.coalesce(F.var_pop("_n"), F.lit(0.0)).alias("_v"))
    d = g.join(valid, unit)
    n, k = F.col("rotations").cast("double"), F.col("_k").cast("double")
    mean = F.col("_s") / n
    # squares around the mean = those inside the seen rotations + shift of their mean + the zeros
    ss = k * F.col("_v") + k * F.pow(F.col("_a") - mean, 2) + (n - k) * mean * mean
    return d.select(*factors, mean.alias(number),
                    F.when(k < n, F.greatest(F.col("_m"), F.lit(0.0))).otherwise(F.col("_m")).alias(f"{number}_max"),
                    F.sqrt(F.try_divide(ss, n - 1)).alias(f"{number}_sd"), "rotations")


# How each metric is combined.
METRIC_RULES = {
    "number": "sum", "mean.length": "w.mean", "taille_moy": "w.mean", "biomass": "sum",
    "Biomass": "sum", "weight": "sum", "mean.weight": "w.mean", "density": "sum",
    "Density": "sum", "CPUE": "sum", "CPUE.biomass": "sum", "presence_absence": "pres",
    "abundance.prop.SC": "w.mean.prop", "biomass.prop.SC": "w.mean.prop.bio",
    "colonies": "sum", "coverage": "sum", "mean.size.colonies": "w.mean.colonies",
    "number.max": "nbMax", "number.sd": "nbSD", "density.max": "densMax", "density.sd": "densSD",
    "biomass.max": "sum", "spawning.success": "%.nesting", "spawnings": "sum",
    "readable.tracks": "sum", "tracks.number": "sum",
}


def _weighted(m: str, w: str) -> Column:
    ok = F.col(m).isNotNull()
    return F.try_divide(F.sum(F.when(ok, F.col(m) * F.col(w)).cast("double")),
                        F.sum(F.when(ok, F.col(w)).cast("double")))


def aggregate_metric(df: DataFrame, metric: str, factors: Sequence[str], rule: str | None = None,
                     number: str = "number", colonies: str = "colonies", tracks: str = "readable_tracks",
                     total: str = "number_total", biomass: str = "biomass", biomass_total: str = "biomass_total",
                     size_class: str = "size_class", rotation: str = "rotation",
                     base: str | None = None) -> DataFrame:
    """O-05: combine a metric by its own rule; a group of only missing values gives NULL."""
    rule = rule or METRIC_RULES[metric]
    factors = list(factors)
    g = df.groupBy(*factors)
    m = F.col(metric) if metric in df.columns else None
    if rule == "sum":
        return g.agg(F.sum(m).alias(metric))
    if rule in ("w.mean", "w.mean.colonies", "%.nesting"):
        w = {"w.mean": number, "w.mean.colonies": colonies, "%.nesting": tracks}[rule]
        return g.agg(_weighted(metric, w).alias(metric))
    if rule in ("w.mean.prop", "w.mean.prop.bio"):
        part, tot = (number, total) if rule == "w.mean.prop" else (biomass, biomass_total)
        scale = F.lit(100.0)
        if size_class not in factors:
            scale = scale * df.agg(F.count_distinct(size_class)).scalar()
        share = F.try_divide(F.sum(F.when(m.isNotNull(), F.col(part)).cast("double")),
                             F.sum(F.col(tot)).cast("double"))
        return (g.agg(share.alias("_s"), F.bool_and(F.when(m.isNotNull(), m == 0)).alias("_z"),
                      F.sum(F.col(tot)).alias("_t"))
                 .select(*factors, F.when(F.col("_z") & (F.col("_t") != 0), F.lit(0.0))
                         .when(F.col("_z").isNotNull(), F.col("_s") * scale).alias(metric)))
    if rule == "pres":
        return g.agg(F.max(F.when(m.isNotNull(), (m > 0).cast("int"))).alias(metric))
    if rule in ("nbMax", "densMax", "nbSD", "densSD"):
        src = base or ("number" if rule.startswith("nb") else "density")
        per = df.groupBy(*factors, rotation).agg(F.sum(src).alias("_n"))
        f = F.max if rule.endswith("Max") else F.stddev_samp
        return per.groupBy(*factors).agg(f("_n").alias(metric))
    raise ValueError(f"no rule for metric {metric!r}")


def presence_absence(df: DataFrame, number: str = "number", out: str = "presence_absence") -> DataFrame:
    """O-06: 1 if positive, 0 if zero; negative counts are an error."""
    n = F.col(number)
    return df.withColumn(out, F.when(n > 0, 1).when(n == 0, 0).when(
        n < 0, F.raise_error(F.lit("negative abundance")).cast("int")))


# ---------------------------------------------------------------- diversity

def species_totals(df: DataFrame, unit: Sequence[str], species: str, n: str) -> DataFrame:
    return df.groupBy(*unit, species).agg(F.sum(n).cast("double").alias("_n")).filter("_n > 0")


def shannon_of(n: str = "_n") -> Column:
    """Shannon index from the counts of one group: ln N - sum(n ln n) / N."""
    return F.ln(F.sum(n)) - F.sum(F.col(n) * F.ln(n)) / F.sum(n)


def simpson_of(n: str = "_n") -> Column:
    return F.sum(F.col(n) * F.col(n)) / (F.sum(n) * F.sum(n))


def community_metrics(df: DataFrame, unit: Sequence[str], species: str = "species",
                      number: str = "number") -> DataFrame:
    """O-07: total, richness, Simpson and its complement, Shannon, Pielou and Hill per unit.

    Both steps are algebraic sums: species totals, then one pass over them. Units without any
    individual keep a row with total 0, richness 0 and Simpson 0.
    """
    unit = list(unit)
    per = df.groupBy(*unit, species).agg(F.sum(number).cast("double").alias("_n"))
    pos = F.when(F.col("_n") > 0, F.col("_n"))
    tot = F.coalesce(F.sum(pos), F.lit(0.0))
    g = per.groupBy(*unit).agg(
        F.coalesce(F.sum("_n"), F.lit(0.0)).alias("number"), F.count(pos).alias("species_richness"),
        F.coalesce(F.try_divide(F.sum(pos * pos), F.sum(pos) * F.sum(pos)), F.lit(0.0)).alias("simpson"),
        F.when(tot > 0, F.ln(F.sum(pos)) - F.sum(pos * F.ln(pos)) / F.sum(pos)).otherwise(0.0).alias("shannon"))
    h = F.col("shannon")
    return g.select(*unit, "number", "species_richness", "simpson", (1 - F.col("simpson")).alias("simpson_l"),
                    "shannon", F.when(F.col("species_richness") > 1, h / F.ln("species_richness")).alias("pielou"),
                    ((1 - F.col("simpson")) / F.exp(h)).alias("hill"))


def rarefied_richness(totals: DataFrame, unit: Sequence[str], size, out: str) -> DataFrame:
    """Expected species in `size` draws from totals (unit.., _n); NULL when the unit is smaller."""
    unit = list(unit)
    cells = totals.groupBy(*unit).agg(F.sum("_n").alias("_tot"))
    e = 1 - F.coalesce(F.exp(ln_choose_ratio("_tot", "_n", F.lit(size))), F.lit(0.0))
    return (totals.groupBy(*unit, "_n").agg(F.count(F.lit(1)).alias("_times"))
                  .join(cells, unit).filter(F.col("_tot") >= size)
                  .groupBy(*unit).agg(F.sum(e * F.col("_times")).alias(out)))


def grid_indicators(df: DataFrame, cell: str = "cell", species: str = "species", records: str = "records",
                    esn: int = 50) -> DataFrame:
    """O-08: n, species, Shannon, Simpson, largest share, ES(n), Hill 1, 2 and infinity per cell."""
    t = species_totals(df, [cell], species, records)
    g = t.groupBy(cell).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("sp"),
                            shannon_of().alias("shannon"), simpson_of().alias("simpson"),
                            (F.max("_n") / F.sum("_n")).alias("maxp"))
    g = g.join(rarefied_richness(t, [cell], esn, "es"), cell, "left")
    return g.select(cell, "n", "sp", "shannon", "simpson", "maxp", "es", F.exp("shannon").alias("hill_1"),
                    (1 / F.col("simpson")).alias("hill_2"), (1 / F.col("maxp")).alias("hill_inf"))


def assign_cell(df: DataFrame, resolution: float, lat: str = "lat", lon: str = "lon",
                out: str = "cell") -> DataFrame:
    """O-09: equal-area cell: columns of longitude, rows of equal sine of latitude.

    `resolution` is the width in degrees at the equator. The ids differ from hexagon libraries.
    """
    rows = 360.0 / resolution / 3.141592653589793
    i = F.floor((F.sin(F.radians(lat)) + 1) / 2 * F.lit(rows)).cast("long")
    j = F.floor((F.pmod(F.col(lon) + 180, F.lit(360.0))) / F.lit(resolution)).cast("long")
    return df.withColumn(out, F.concat_ws(":", i.cast("string"), j.cast("string")))


def species_diversity(df: DataFrame, unit: Sequence[str], species: str = "species",
                      number: str = "number") -> DataFrame:
    """O-10: richness, Gini-Simpson, Simpson, Shannon, Margalef, Menhinick and McIntosh."""
    t = species_totals(df, unit, species, number)
    g = t.groupBy(*unit).agg(F.count(F.lit(1)).alias("richness"), F.sum("_n").alias("total"),
                             simpson_of().alias("simpson"), shannon_of().alias("shannon"),
                             F.sqrt(F.sum(F.col("_n") * F.col("_n"))).alias("_u"))
    n, s = F.col("total"), F.col("richness")
    return g.select(*unit, "richness", (1 - F.col("simpson")).alias("gini_simpson"), "simpson", "shannon",
                    F.try_divide(s - 1, F.ln(n)).alias("margalef"), (s / F.sqrt(n)).alias("menhinick"),
                    F.try_divide(n - F.col("_u"), n - F.sqrt(n)).alias("mcintosh"))


def parametric_diversity(df: DataFrame, unit: Sequence[str], orders: Sequence[float] = (0, .25, .5, 1, 2, 4, 8),
                         species: str = "species", number: str = "number") -> DataFrame:
    """O-11: Hill numbers of several orders, in long form; one sum per order in a single pass."""
    t = species_totals(df, unit, species, number)
    sums = [F.sum(F.pow("_n", F.lit(float(q)))).alias(f"_q{i}") for i, q in enumerate(orders)]
    g = t.groupBy(*unit).agg(F.sum("_n").alias("_tot"), shannon_of().alias("_h"), *sums)
    rows = F.array(*[F.struct(F.lit(float(q)).alias("q"), hill_number(
        q, F.col(f"_q{i}") / F.pow("_tot", F.lit(float(q))), F.col("_h")).alias("diversity"))
        for i, q in enumerate(orders)])
    return g.select(*unit, F.inline(rows))


def turned_block_score(df: DataFrame, group: Sequence[str], turned: str = "turned",
                       unturned: str = "unturned") -> DataFrame:
    """O-12: share of turned blocks per quadrat in classes 0..5, and statistics per site and date.

    Score and rest follow from the share and keep or turn its order, so the two middle shares give all three medians.
    """
    share = F.col(turned) / (F.col(turned) + F.col(unturned)) * 100
    cls = lambda c: (F.when(F.col(c) < 5, 0).when(F.col(c) < 25, 1).when(F.col(c) < 45, 2)
                     .when(F.col(c) < 65, 3).when(F.col(c) < 85, 4).otherwise(5)).cast("double")
    q = (df.filter(F.col(turned).isNotNull() & F.col(unturned).isNotNull()
                   & ~((F.col(turned) == 0) & (F.col(unturned) == 0)))
           .withColumn("share", share.cast("double")).withColumn("score", cls("share"))
           .withColumn("rest", 100 - F.col("share")))
    stats = [f(c).alias(f"{c}_{n}") for c in ("score", "share", "rest") for n, f in
             (("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("max", F.max))]
    out = q.groupBy(*group).agg(*stats, F.count(F.lit(1)).alias("n"))
    mid = middle_values(q, group, "share", "_low", "_high")
    half = lambda x, y: x + (y - x) / 2
    mid = mid.select(*group, half(cls("_low"), cls("_high")).alias("score_median"), half(F.col("_low"), F.col("_high")).alias("share_median"),
                     half(100 - F.col("_high"), 100 - F.col("_low")).alias("rest_median"))
    return join_keys(out, mid, list(group))


def rarefy(df: DataFrame, sizes: Sequence[int] | None = None, unit: Sequence[str] = ("site",),
           species: str = "species", number: str = "number", step: int = 10) -> DataFrame:
    """O-13: rarefaction curve: expected species in m draws for every m up to the unit's total.

    Species of equal count are one row, so the work per unit grows with distinct counts. The sizes
    are the given list or 1, 1 + step, ...
    """
    unit = list(unit)
    t = species_totals(df, unit, species, number)
    cells = t.groupBy(*unit).agg(F.sum("_n").alias("_tot"))
    same = t.groupBy(*unit, "_n").agg(F.count(F.lit(1)).alias("_times")).join(cells, unit)
    if sizes is None:
        sizes_col = F.sequence(F.lit(1).cast("long"), F.col("_tot").cast("long"), F.lit(step).cast("long"))
    else:
        sizes_col = F.array(*[F.lit(int(m)).cast("long") for m in sizes])
    e = 1 - F.coalesce(F.exp(ln_choose_ratio("_tot", "_n", "sample_size")), F.lit(0.0))
    return (same.withColumn("sample_size", F.explode(sizes_col)).filter(F.col("sample_size") <= F.col("_tot"))
                .groupBy(*unit, "sample_size").agg(F.sum(e * F.col("_times")).alias("expected_species")))


def location_summary(df: DataFrame, by: Sequence[str], lat: str = "lat", lon: str = "lon",
                     location: str = "location", species: str = "species") -> DataFrame:
    """O-14: coordinate range, number of locations and of species."""
    return df.groupBy(*by).agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"),
                               F.max(lon).alias("lon_max"), F.count_distinct(location).alias("locations"),
                               F.count_distinct(species).alias("species"))


def hellinger(df: DataFrame, site: str, species: str, number: str) -> DataFrame:
    """Square root of the share of a species at its site; zeros stay implicit."""
    t = species_totals(df, [site], species, number)
    tot = t.groupBy(site).agg(F.sum("_n").alias("_t"))
    return t.join(tot, site).select(site, species, F.sqrt(F.col("_n") / F.col("_t")).alias("_y"))


def site_contributions(y: DataFrame, by: Sequence[str], site: str, species: str, n_sites) -> DataFrame:
    """LCBD from sparse transformed values: no zero is written out.

    sum over species of (y - mean)^2 = sum y^2 - 2 sum y mean + sum of all mean^2.
    """
    by = list(by)
    sp = y.groupBy(*by, species).agg((F.sum("_y") / n_sites).alias("_m"), F.sum(F.col("_y") * F.col("_y")).alias("_q"))
    tot = sp.groupBy(*(by or [F.lit(1).alias("_one")])).agg(
        F.sum(F.col("_m") * F.col("_m")).alias("_m2"),
        F.sum(F.col("_q") - n_sites * F.col("_m") * F.col("_m")).alias("_ss"))
    s = (y.join(sp.select(*by, species, "_m"), [*by, species])
          .groupBy(*by, site).agg(F.sum(F.col("_y") * F.col("_y") - 2 * F.col("_y") * F.col("_m")).alias("_d")))
    if by:
        s = join_small(s, tot, by)
        return s.select(*by, site, ((F.col("_d") + F.col("_m2")) / F.col("_ss")).alias("lcbd"))
    m2, ss = tot.agg(F.first("_m2")).scalar(), tot.agg(F.first("_ss")).scalar()
    return s.select(site, ((F.col("_d") + m2) / ss).alias("lcbd"))


def beta_diversity(df: DataFrame, site: str = "site", species: str = "species",
                   number: str = "number") -> tuple[DataFrame, DataFrame, DataFrame]:
    """O-15: (total: ss_total, bd_total), (site: lcbd), (species: scbd, above_mean).

    Means run over all sites with at least one individual, zeros included by closed form.
    """
    y = cut_lineage(hellinger(df, site, species, number))  # one row per site and species
    n = y.agg(F.count_distinct(site).cast("double")).scalar()
    sp = (y.groupBy(species).agg(F.sum("_y").alias("_s"), F.sum(F.col("_y") * F.col("_y")).alias("_q"))
           .withColumn("ss", F.col("_q") - F.col("_s") * F.col("_s") / n))
    total = sp.agg(F.sum("ss").alias("ss_total")).withColumn("bd_total", F.col("ss_total") / (n - 1))
    sst = sp.agg(F.sum("ss")).scalar()
    mean = sp.agg(F.lit(1.0) / F.count(F.lit(1))).scalar()
    scbd = (sp.select(species, (F.col("ss") / sst).alias("scbd"))
              .withColumn("above_mean", F.col("scbd") >= mean))
    return total, site_contributions(y, [], site, species, n), scbd


def lcbd_over(df: DataFrame, by: Sequence[str], lcbd: str = "lcbd") -> DataFrame:
    """O-17: mean and sd of LCBD by date or by site."""
    return df.groupBy(*by).agg(F.avg(lcbd).alias("lcbd_mean"), F.stddev_samp(lcbd).alias("lcbd_sd"))


# ---------------------------------------------------------------- dissimilarity

def bray_curtis(df: DataFrame, group: Sequence[str], sample: str, species: str = "species",
                number: str = "number", differ: str | None = None, transform: str = "sqrt",
                species_per_sample: str = "few") -> DataFrame:
    """O-18: Bray-Curtis of the samples of a group, on square roots by default.

    1 - 2 * sum(min) / sum(a + b). With few species per sample (dozens) a sample travels as one row
    with its species map and a pair is settled where it meets; with `many` the shared species come
    from an equi-join on (group, species), cut into blocks like the pairs. `differ` keeps pairs with
    different values of that column.
    """
    group = list(group)
    f = {"sqrt": F.sqrt, "none": lambda c: F.col(c), "log": F.log1p}[transform]
    extra = [differ] if differ else []
    t = (df.groupBy(*group, sample, *extra, species).agg(F.sum(number).cast("double").alias("_n"))
           .withColumn("_v", f("_n")))
    keep = [*group, f"{sample}_a", f"{sample}_b", *[f"{c}_{s}" for c in extra for s in "ab"]]
    out = lambda shared: (1 - F.try_divide(2 * shared, F.col("_t_a") + F.col("_t_b"))).alias("dissimilarity")
    if species_per_sample == "few":
        samples = t.groupBy(*group, sample, *extra).agg(
            F.sum("_v").alias("_t"), F.map_from_entries(F.collect_list(F.struct(species, "_v"))).alias("_m"))
    else:
        samples = t.groupBy(*group, sample, *extra).agg(F.sum("_v").alias("_t"))
    pairs = pairs_within(samples, group, sample)
    if differ:
        pairs = pairs.filter(F.col(f"{differ}_a") != F.col(f"{differ}_b"))
    if species_per_sample == "few":
        low = F.transform(F.map_entries("_m_a"), lambda e: F.least(e["value"], F.coalesce(F.try_element_at("_m_b", e["key"]), F.lit(0.0))))
        return pairs.select(*keep, out(F.aggregate(low, F.lit(0.0), lambda s, x: s + x)))
    both = pairs_within(t.filter("_v > 0").select(*group, species, sample, "_v"), [*group, species], sample)
    shared = both.groupBy(*group, f"{sample}_a", f"{sample}_b").agg(F.sum(F.least("_v_a", "_v_b")).alias("_min"))
    d = pairs.join(shared, [*group, f"{sample}_a", f"{sample}_b"], "left")
    return d.select(*keep, out(F.coalesce(F.col("_min"), F.lit(0.0))))


def dissimilarity_summary(df: DataFrame, by: Sequence[str], value: str = "dissimilarity") -> DataFrame:
    """O-19: mean, sd, median, min, max and number per site and date."""
    return describe_exact(df, by, value, {"median": .5}).select(*by, "mean", "sd", "min", "max", "n", "n_value", "median")


def quartile_class_means(df: DataFrame, value: str = "dissimilarity") -> DataFrame:
    """O-19: mean of each quartile class over all pairs; the thresholds of the quality scale."""
    q = exact_quantiles(df, [], value, {"q1": .25, "q2": .5, "q3": .75})
    v = F.col(value)
    a, b, c = (q.select(k).scalar() for k in ("q1", "q2", "q3"))
    cls = F.when(v <= a, 1).when(v <= b, 2).when(v <= c, 3).when(v.isNotNull(), 4)
    return (df.withColumn("quartile", cls).filter("quartile IS NOT NULL")
              .groupBy("quartile").agg(F.avg(value).alias("threshold")))


# ---------------------------------------------------------------- weighted means and rates

def evolution_rate(df: DataFrame, keys: Sequence[str], period: str, value: str, first, second,
                   digits: int = 0) -> DataFrame:
    """O-22: difference between two periods of rounded percentages."""
    r = lambda p: F.bround(F.avg(F.when(F.col(period) == p, F.col(value))), digits)
    return (df.filter(F.col(period).isin([first, second])).groupBy(*keys)
              .agg(r(first).alias("before"), r(second).alias("after"))
              .withColumn("evolution", F.col("after") - F.col("before")))


def weighted_geometric_mean(x: str, w: str, zero: float = 1e-6) -> Column:
    """O-23: exp(sum(w ln x) / sum w), zeros replaced; an aggregate expression."""
    v = F.when(F.col(x) == 0, F.lit(zero)).otherwise(F.col(x))
    ok = v.isNotNull() & F.col(w).isNotNull()
    return F.exp(F.try_divide(F.sum(F.when(ok, F.col(w) * F.ln(v))), F.sum(F.when(ok, F.col(w)).cast("double"))))


def community_trait_mean(df: DataFrame, traits: DataFrame, columns: Sequence[str], by: Sequence[str] = ("site", "year"),
                         species: str = "species", number: str = "abundance") -> DataFrame:
    """O-24: abundance-weighted mean of each trait; species without the trait do not count."""
    n = F.col(number).cast("double")
    tot = df.groupBy(*by, species).agg(F.sum(n).alias("_n"))
    d = tot.join(traits.select(species, *columns), species)
    return d.groupBy(*by).agg(*[F.try_divide(F.sum(F.col(c) * F.col("_n")),
                                             F.sum(F.when(F.col(c).isNotNull(), F.col("_n")))).alias(c) for c in columns])


# ---------------------------------------------------------------- image detections

def detection_top(df: DataFrame, scores: str = "scores", detector: str = "detector_score",
                  kind: str = "kind", bypass: Sequence[str] = ("person", "vehicle"), blank: str = "blank") -> DataFrame:
    """O-25: best class and score per detection; person and vehicle skip the classifier."""
    joint = F.transform_values(scores, lambda k, v: v * F.col(detector))
    vals = F.map_values(joint)
    best = F.array_max(vals)
    pos = F.array_position(vals, best)
    name = F.try_element_at(F.map_keys(joint), pos.cast("int"))
    direct = F.col(kind).isin(list(bypass))
    return (df.withColumn("species", F.when(direct, F.col(kind))
                          .when(F.coalesce(best, F.lit(0.0)) == 0, F.lit(blank)).otherwise(name))
              .withColumn("score", F.when(direct, F.col(detector)).otherwise(F.coalesce(best, F.lit(0.0)))))


def detection_recap(df: DataFrame, file: str = "file", species: str = "species", frame: str = "frame",
                    score: str = "score") -> DataFrame:
    """O-26: per file and species the sorted frames, count and confidence mean, min and max."""
    return df.groupBy(file, species).agg(
        F.array_sort(F.collect_list(frame)).alias("frames"), F.count(F.lit(1)).alias("count"),
        F.round(F.avg(score), 4).alias("conf_mean"), F.round(F.min(score), 4).alias("conf_min"),
        F.round(F.max(score), 4).alias("conf_max"))


# ---------------------------------------------------------------- descriptive statistics

def describe_by(df: DataFrame, metric: str, factors: Sequence[str] = ()) -> DataFrame:
    """O-34: min, quartiles, mean, max, sd and n; overall when no factor is given."""
    factors = list(factors)
    g = (df.groupBy(*factors) if factors else df.groupBy()).agg(
        F.min(metric).alias("min"), F.avg(metric).alias("mean"), F.max(metric).alias("max"),
        F.stddev_samp(metric).alias("sd"), F.count(metric).alias("n"))
    q = exact_quantiles(df, factors, metric, {"q1": .25, "median": .5, "q3": .75})
    if factors:
        return join_keys(g, q, factors, "left")
    return g.withColumns({k: q.select(k).scalar() for k in ("q1", "median", "q3")})


def collinearity_by_species(df: DataFrame, cols: Sequence[str], species: str = "species",
                            min_rows: int = 3) -> DataFrame:
    """O-35: pairwise correlations per species; smaller species are listed with NULL."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    g = df.groupBy(species).agg(F.count(F.lit(1)).alias("n"),
                                *[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                              F.when(F.col("n") >= min_rows, F.col(f"_r{i}")).alias("r"))
                     for i, (a, b) in enumerate(pairs)])
    return g.select(species, "n", F.inline(rows))
