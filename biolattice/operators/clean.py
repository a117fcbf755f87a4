"""Cleaning, validation and projection of survey tables (C-01 .. C-26)."""
from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import night_of, safe_div
from ..functions.scale import first_per_key

# Substrate and placeholder codes that do not name a species.
NON_SPECIES = [
    "Absencemacrofaune", "NoID", "Acrobranc", "Acrodigit", "Acroencr", "Acrosubm", "Acrotabu",
    "Adredure", "Adremoll", "Algaturf", "Balimona", "Corablan", "CoradurV", "Coraenal",
    "Coramor1", "Coramor2", "Coramou", " Dallcora", "Debrcora", "Debris", "Hare", "HexaChar",
    "MuraCong", "Nacrbran", "Nacrcham", "Nacrencr", "Nacrfoli", "Nacrmass", "Nacrsubm",
    "Recrcora", "Roche", "Sable", "Vase",
]

# Accepted names of ocean variables, and of their units.
OCEAN_SYNONYMS = {
    "lon": ["longitude", "LONGITUDE", "LON", "lon"],
    "lat": ["latitude", "LATITUDE", "LAT", "lat"],
    "time": ["date", "time", "TIME", "JULD"],
    "time_qc": ["date_qc", "time_qc", "TIME_QC", "JULD_QC"],
    "depth": ["DEPTH", "depth"],
    "cycle_number": ["CYCLE_NUMBER"],
    "ref_time": ["REFERENCE_DATE_TIME"],
    "pos_qc": ["POSITION_QC"],
    "temperature": ["TEMP", "TEMPERATURE", "t_an"],
    "salinity": ["PSAL", "PRACTICAL_SALINITY", "s_an"],
    "oxygen": ["DOXY", "o_an"],
    "oxygenSat": ["O_an"],
    "pressure": ["PRES"],
    "chlorophylle": ["CHLA"],
    "nitrate": ["NO3", "NITRATE", "n_an"],
    "bbp700": ["BBP700"],
    "C1PHASE_DOXY": ["C1PHASE_DOXY"],
    "C2PHASE_DOXY": ["C2PHASE_DOXY"],
    "TEMP_DOXY": ["TEMP_DOXY"],
}
OCEAN_COORDINATES = ["lon", "lat", "time", "time_qc", "depth", "cycle_number", "ref_time", "pos_qc"]
OCEAN_UNITS = {
    "degree_east": ["degree_east"],
    "degree_north": ["degree_north"],
    "degree_celsius": ["degree_celsius", "degree_Celsius"],
    "psu": ["psu", "practical_salinity_unit", "PSU"],
    "micromol/l": ["micromole.l-1", "micromole_per_liter", "μmol.l-1", "μmol/l", "μmol/L", "μmol.L-1"],
    "mg/m3": ["mg/m3"],
    "micromole/kg": ["micromole/kg"],
    "m-1": ["m-1"],
    "decibar": ["decibar", "dbar"],
}
# Substrate colours that count as bright.
BRIGHT_COLOURS = ["Blanche", "Verte", "Blanche-Verte", "Colorée"]


def tidy_detections(df: DataFrame, source_name: str, file: str = "file", taxon: str = "taxon",
                    probability: str = "probability", position: str = "position") -> DataFrame:
    """C-01: add the participation id, drop repeats of (file, taxon) except `empty`.

    Repeats meet in a partial aggregate, so a file with very many repeats stays cheap; `empty`
    rows never shuffle at all.
    """
    p = F.trim(F.col(probability).cast("string"))
    d = (df.withColumn("participation", F.lit(source_name[max(0, len(source_name) - 41):
                                                         max(0, len(source_name) - 17)]))
           .withColumn(probability, F.when(p.isNull() | (p == ""), F.lit(0.0))
                       .otherwise(p.try_cast("double"))))
    blank = F.col(taxon) == "empty"
    kept = first_per_key(d.filter(~F.coalesce(blank, F.lit(False))), [file, taxon], [position])
    return kept.unionByName(d.filter(blank))


def resolve_identification(df: DataFrame, observer: str = "observer_taxon",
                           observer_conf: str = "observer_conf", validator: str = "validator_taxon",
                           validator_conf: str = "validator_conf") -> DataFrame:
    """C-02: the validator's word over the observer's, for the taxon and for the confidence."""
    pick = lambda v, o: (F.when(F.coalesce(F.col(v), F.lit("")) != "", F.col(v))
                         .otherwise(F.coalesce(F.col(o), F.lit(""))))
    return (df.withColumn("id_valid", pick(validator, observer))
              .withColumn("conf_valid", pick(validator_conf, observer_conf)))


class BadFileNames(ValueError):
    """Recording names that fit no survey protocol."""


def recording_time(df: DataFrame, file: str = "file", check: bool = True) -> DataFrame:
    """C-03: session and time_num from recording names.

    Second letter `i`: transect, session = number in the fourth dash field, time_num =
    session * 800 + seconds + ms / 1000. Second letter `a`: stationary, UTC time two hours before
    the name's clock, session = date of the evening.
    """
    f = F.col(file)
    kind = F.substring(f, 2, 1)
    bits = F.split(F.element_at(F.split(f, "-"), -1), "_")
    sec, ms = F.try_element_at(bits, F.lit(-2)), F.try_element_at(bits, F.lit(-1))
    walk = F.regexp_extract(F.try_element_at(F.split(f, "-"), F.lit(4)), r"^.{4}(\d+)", 1).try_cast("long")
    stamp = F.concat(F.substring(f, -19, 15), F.lit("."), F.substring(f, -3, 3))
    ts = F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss.SSS")) - F.expr("INTERVAL 7200 SECONDS")
    if check:
        got = df.agg(F.bool_or(~F.coalesce(kind.isin("i", "a"), F.lit(False))).alias("bad"),
                     F.bool_or(kind == "i").alias("walks"),
                     F.bool_or((kind == "i") & (sec != "00000")).alias("moving")).first()
        if got.bad:
            raise BadFileNames("the second letter of a recording name must be i or a")
        if got.walks and not got.moving:
            raise BadFileNames("all transect recordings are at second 00000; named twice?")
    return (df.withColumn("rec_time", F.when(kind == "a", ts))
              .withColumn("session", F.when(kind == "i", walk.cast("string"))
                          .otherwise(F.date_format(night_of(F.col("rec_time")), "dd/MM/yyyy")))
              .withColumn("time_num", F.when(kind == "i", walk * 800 + sec.try_cast("double")
                                             + ms.try_cast("double") / 1000)
                          .otherwise(F.unix_millis("rec_time") / 1000.0)))


def dedupe_by_priority(df: DataFrame, keys: Sequence[str], best: Sequence[Column | str]) -> DataFrame:
    """C-04: keep the row with the largest `best` per key (confidence, then probability)."""
    return first_per_key(df, list(keys), list(best), last=True)


def observation_unit(df: DataFrame, year: str = "year", location: str = "location",
                     unit: str = "observation_unit") -> DataFrame:
    """C-05: unit = year_location, left alone when it exists."""
    if unit in df.columns:
        return df
    return df.withColumn(unit, F.concat_ws("_", F.col(year), F.col(location)))


def split_unit(df: DataFrame, unit: str = "observation_unit") -> DataFrame:
    """C-05 reversed: year and location, if every unit has one of the two known forms."""
    dated, coded = r"[1-2][0|8|9][0-9]{2}_.*", r"[A-Z]{2}[0-9]{2}.*"
    got = df.agg(F.bool_and(F.col(unit).rlike(dated)).alias("d"),
                 F.bool_and(F.col(unit).rlike(coded)).alias("c")).first()
    if got.d:
        part = F.split(unit, "_")
        return df.withColumn("year", part[0]).withColumn("location", part[1])
    if got.c:
        return (df.withColumn("year", F.substring(unit, 3, 2))
                  .withColumn("location", F.concat_ws("_", F.substring(unit, 1, 2),
                                                      F.expr(f"substring(`{unit}`, 5)"))))
    return df


def drop_nonspecies(df: DataFrame, species: str = "species", codes: Sequence[str] = NON_SPECIES) -> DataFrame:
    """C-06: drop codes ending in `sp.` or 1-9, and the substrate codes."""
    c = F.col(species)
    return df.filter(~c.rlike(r"(sp\.|[1-9])$") & ~c.isin(list(codes)))


def filter_absent_species(df: DataFrame, species: str = "species", abundance: str = "abundance") -> DataFrame:
    """C-07: drop species whose total is zero."""
    seen = df.groupBy(species).agg(F.sum(abundance).alias("_t")).filter("_t > 0").select(species)
    return df.join(seen, species, "left_semi")


def rare_species_flags(df: DataFrame, species: str = "species", year: str = "year",
                       abundance: str = "abundance", max_gap: int = 3, min_run: int = 3) -> DataFrame:
    """C-08 decision per species: in the first year, longest absence, longest presence, keep.

    Every year of the table counts, also for species without a row in it. After the
    (species, year) totals the data is a few rows per species.
    """
    years = df.select(year).distinct()
    w_all = W.orderBy(year)  # one row per calendar year
    years = years.withColumn("_r", F.row_number().over(w_all))
    n_years = years.agg(F.max("_r")).scalar()
    tot = (df.groupBy(species, year).agg(F.sum(abundance).alias("_t")))
    on = tot.join(years, year).withColumn("_on", F.col("_t") > 0)
    w = W.partitionBy(species).orderBy("_r")
    hit = (on.filter("_on").withColumn("_prev", F.lag("_r").over(w))
             .withColumn("_run", F.col("_r") - F.row_number().over(w)))
    runs = (hit.groupBy(species, "_run").agg(
                F.count(F.lit(1)).alias("_len"), F.min("_r").alias("_a"), F.max("_r").alias("_z"),
                F.max(F.col("_r") - F.coalesce(F.col("_prev"), F.lit(0)) - 1).alias("_gap"))
            .groupBy(species).agg(F.max("_len").alias("longest_run"), F.min("_a").alias("_first"),
                                  F.max("_z").alias("_last"), F.max("_gap").alias("_gap")))
    out = (df.select(species).distinct().join(runs, species, "left")
           .withColumn("first_year", F.coalesce(F.col("_first") == 1, F.lit(False)))
           .withColumn("longest_run", F.coalesce(F.col("longest_run"), F.lit(0)).cast("long"))
           .withColumn("longest_gap", F.greatest(F.coalesce(F.col("_gap"), F.lit(0)),
                       n_years - F.coalesce(F.col("_last"), F.lit(0))).cast("long")))
    return out.select(species, "first_year", "longest_gap", "longest_run",
                      (F.col("first_year") & (F.col("longest_gap") <= max_gap)
                       & (F.col("longest_run") >= min_run)).alias("keep"))


def filter_rare_species(df: DataFrame, species: str = "species", year: str = "year",
                        abundance: str = "abundance", require_some: bool = True) -> DataFrame:
    """C-08: keep species seen in the first year, never gone long, present long enough once."""
    keep = rare_species_flags(df, species, year, abundance).filter("keep").select(species)
    if require_some and keep.isEmpty():
        raise ValueError("no species is common enough for a trend")
    return df.join(keep, species, "left_semi")


def exclude_species(df: DataFrame, names: Sequence[str] | DataFrame, species: str = "species") -> DataFrame:
    """C-09: drop named species; a table of names becomes an anti join."""
    if isinstance(names, DataFrame):
        return df.join(names.select(F.col(names.columns[0]).alias(species)).distinct(), species, "left_anti")
    return df.filter(~F.col(species).isin(list(names)))


def site_visit_filter(df: DataFrame, min_visit: int, min_occur: int, site: str = "site",
                      year: str = "year", count: str = "count") -> DataFrame:
    """C-10: keep site-years with enough visits and enough visits with a positive count."""
    good = (df.groupBy(site, year)
              .agg(F.count(F.lit(1)).alias("_v"), F.count_if(F.col(count) > 0).alias("_o"))
              .filter((F.col("_v") >= min_visit) & (F.col("_o") >= min_occur)).select(site, year))
    return df.join(good, [site, year], "left_semi")


def clean_taxa(df: DataFrame, taxon: str = "taxon") -> DataFrame:
    """C-11: drop numbered doubles, keep genus and epithet without author, trim."""
    c = F.col(taxon)
    return (df.filter(~c.rlike(r"(sp.1|sp[0-9])$"))
              .withColumn(taxon, F.trim(F.regexp_replace(c, r"^([A-Z][^A-Z(]+)(.*)$", "$1"))))


def model_availability(occurrences: DataFrame, predictions: DataFrame, taxon: str = "taxon",
                       count: str = "count") -> DataFrame:
    """C-12: per taxon, whether a prediction exists, and its own occurrence total."""
    tot = occurrences.groupBy(taxon).agg(F.sum(count).alias("occurrences"))
    has = predictions.select(taxon).distinct().withColumn("_has", F.lit(True))
    return (tot.join(has, taxon, "left")
               .select(taxon, F.when(F.col("_has"), "Yes").otherwise("No").alias("model"), "occurrences"))


def occurrence_search(df: DataFrame, name: str | None = None, taxon_id: int | None = None,
                      bbox: Sequence[float] | None = None, sources: Sequence[str] | None = None,
                      limit: int | None = None, lat: str = "lat", lon: str = "lon",
                      species: str = "species", taxon: str = "taxon_id", source: str = "source",
                      order: Sequence[str] = ("record_id",)) -> DataFrame:
    """C-13: records with coordinates by name, taxon id, box and source; `limit` per source.

    The first `limit` rows of a source are chosen in two steps (per hash slice, then per source),
    so that no task sorts a whole source.
    """
    d = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if name is not None:
        d = d.filter(F.col(species) == name)
    if taxon_id is not None:
        d = d.filter(F.col(taxon) == taxon_id)
    if bbox is not None:
        w, s, e, n = bbox
        d = d.filter(F.col(lon).between(w, e) & F.col(lat).between(s, n))
    if sources is not None:
        d = d.filter(F.col(source).isin(list(sources)))
    if limit is not None:
        slice_ = F.pmod(F.xxhash64(*order), F.lit(256))
        d = (d.withColumn("_s", slice_)
              .withColumn("_k", F.row_number().over(W.partitionBy(source, "_s").orderBy(*order)))
              .filter(F.col("_k") <= limit)
              .withColumn("_k", F.row_number().over(W.partitionBy(source).orderBy(*order)))
              .filter(F.col("_k") <= limit).drop("_s", "_k"))
    return d


def profile_select(df: DataFrame, region: Sequence[float] | None = None,
                   profiles: Sequence[tuple[int, int]] | None = None,
                   floats: Sequence[int] | None = None, pressure: tuple[float, float] | None = None,
                   dates: tuple[str, str] | None = None, lat: str = "lat", lon: str = "lon",
                   float_id: str = "float_id", cycle: str = "cycle", press: str = "pressure",
                   time: str = "time") -> DataFrame:
    """C-14: ocean profiles by region, by (float, cycle) pairs or by floats."""
    d = df
    if region is not None:
        w, e, s, n = region
        d = d.filter(F.col(lon).between(w, e) & F.col(lat).between(s, n))
    if profiles is not None:
        d = d.filter(reduce(lambda a, b: a | b, [(F.col(float_id) == f) & (F.col(cycle) == c)
                                                 for f, c in profiles]))
    if floats is not None:
        d = d.filter(F.col(float_id).isin(list(floats)))
    if pressure is not None:
        d = d.filter(F.col(press).between(*pressure))
    if dates is not None:
        d = d.filter((F.col(time) >= F.lit(dates[0]).cast("timestamp"))
                     & (F.col(time) < F.lit(dates[1]).cast("timestamp")))
    return d


def anonymize_coordinates(df: DataFrame, lon: str = "longitude", lat: str = "latitude",
                          depth: int = 3, seed: int = 1) -> DataFrame:
    """C-15: a secret series of shifts and turns of the plane; distances between points stay."""
    rng = random.Random(seed)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    for _ in range(depth):
        step = rng.choice(["x", "y", "turn"])
        if step == "x":
            x = x + F.lit(rng.uniform(-500, 500))
        elif step == "y":
            y = y + F.lit(rng.uniform(-500, 500))
        else:
            a, ox, oy = rng.uniform(0.1, 6.1), rng.uniform(-90, 90), rng.uniform(-90, 90)
            c, s = F.cos(F.lit(a)), F.sin(F.lit(a))
            x, y = (c * (x - ox) - s * (y - oy) + ox, s * (x - ox) + c * (y - oy) + oy)
    return df.select(*[F.col(k) for k in df.columns if k not in (lon, lat)],
                     x.alias("longitude"), y.alias("latitude"))


def relabel_by_pattern(df: DataFrame, rules: Sequence[tuple[str, str]],
                       names: Mapping[str, str] | None = None, col: str = "site",
                       name_col: str = "site_name") -> DataFrame:
    """C-16: the first matching pattern gives the code, the code gives a display name."""
    code = reduce(lambda acc, r: acc.when(F.col(col).rlike(r[0]), F.lit(r[1])), rules[1:],
                  F.when(F.col(col).rlike(rules[0][0]), F.lit(rules[0][1]))).otherwise(F.col(col))
    d = df.withColumn(col, code)
    if names:
        table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        d = d.withColumn(name_col, F.coalesce(F.try_element_at(table, F.col(col)), F.col(col)))
    return d


def impute_replicates(df: DataFrame, replicates: Sequence[str], total: str, factor: float = 100) -> DataFrame:
    """C-17: total from replicate counts when it is missing or contradicts a mean that is not 0."""
    vals = F.filter(F.array(*[F.col(c).cast("double") for c in replicates]), lambda x: x.isNotNull())
    mean = F.floor(safe_div(F.aggregate(vals, F.lit(0.0), lambda a, x: a + x), F.size(vals)) * factor)
    t = F.col(total).cast("long")
    return df.withColumn(total, F.when(t.isNull(), mean)
                         .when((mean != 0) & (t != mean), mean).otherwise(t).cast("long"))


def clip_and_fill(df: DataFrame, cols: Sequence[str], top: float = 100, fill: float = 0,
                  region: str | None = None, fill_regions: Sequence[str] | None = None) -> DataFrame:
    """C-18: values above `top` become `top`; missing becomes `fill` in the given regions."""
    where = F.col(region).isin(list(fill_regions)) if fill_regions is not None else F.lit(True)
    out = {}
    for c in cols:
        v = F.when(F.col(c).isNotNull(), F.least(F.col(c), F.lit(top)))
        out[c] = F.when(F.col(c).isNull() & where, F.lit(fill)).otherwise(v)
    return df.withColumns(out)


def accretion_correct(df: DataFrame, cols: Sequence[str], keys: Sequence[str], face: str = "face",
                      colour: str = "colour", covered: str = "covered", mussels: str = "mussels",
                      region: str = "region", strict_regions: Sequence[str] = ("EGMP", "BASQ"),
                      upper: str = "upper", lower: str = "lower",
                      colours: Sequence[str] = BRIGHT_COLOURS) -> DataFrame:
    """C-19: lower-face cover over the free surface when the upper face of the block is bright.

    In the strict regions only where some surface is covered and the upper face has no mussels.
    Results that are not finite become 0, above 100 become 100; other faces pass through.
    """
    up = (df.filter(F.col(face) == upper).groupBy(*keys)
            .agg(F.max(F.col(colour).isin(list(colours))).alias("_bright"), F.max(mussels).alias("_mus")))
    low = df.filter(F.col(face) == lower).join(up, list(keys), "left")
    apply = F.coalesce(F.col("_bright"), F.lit(False)) & (
        ~F.col(region).isin(list(strict_regions)) | ((F.col(covered) != 0) & (F.col("_mus") == 0)))
    value = lambda c: F.when(apply, F.try_divide(F.col(c).cast("double"), 100 - F.col(covered).cast("double")) * 100).otherwise(
        F.col(c).cast("double"))
    # least() skips NULL, so a result that is not finite becomes 0 first
    fix = {c: F.least(F.lit(100.0), F.coalesce(value(c), F.lit(0.0))) for c in cols}
    rest = df.filter(F.col(face) != lower).withColumns({c: F.col(c).cast("double") for c in cols})
    return low.withColumns(fix).select(*df.columns).unionByName(rest)


def assign_quadrat(df: DataFrame, block: str = "block_no", kind: str = "block_type",
                   mobile: str = "mobile", month: str | None = None) -> DataFrame:
    """C-20: quadrat Q1..Q5: two mobile blocks or one fixed block each; period from the month."""
    q = F.when(F.col(kind) == mobile, F.ceil(F.col(block) / 2)).otherwise(F.col(block))
    d = df.withColumn("quadrat", F.when(q.between(1, 5), F.concat(F.lit("Q"), q.cast("string"))))
    if month:
        d = d.withColumn("period", F.when(F.col(month) < 7, "first").otherwise("second"))
    return d


def harmonize_columns(df: DataFrame, synonyms: Mapping[str, Sequence[str]] = OCEAN_SYNONYMS,
                      state: str | None = None, unit_cols: Sequence[str] = (),
                      coordinates: Sequence[str] = OCEAN_COORDINATES) -> DataFrame:
    """C-21: one name per variable with its state as suffix, common units, longitude in
    -180..180 and time as decimal days since 1950."""
    used, out = set(), []
    for name, alts in synonyms.items():
        found = [a for a in alts if a in df.columns]
        if not found:
            continue
        used.update(found)
        v = F.coalesce(*[F.col(f"`{a}`") for a in found])
        if name == "lon":
            v = F.pmod(v.cast("double") + 180, F.lit(360.0)) - 180
        if name == "time":
            v = F.unix_micros(v.cast("timestamp")) / F.lit(86400e6) + 7305
        out.append(v.alias(name if state is None or name in coordinates else f"{name}_{state}"))
    for c in unit_cols:
        used.add(c)
        flat = {a: k for k, al in OCEAN_UNITS.items() for a in al}
        table = F.create_map(*[F.lit(x) for kv in flat.items() for x in kv])
        out.append(F.coalesce(F.try_element_at(table, F.col(c)), F.col(c)).alias(c))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in used], *out)


def map_semantics(df: DataFrame, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """C-22: rename columns found in the lists of accepted names (case ignored)."""
    low = {c.lower(): c for c in df.columns}
    out = df
    for name, alts in accepted.items():
        for a in alts:
            if a.lower() in low:
                out = out.withColumnRenamed(low[a.lower()], name)
                break
    return out


def merge_complementary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C-23: rows of one key become one row if no column disagrees, else all of them stay.

    Agreement is min = max per column, so a key with very many rows combines before the
    shuffle; only rows of disagreeing keys are read again.
    """
    rest = [c for c in df.columns if c not in keys]
    d = df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in rest]))
    g = d.groupBy(*keys).agg(*[F.min(c).alias(f"_a_{c}") for c in rest],
                             *[F.max(c).alias(f"_z_{c}") for c in rest])
    agree = reduce(lambda a, b: a & b, [F.col(f"_a_{c}").eqNullSafe(F.col(f"_z_{c}")) for c in rest])
    merged = g.filter(agree).select(*keys, *[F.col(f"_a_{c}").alias(c) for c in rest])
    bad = g.filter(~agree).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return merged.unionByName(d.join(bad, same, "left_semi").select(*keys, *rest))


def complete_rows(df: DataFrame, cols: Sequence[str], require_some: bool = True) -> DataFrame:
    """C-24: drop rows with a missing essential value; fail when none is left."""
    out = df.dropna(subset=list(cols))
    if require_some and out.isEmpty():
        raise ValueError(f"no row has all of {list(cols)}")
    return out


def ordered_filters(df: DataFrame, order: Sequence[str],
                    filters: Mapping[str, Callable[[DataFrame], DataFrame]],
                    counts: Mapping[str, Column]) -> tuple[DataFrame, DataFrame, str]:
    """C-25: apply named filters in the user's order; also a summary with one row per step and
    the suffix made of the names."""
    parts, cur = [], df
    for step, name in enumerate(["start", *order]):
        if step:
            cur = filters[name](cur)
        parts.append(cur.agg(*[c.alias(k) for k, c in counts.items()])
                     .select(F.lit(step).alias("step"), F.lit(name).alias("filter"), *counts))
    return cur, reduce(DataFrame.unionByName, parts), "".join(f"_{n}" for n in order)


def one_hot(df: DataFrame, cols: Sequence[str], keep_numeric: bool = True) -> DataFrame:
    """C-26: a text column becomes one 0/1 column per level, NULL where it is missing; a column
    whose every value is a number is converted instead."""
    good = df.agg(*[F.bool_and(F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()).alias(c)
                    for c in cols]).first().asDict()
    out = df
    for c in cols:
        if keep_numeric and good[c]:
            out = out.withColumn(c, F.col(c).try_cast("double"))
            continue
        levels = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
        out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for v in levels}).drop(c)
    return out
