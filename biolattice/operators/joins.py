"""Lookups, nearest matches and range joins (J-01 .. J-14)."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import great_circle_m, unit_vector
from ..functions.scale import cut_lineage, first_per_key, join_small, nearest_marked


def lookup(df: DataFrame, ref: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """J-01: left lookup of the first reference row per key, NULL on a miss."""
    one = (first_per_key(ref, [key], [position]).drop(position) if position
           else ref.dropDuplicates([key]))
    return df.join(one, key, "left")


def match_rows(df: DataFrame, other: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None,
               how: str = "inner") -> DataFrame:
    """J-02 / J-03: inner, left, full, semi or anti equi-join by left and right names."""
    right_on = list(right_on or left_on)
    o = other.withColumnsRenamed({r: l for l, r in zip(left_on, right_on) if l != r})
    return df.join(o, list(left_on), how)


def expand_header(details: DataFrame, headers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-04: the sheet header repeated for each of its detail rows, matched by key."""
    return details.join(headers, list(keys), "left")


def nearest_point(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                  lat: str = "lat", lon: str = "lon", right_lat: str | None = None,
                  right_lon: str | None = None, distance: str = "distance_m") -> DataFrame:
    """J-05: for every left row the nearest right point on the sphere and its distance.

    Both sides are first reduced to distinct places. Right places fall into nested cubes over the
    unit sphere; each left place walks down from large to small cubes and at every level keeps only
    the cubes that can still hold its nearest point (closest corner not beyond the best farthest
    corner). Every step is an equi-join on a cube key, no level compares all pairs, and the result
    is exact. Ties go to the smaller right id.
    """
    rlat, rlon = right_lat or lat, right_lon or lon
    lp = (left.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .select(F.col(lat).alias("la"), F.col(lon).alias("lo")).distinct())
    lp = lp.withColumns(dict(zip(["x", "y", "z"], unit_vector("la", "lo"))))
    rp = (right.filter(F.col(rlat).isNotNull() & F.col(rlon).isNotNull())
               .groupBy(F.col(rlat).alias("rla"), F.col(rlon).alias("rlo"))
               .agg(F.min(right_id).alias("rid")))
    rp = cut_lineage(rp.withColumns(dict(zip(["rx", "ry", "rz"], unit_vector("rla", "rlo")))))
    n = rp.count()

    def cube(cols, level):
        size = 2.0 / 2 ** level
        return [F.floor((F.col(c) + 1.0) / size).cast("int") for c in cols]

    # clustered points need smaller cubes: go on until none holds many, or cubes are a metre wide
    depth = max(1, math.ceil(math.log(max(n, 2) / 4, 4))) + 1
    while depth < 23 and (rp.groupBy(*cube(["rx", "ry", "rz"], depth)).count().agg(F.max("count")).first()[0] or 0) > 64:
        depth += 1
    levels = list(range(1, depth + 1))

    cand = None
    for level in levels:
        size = 2.0 / 2 ** level
        occ = rp.select(*[c.alias(f"p{k}") for k, c in zip("xyz", cube(["rx", "ry", "rz"], level - 1))],
                        *[c.alias(f"c{k}") for k, c in zip("xyz", cube(["rx", "ry", "rz"], level))]).distinct()
        if cand is None:
            # the one root cube: every level-1 cube (at most 27) is a candidate
            start = [F.explode(F.array(*[F.struct(F.lit(i).alias("cx"), F.lit(j).alias("cy"),
                                                  F.lit(k).alias("cz"))
                                         for i in range(3) for j in range(3) for k in range(3)])).alias("c")]
            nxt = (lp.select("la", "lo", "x", "y", "z", *start).select("la", "lo", "x", "y", "z", "c.*")
                     .join(occ.select("cx", "cy", "cz").distinct(), ["cx", "cy", "cz"], "left_semi"))
        else:
            up = cand.withColumnsRenamed({"cx": "px", "cy": "py", "cz": "pz"})
            nxt = up.join(occ, ["px", "py", "pz"]).drop("px", "py", "pz")
        near, far = F.lit(0.0), F.lit(0.0)
        for k in "xyz":
            lo_edge = F.col(f"c{k}") * size - 1.0
            hi_edge = lo_edge + size
            near = near + F.pow(F.greatest(lo_edge - F.col(k), F.col(k) - hi_edge, F.lit(0.0)), 2)
            far = far + F.pow(F.greatest(F.abs(F.col(k) - lo_edge), F.abs(F.col(k) - hi_edge)), 2)
        # a place keeps at most a thin shell of cubes per level
        w = W.partitionBy("la", "lo")
        cand = (nxt.withColumn("_near", near).withColumn("_far", F.min(far).over(w))
                   .filter(F.col("_near") <= F.col("_far") + 1e-12).drop("_near", "_far"))
        if level % 4 == 0:
            cand = cut_lineage(cand)
    fin = rp.select("rid", "rla", "rlo", *[c.alias(f"c{k}") for k, c in
                                           zip("xyz", cube(["rx", "ry", "rz"], levels[-1]))])
    best = (cand.join(fin, ["cx", "cy", "cz"])
                .withColumn("_d", great_circle_m("la", "lo", "rla", "rlo"))
                .groupBy("la", "lo")
                .agg(F.min(F.struct("_d", "rid")).alias("b"))
                .select(F.col("la").alias(lat), F.col("lo").alias(lon), F.col("b.rid").alias(f"nearest_{right_id}"),
                        F.col("b._d").alias(distance)))
    return left.join(best, [lat, lon], "left").select(
        *left.columns, f"nearest_{right_id}", distance)


def nearest_in_time(df: DataFrame, by: Sequence[str], time: str, is_valid: str,
                    carry: Sequence[str], prefix: str = "near_") -> DataFrame:
    """J-06: each record gets the validated record of its group nearest in time (later on ties)."""
    return nearest_marked(df, by, time, is_valid, carry, prefix)


def rounded_coordinate_join(a: DataFrame, b: DataFrame, by: Sequence[str], values: Sequence[str],
                            lat: str = "lat", lon: str = "lon", digits: int = 2) -> DataFrame:
    """J-07: join on rounded coordinates, then the mean of the values per group, NULL rows dropped.

    Each side is summed by coordinates and its own group columns first, so the join never makes a row for each pair of rows that
    share a place: a row of one side counts as often as the other side's group has rows.
    """
    r = {lat: F.round(lat, digits), lon: F.round(lon, digits)}
    a, b = a.withColumns(r), b.withColumns(r)
    mean = a.join(b, [lat, lon]).groupBy(*by).agg(*[F.avg(v).alias(v) for v in values]).schema

    def summed(d: DataFrame, rows: str) -> DataFrame:
        sums = [f(F.col(v).cast(t)).alias(f"_{n}_{v}") for v in values if v in d.columns
                for t in ["double" if mean[v].dataType.typeName() == "double" else mean[v].dataType] for n, f in (("s", F.sum), ("n", F.count))]
        return d.groupBy(lat, lon, *[c for c in by if c in d.columns and c not in (lat, lon)]).agg(F.count(F.lit(1)).alias(rows), *sums)

    d = summed(a, "_of_a").join(summed(b, "_of_b"), [lat, lon])
    times = {v: F.col("_of_b" if v in a.columns else "_of_a") for v in values}
    means = [F.try_divide(F.sum(F.col(f"_s_{v}") * times[v]), F.sum(F.col(f"_n_{v}") * times[v])).cast(mean[v].dataType).alias(v) for v in values]
    return d.groupBy(*by).agg(*means).dropna()


def enrich_with_grid(obs: DataFrame, grid: DataFrame, values: Sequence[str], tolerance: float,
                     obs_id: str, lat: str = "lat", lon: str = "lon", time: str | None = "time",
                     depth: str | None = None) -> DataFrame:
    """J-08: mean of grid values in a box around each observation at the nearest date and depth.

    Boxes are split over cells of the tolerance's size and matched by cell, never by a range
    comparison of everything with everything.
    """
    d = obs
    join_dims = []
    for dim in (time, depth):
        if dim is None:
            continue
        num = (lambda c: F.unix_micros(c)) if dim == time else (lambda c: F.col(c).cast("double"))
        marks = grid.select(num(dim).alias("_t")).distinct().withColumn("_g", F.lit(True))
        pts = d.select(num(dim).alias("_t")).distinct().withColumn("_g", F.lit(False))
        near = (nearest_marked(marks.unionByName(pts), [], "_t", "_g", [], "near_")
                .filter(~F.col("_g")).select(F.col("_t").alias(f"_o_{dim}"), F.col("near__t").alias(f"_n_{dim}")))
        d = d.withColumn(f"_o_{dim}", num(dim)).join(near, f"_o_{dim}").drop(f"_o_{dim}")
        grid = grid.withColumn(f"_n_{dim}", num(dim).cast("double"))
        join_dims.append(f"_n_{dim}")
    half = tolerance / 2
    cells = lambda c: F.sequence(F.floor((F.col(c) - half) / tolerance), F.floor((F.col(c) + half) / tolerance))
    d = d.withColumn("_i", F.explode(cells(lat))).withColumn("_j", F.explode(cells(lon)))
    g = grid.select(F.col(lat).alias("_la"), F.col(lon).alias("_lo"), *join_dims, *values,
                    F.floor(F.col(lat) / tolerance).alias("_i"), F.floor(F.col(lon) / tolerance).alias("_j"))
    hit = d.join(g, ["_i", "_j", *join_dims]).filter(
        F.col("_la").between(F.col(lat) - half, F.col(lat) + half)
        & F.col("_lo").between(F.col(lon) - half, F.col(lon) + half))
    means = hit.groupBy(obs_id).agg(*[F.avg(v).alias(v) for v in values])
    return obs.join(means, obs_id, "left")


def match_tree_and_community(edges: DataFrame, community: DataFrame, tip: str = "tip",
                             species: str = "species") -> tuple[DataFrame, DataFrame]:
    """J-09: the tips and the community rows of species present in both."""
    tips = edges.filter(F.col(tip).isNotNull())
    com = community.join(tips.select(F.col(tip).alias(species)).distinct(), species, "left_semi")
    kept = tips.join(community.select(F.col(species).alias(tip)).distinct(), tip, "left_semi")
    return kept, com


def join_traits(df: DataFrame, traits: DataFrame, types: Sequence[str], taxon: str = "taxon",
                kind: str = "trait", value: str = "value", position: str = "position",
                drop_missing: bool = False) -> DataFrame:
    """J-10: requested measurement types as columns; the last non-missing value of a taxon wins."""
    wide = (traits.filter(F.col(kind).isin(list(types)) & F.col(value).isNotNull())
                  .groupBy(taxon).agg(*[F.max_by(F.when(F.col(kind) == t, F.col(value)),
                                                 F.when(F.col(kind) == t, F.col(position))).alias(t)
                                        for t in types]))
    out = df.join(wide, taxon, "left")
    return out.dropna(subset=list(types)) if drop_missing else out


def keep_remove_individuals(v: DataFrame, names: DataFrame, action: str = "keep", ind: str = "ind") -> DataFrame:
    """J-11: keep or remove listed individuals; names not in the data do nothing."""
    how = {"keep": "left_semi", "remove": "left_anti"}[action]
    return v.join(names.select(F.trim(F.col(names.columns[0])).alias(ind)).distinct(), ind, how)


def with_population(v: DataFrame, ind_pop: DataFrame, ind: str = "ind", pop: str = "pop") -> DataFrame:
    """J-12: variants of individuals that have a population; blank lines are skipped."""
    m = ind_pop.filter((F.trim(ind) != "") & (F.trim(pop) != "")).select(F.trim(ind).alias(ind), F.trim(pop).alias(pop))
    return v.join(m.distinct(), ind)


def split_by_population(v: DataFrame, ind_pop: DataFrame, path: str, ind: str = "ind", pop: str = "pop",
                        mode: str = "error") -> None:
    """J-12: one folder per population."""
    with_population(v, ind_pop, ind, pop).write.mode(mode).partitionBy(pop).parquet(path)


def pairs_within(df: DataFrame, group: Sequence[str], key: str, block: int = 512) -> DataFrame:
    """J-13: the unordered pairs of each group, columns suffixed _a and _b (key_a < key_b).

    The pairs are what is asked for, so groups should be narrow (a survey visit, a quadrat). A
    large group is cut into blocks and each pair of blocks is a join key of its own, so no task
    handles more than block x block pairs.
    """
    group = list(group)
    rest = [c for c in df.columns if c not in group]
    size = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_k"))
    d = join_small(df, size, group).withColumn("_c", F.pmod(F.xxhash64(key), F.col("_k")).cast("int"))
    a = d.select(*group, *[F.col(c).alias(f"{c}_a") for c in rest], F.col("_c").alias("_i"),
                 F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_j"))
    b = d.select(*group, *[F.col(c).alias(f"{c}_b") for c in rest], F.col("_c").alias("_j"),
                 F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_i"))
    return (a.join(b, [*group, "_i", "_j"]).filter(F.col(f"{key}_a") < F.col(f"{key}_b"))
             .drop("_i", "_j"))


def attach_factors(df: DataFrame, units: DataFrame, species: DataFrame | None, metric: str,
                   unit: str = "observation_unit", code: str = "species",
                   per_100: Sequence[str] = ("density", "biomass"), fishing: bool = False,
                   size_class: str | None = None) -> DataFrame:
    """J-14: rows with a metric, with unit and species attributes looked up.

    Density and biomass are given per 100 m2 unless the survey is of fishing; presence is made
    from the number on demand; size classes get the rank of their lower bound.
    """
    d = df
    if metric == "presence_absence" and metric not in d.columns:
        d = d.withColumn(metric, (F.col("number") > 0).cast("int"))
    d = d.filter(F.col(metric).isNotNull()).join(units, unit, "left")
    if species is not None:
        d = d.join(species, code, "left")
    if metric in per_100 and not fishing:
        d = d.withColumn(metric, F.col(metric) * 100)
    if size_class:
        low = F.regexp_extract(size_class, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
        d = d.withColumn("size_class_low", F.coalesce(low, F.lit(0.0)))
    return d
