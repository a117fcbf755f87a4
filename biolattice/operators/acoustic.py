"""Acoustic bat and bush-cricket surveys (A-01 .. A-10)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import cut_lineage, exact_quantiles, join_small, nearest_marked

# Confidence words with their risk in percent, effort and activity words, groups.
CONFIDENCE = {"": 99, "POSSIBLE": 50, "PROBABLE": 10, "SUR": 1}
EFFORT_WORDS = ["-", "FAIBLE", "SUFFISANT", "SUFFISANT", "FORT", "FORT"]
ACTIVITY_WORDS = ["FAIBLE", "MODEREE", "FORTE", "TRES FORTE"]
GROUP_ORDER = ["Autre", "Sauterelle", "Chauve-souris"]


def confidence_rank(c) -> Column:
    c = F.coalesce(F.col(c), F.lit(""))
    out = F.lit(1)
    for i, word in enumerate(CONFIDENCE):
        out = F.when(c == word, F.lit(i + 1)).otherwise(out)
    return out


def extrapolate_ids(df: DataFrame, taxon: str = "taxon", valid: str = "id_valid", prob: str = "prob",
                    time: str = "time_num", order: str | None = None) -> DataFrame:
    """A-01: id_extrap and type_e for every record, from the validated records of its machine taxon.

    None validated: the machine's id (0). One validated id: that id (2). Several, and the machine
    id is confirmed at a higher score than any error: above the threshold half way between the
    highest error and the next validated score the top id (2), else the validated id nearest in
    time (1). Otherwise nearest in time (1). Only per-taxon sums and bounds are joined back; the
    nearest lookup is cut into time buckets.
    """
    v = F.col(valid) != ""
    wrong, right = v & (F.col(valid) != F.col(taxon)), v & (F.col(valid) == F.col(taxon))
    tie = F.struct(F.col(prob), F.col(time)) if order is None else F.struct(F.col(prob), F.col(order))
    g = df.groupBy(taxon).agg(
        F.min(F.when(v, F.col(valid))).alias("_v1"), F.max(F.when(v, F.col(valid))).alias("_v2"),
        F.max(F.when(wrong, F.col(prob))).alias("_pw"), F.max(F.when(right, F.col(prob))).alias("_pr"),
        F.max_by(F.when(v, F.col(valid)), F.when(v, tie)).alias("_top"))
    # the validated score just above the highest error
    above = (join_small(df.filter(v), g.select(taxon, "_pw"), [taxon]).filter(F.col(prob) > F.col("_pw"))
               .groupBy(taxon).agg(F.min(prob).alias("_next")))
    g = (g.join(above, taxon, "left")
          .withColumn("_case", F.when(F.col("_v1").isNull(), 0).when(F.col("_v1") == F.col("_v2"), 1)
                      .when(F.col("_pr") > F.col("_pw"), 2).otherwise(3))
          .withColumn("_thr", (F.col("_pw") + F.coalesce(F.col("_next"), F.col("_pw"))) / 2)
          .select(taxon, "_case", "_v1", "_top", "_thr"))
    near = nearest_marked(df.withColumn("_mark", v), [taxon], time, "_mark", [valid], "_near_")
    d = join_small(near, g, [taxon])
    sure = (F.col("_case") == 2) & (F.col(prob) > F.col("_thr"))
    return (d.withColumn("id_extrap", F.when(F.col("_case") == 0, F.col(taxon)).when(F.col("_case") == 1, F.col("_v1"))
                         .when(sure, F.col("_top")).otherwise(F.col(f"_near_{valid}")))
             .withColumn("type_e", F.when(F.col("_case") == 0, 0).when((F.col("_case") == 1) | sure, 2)
                         .otherwise(1))
             .select(*df.columns, "id_extrap", "type_e"))


def error_risk(df: DataFrame, species: str = "id_extrap", prob: str = "prob", conf: str = "conf_valid") -> DataFrame:
    """A-02: the smaller of the machine's risk and the best confidence word's risk, in percent."""
    table = F.array(*[F.lit(v) for v in CONFIDENCE.values()])
    g = df.groupBy(species).agg(F.bround((1 - F.max(prob)) * 100).cast("int").alias("_m"),
                                F.max(confidence_rank(conf)).alias("conf_rank"))
    return g.select(species, F.least("_m", F.element_at(table, F.col("conf_rank"))).alias("risk"), "conf_rank")


def validated_files(df: DataFrame, species: str = "id_extrap", file: str = "file", valid: str = "id_valid") -> DataFrame:
    """A-03: files with at least one validated record, per species (0 when none)."""
    per = df.groupBy(species, file).agg(F.max((F.col(valid) != "").cast("int")).alias("_v"))
    return per.groupBy(species).agg(F.sum("_v").cast("long").alias("files_validated"))


def validation_effort(df: DataFrame, species: str = "id_extrap", prob: str = "prob", time: str = "time_num",
                      valid: str = "id_valid", conf: str = "conf_valid") -> DataFrame:
    """A-04: median gap in score and in time to the nearest validated record, effort and its word.

    The records are read several times, so they are stored once (five narrow columns).
    """
    d = cut_lineage(df.select(species, prob, time, conf, (F.col(valid) != "").alias("_mark")))
    out = d.groupBy(species).agg(F.max(confidence_rank(conf)).alias("conf_rank"))
    for col, name in ((prob, "gap_score"), (time, "gap_time")):
        near = nearest_marked(d.select(species, col, "_mark"), [species], col, "_mark", [], "_near_")
        near = near.withColumn("_gap", F.abs(F.col(col) - F.col(f"_near_{col}")))
        out = out.join(exact_quantiles(near, [species], "_gap", {name: .5}), species, "left")
    inf = F.lit(float("inf"))
    g1, g2 = F.coalesce(F.col("gap_score"), inf), F.coalesce(F.col("gap_time"), inf)
    inv = lambda g: F.when(g == 0, inf).otherwise(F.try_divide(F.lit(1.0), g))
    effort = F.when((g1 == inf) | (g2 == inf), F.lit(0.0)).otherwise(inv(g1) * inv(g2))
    rank = (effort > 0.0005).cast("int") + (effort > 0.005).cast("int") + F.col("conf_rank")
    words = F.array(*[F.lit(w) for w in EFFORT_WORDS])
    return out.select(species, g1.alias("gap_score"), g2.alias("gap_time"), effort.alias("effort"),
                      F.element_at(words, rank).alias("effort_class"))


def activity_rank(x, q25="q25", q75="q75", q98="q98") -> Column:
    """1..4, intervals closed on the right; NULL without a reference."""
    x = F.col(x) if isinstance(x, str) else x
    return (F.when(F.col(q25).isNull(), None).when(x <= F.col(q25), 1).when(x <= F.col(q75), 2)
            .when(x <= F.col(q98), 3).otherwise(4))


def activity_level(counts: DataFrame, reference: DataFrame, species: str = "id_extrap", count: str = "contacts",
                   out: str = "activity") -> DataFrame:
    """A-05: contacts against the quantiles of the reference table, as a word."""
    words = F.array(*[F.lit(w) for w in ACTIVITY_WORDS])
    d = counts.join(reference.select(species, "q25", "q75", "q98"), species, "left")
    return (d.withColumn(f"{out}_rank", activity_rank(count))
             .withColumn(out, F.when(F.col(f"{out}_rank").isNotNull(), F.element_at(words, F.col(f"{out}_rank"))))
             .drop("q25", "q75", "q98"))


def group_rank(group: str) -> Column:
    out = F.lit(None).cast("int")
    for i, g in enumerate(GROUP_ORDER):
        out = F.when(F.col(group) == g, F.lit(i + 1)).otherwise(out)
    return out


def contacts_per_night(df: DataFrame, species: str = "id_extrap", night: str = "night") -> DataFrame:
    n = F.datediff(df.agg(F.max(night)).scalar(), df.agg(F.min(night)).scalar()) + 1
    return df.groupBy(species).agg(F.count(F.lit(1)).alias("_c")).select(species, (F.col("_c") / n).alias("contacts"))


def site_summary(df: DataFrame, reference: DataFrame, groups: DataFrame, species: str = "id_extrap",
                 night: str = "night", group: str = "group") -> DataFrame:
    """A-06: risk, validation, effort, contacts per night and activity of each listed species."""
    df = cut_lineage(df)
    counts = activity_level(contacts_per_night(df, species, night), reference, species)
    out = (groups.join(error_risk(df, species), species).join(validated_files(df, species), species)
                 .join(validation_effort(df, species).select(species, "effort_class"), species)
                 .join(counts.drop("activity_rank"), species)
                 .withColumn("contacts", F.bround("contacts").cast("long")).withColumn("group_rank", group_rank(group)))
    return out.orderBy(F.desc_nulls_last("group_rank"), F.desc("contacts"))


def contacts_by_night(df: DataFrame, reference: DataFrame, nights: Sequence[str] | None = None,
                      species: str = "id_extrap", night: str = "session") -> DataFrame:
    """A-07: contacts per species and night, and their activity level, in long form; with a list of nights one
    column pair for each."""
    n = df.groupBy(species, night).agg(F.count(F.lit(1)).alias("contacts"))
    lv = activity_level(n, reference, species)
    if nights is None:
        return lv
    g = lv.groupBy(species).pivot(night, list(nights))
    out = g.agg(F.first("contacts").alias("n"), F.first("activity_rank").alias("level"))
    return out.fillna(0, [c for c in out.columns if c.endswith("_n")])


def contacts_by_hour(df: DataFrame, species: str = "id_extrap", hour: str = "hour") -> DataFrame:
    """A-08: contacts per species and hour, wide, evening hours (after 16) first."""
    order = [*range(17, 24), *range(0, 17)]
    g = df.groupBy(species).pivot(hour, order).agg(F.count(F.lit(1)))
    return g.select(species, *[F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(f"h{h:02d}") for h in order])


def hour_breaks(df: DataFrame, species: str = "id_extrap", hour: str = "hour") -> DataFrame:
    """A-08: quantiles 5 .. 95 % of the species-hour counts, less one: the colour scale."""
    n = df.groupBy(species, hour).agg(F.count(F.lit(1)).alias("contacts"))
    probs = {f"p{p:02d}": p / 100 for p in range(5, 100, 5)}
    q = exact_quantiles(n, [], "contacts", probs)
    return q.select(*[(F.col(k) - 1).alias(k) for k in probs])


def stereo_channel(df: DataFrame, file: str = "file", end: str = "end_time", check: bool = True) -> DataFrame:
    """A-09: microphone side from the file name; the direct side records beyond half a second."""
    bits = F.split(F.element_at(F.split(file, "-"), -1), "_")
    d = df.withColumn("right_mic", F.coalesce(F.try_element_at(bits, F.lit(-3)) == "1", F.lit(False)))
    side = d.groupBy("right_mic").agg((F.max(end) > 0.5).alias("direct"))
    if check and side.filter("direct").count() > 1:
        raise ValueError("both channels look like direct recordings")
    return join_small(d, side, ["right_mic"]).withColumn(
        "channel", F.when(F.col("direct"), "Direct").otherwise("Expansion"))


def transect_summary(df: DataFrame, ref_expansion: DataFrame, ref_direct: DataFrame, groups: DataFrame,
                     species: str = "id_extrap", group: str = "group", channel: str = "channel") -> DataFrame:
    """A-10: contacts and activity per channel, with risk, validation and effort."""
    df = cut_lineage(df)
    n = df.groupBy(species).pivot(channel, ["Expansion", "Direct"]).agg(F.count(F.lit(1)))
    out = n
    for c, ref in (("Expansion", ref_expansion), ("Direct", ref_direct)):
        lv = activity_level(n.filter(F.col(c).isNotNull()).select(species, F.col(c).alias("contacts")), ref, species,
                            out=f"activity_{c.lower()}").drop("contacts", f"activity_{c.lower()}_rank")
        out = out.join(lv, species, "left")
    out = (out.withColumn("contacts_expansion", F.coalesce("Expansion", F.lit(0)))
              .withColumn("contacts_direct", F.coalesce("Direct", F.lit(0))).drop("Expansion", "Direct"))
    out = (groups.join(error_risk(df, species), species).join(validated_files(df, species), species)
                 .join(validation_effort(df, species).select(species, "effort_class"), species).join(out, species)
                 .withColumn("group_rank", group_rank(group)))
    return out.orderBy(F.desc_nulls_last("group_rank"), F.desc("contacts_direct"), F.desc("contacts_expansion"))


def contacts_by_section(df: DataFrame, sections: Sequence[str] | None = None, species: str = "id_extrap",
                        channel: str = "channel", section: str = "session") -> DataFrame:
    """A-10: species x channel x section counts, in long form; with a list of sections one column for each."""
    if sections is None:
        return df.groupBy(species, channel, section).agg(F.count(F.lit(1)).alias("contacts"))
    return df.groupBy(species, channel).pivot(section, list(sections)).agg(F.count(F.lit(1))).fillna(0)
