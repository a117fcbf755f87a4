"""Acoustic survey queries (A)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import acoustic as op
from .registry import query
from .views import DET, detections, table

NEAREST = f"""WITH {DET}, v AS (SELECT taxon, time_num AS t, max(id_valid) AS id FROM det WHERE id_valid <> '' GROUP BY ALL),
lo AS (SELECT d.*, v.t AS tl, v.id AS il FROM det d ASOF LEFT JOIN v ON d.taxon = v.taxon AND d.time_num >= v.t),
b AS (SELECT lo.*, v.t AS th, v.id AS ih FROM lo ASOF LEFT JOIN v ON lo.taxon = v.taxon AND lo.time_num <= v.t),
n AS (SELECT *, CASE WHEN th IS NOT NULL AND (tl IS NULL OR th - time_num <= time_num - tl) THEN ih ELSE il END AS near FROM b),
s AS (SELECT taxon, count(*) FILTER (id_valid <> '') AS nv, count(DISTINCT id_valid) FILTER (id_valid <> '') AS nd, max(prob) FILTER (id_valid <> '' AND id_valid <> taxon) AS pw,
  max(prob) FILTER (id_valid = taxon) AS pr, any_value(id_valid) FILTER (id_valid <> '') AS v1, max(struct_pack(p := prob, t := time_num, id := id_valid)) FILTER (id_valid <> '') AS top FROM det GROUP BY taxon),
a AS (SELECT det.taxon, min(prob) AS nx FROM det JOIN s ON s.taxon = det.taxon WHERE id_valid <> '' AND prob > pw GROUP BY det.taxon),
x AS (SELECT n.*, nv, nd, pw, pr, v1, top.id AS topid, (pw + coalesce(nx, pw)) / 2 AS thr FROM n JOIN s ON s.taxon = n.taxon LEFT JOIN a ON a.taxon = n.taxon),
ext AS (SELECT *, CASE WHEN nv = 0 THEN taxon WHEN nd = 1 THEN v1 WHEN pr > pw AND prob > thr THEN topid ELSE near END AS id_extrap,
  CASE WHEN nv = 0 THEN 0 WHEN nd = 1 OR (pr > pw AND prob > thr) THEN 2 ELSE 1 END AS type_e FROM x)"""


def _ext(spark, sf):
    return op.extrapolate_ids(detections(spark, sf))


@query("extrapolate_ids", "A-01", sql=f"{NEAREST} SELECT event_id, id_extrap, type_e FROM ext", i="event_id type_e")
def extrapolate_ids(spark, sf):
    return _ext(spark, sf).select("event_id", "id_extrap", "type_e")


RANK = "CASE conf_valid WHEN '' THEN 1 WHEN 'POSSIBLE' THEN 2 WHEN 'PROBABLE' THEN 3 ELSE 4 END"
RISK = f"risk AS (SELECT id_extrap, max({RANK}) AS conf_rank, least(CAST(round_even((1 - max(prob)) * 100, 0) AS BIGINT), [99, 50, 10, 1][max({RANK})]) AS risk FROM ext GROUP BY id_extrap)"


@query("error_risk", "A-02", sql=f"{NEAREST}, {RISK} SELECT id_extrap, risk, conf_rank FROM risk", i="risk conf_rank")
def error_risk(spark, sf):
    return op.error_risk(_ext(spark, sf))


@query("validated_files", "A-03", sql=f"{NEAREST} SELECT id_extrap, count(DISTINCT CASE WHEN id_valid <> '' THEN file END) AS files_validated FROM ext GROUP BY id_extrap", i="files_validated")
def validated_files(spark, sf):
    return op.validated_files(_ext(spark, sf))


def _gap(col: str, name: str) -> str:
    return f"""g_{name} AS (SELECT e.id_extrap, median(least(coalesce(e.{col} - l.v, 'inf'::DOUBLE), coalesce(h.v - e.{col}, 'inf'::DOUBLE))) AS gap_{name}
  FROM ext e ASOF LEFT JOIN (SELECT DISTINCT id_extrap, {col} AS v FROM ext WHERE id_valid <> '') l ON l.id_extrap = e.id_extrap AND e.{col} >= l.v
  ASOF LEFT JOIN (SELECT DISTINCT id_extrap, {col} AS v FROM ext WHERE id_valid <> '') h ON h.id_extrap = e.id_extrap AND e.{col} <= h.v GROUP BY e.id_extrap)"""


EFFORT = f"""{_gap('prob', 'score')}, {_gap('time_num', 'time')},
eff AS (SELECT id_extrap, conf_rank, gap_score, gap_time, 1 / gap_score / gap_time AS effort,
  ['-', 'FAIBLE', 'SUFFISANT', 'SUFFISANT', 'FORT', 'FORT'][CAST(1 / gap_score / gap_time > 0.0005 AS INT) + CAST(1 / gap_score / gap_time > 0.005 AS INT) + conf_rank] AS effort_class
  FROM g_score JOIN g_time USING (id_extrap) JOIN risk USING (id_extrap))"""


@query("validation_effort", "A-04", sql=f"{NEAREST}, {RISK}, {EFFORT} SELECT id_extrap, gap_score, gap_time, effort, effort_class FROM eff", r="gap_score gap_time:3 effort:4")
def validation_effort(spark, sf):
    return op.validation_effort(_ext(spark, sf))


def _reference(spark, sf):
    """Reference quantiles for four of the five classes."""
    s = detections(spark, sf).select(F.col("taxon").alias("id_extrap")).distinct().filter("id_extrap <> 'view'")
    n = F.length("id_extrap")
    return s.select("id_extrap", (n * 8.0).alias("q25"), (n * 14.0).alias("q75"), (n * 22.0).alias("q98"))


REF = """ref AS (SELECT DISTINCT event_type AS id_extrap, length(event_type) * 8.0::DOUBLE AS q25, length(event_type) * 14.0::DOUBLE AS q75, length(event_type) * 22.0::DOUBLE AS q98
  FROM events WHERE event_type <> 'view')"""
LEVEL = "CASE WHEN q25 IS NULL THEN NULL WHEN {c} <= q25 THEN 1 WHEN {c} <= q75 THEN 2 WHEN {c} <= q98 THEN 3 ELSE 4 END"
WORDS = "['FAIBLE', 'MODEREE', 'FORTE', 'TRES FORTE']"
ACT = f"""cn AS (SELECT id_extrap, count(*) / ((SELECT date_diff('day', min(night), max(night)) + 1 FROM ext))::DOUBLE AS contacts FROM ext GROUP BY id_extrap),
act AS (SELECT cn.id_extrap, contacts, {LEVEL.format(c='contacts')} AS lv FROM cn LEFT JOIN ref ON ref.id_extrap = cn.id_extrap)"""


@query("activity_level", "A-05", sql=f"{NEAREST}, {REF}, {ACT} SELECT id_extrap, contacts, lv AS activity_rank, {WORDS}[lv] AS activity FROM act", r="contacts", i="activity_rank")
def activity_level(spark, sf):
    return op.activity_level(op.contacts_per_night(_ext(spark, sf)), _reference(spark, sf))


def _groups(spark, sf):
    s = detections(spark, sf).select(F.col("taxon").alias("id_extrap")).distinct()
    n = F.length("id_extrap")
    return s.withColumn("group", F.when(n == 4, "Autre").when(n == 5, "Sauterelle").otherwise("Chauve-souris"))


GRP = """grp AS (SELECT DISTINCT event_type AS id_extrap, CASE length(event_type) WHEN 4 THEN 'Autre' WHEN 5 THEN 'Sauterelle' ELSE 'Chauve-souris' END AS "group",
  CASE length(event_type) WHEN 4 THEN 1 WHEN 5 THEN 2 ELSE 3 END AS group_rank FROM events)"""


@query("site_summary", "A-06", sql=f"""{NEAREST}, {RISK}, {EFFORT}, {REF}, {ACT}, {GRP}, vf AS (SELECT id_extrap, count(DISTINCT CASE WHEN id_valid <> '' THEN file END) AS files_validated FROM ext GROUP BY id_extrap)
SELECT grp.*, risk, conf_rank, files_validated, effort_class, round_even(contacts, 0) AS contacts, {WORDS}[lv] AS activity
FROM grp JOIN risk USING (id_extrap) JOIN vf USING (id_extrap) JOIN eff USING (id_extrap, conf_rank) JOIN act USING (id_extrap)""", i="risk conf_rank files_validated contacts group_rank")
def site_summary(spark, sf):
    return op.site_summary(_ext(spark, sf), _reference(spark, sf), _groups(spark, sf))


@query("contacts_by_night", "A-07", sql=f"""{NEAREST}, {REF}, c AS (SELECT id_extrap, CAST(night AS VARCHAR) AS night, count(*) AS contacts FROM ext GROUP BY ALL)
SELECT c.id_extrap, night, contacts, {LEVEL.format(c='contacts')} AS activity_rank, {WORDS}[{LEVEL.format(c='contacts')}] AS activity FROM c LEFT JOIN ref ON ref.id_extrap = c.id_extrap""", i="contacts activity_rank")
def contacts_by_night(spark, sf):
    d = _ext(spark, sf).withColumn("night", F.col("night").cast("string"))
    return op.contacts_by_night(d, _reference(spark, sf), night="night")


@query("contacts_by_night_wide", "A-07", sql=f"""{NEAREST}, {REF}, c AS (SELECT id_extrap, CAST(night AS VARCHAR) AS night, count(*) AS n FROM ext GROUP BY ALL)
SELECT c.id_extrap, coalesce(max(CASE WHEN night = '2024-01-02' THEN n END), 0) AS d2_n, max(CASE WHEN night = '2024-01-02' THEN {LEVEL.format(c='n')} END) AS d2_level,
  coalesce(max(CASE WHEN night = '2024-01-03' THEN n END), 0) AS d3_n, max(CASE WHEN night = '2024-01-03' THEN {LEVEL.format(c='n')} END) AS d3_level
FROM c LEFT JOIN ref ON ref.id_extrap = c.id_extrap GROUP BY c.id_extrap""", i="d2_n d2_level d3_n d3_level")
def contacts_by_night_wide(spark, sf):
    d = _ext(spark, sf).withColumn("night", F.col("night").cast("string"))
    w = op.contacts_by_night(d, _reference(spark, sf), nights=["2024-01-02", "2024-01-03"], night="night")
    return w.toDF("id_extrap", "d2_n", "d2_level", "d3_n", "d3_level")


HOURS = [*range(17, 24), *range(0, 17)]


@query("contacts_by_hour", "A-08", sql=f"{NEAREST} SELECT id_extrap, " + ", ".join(f"count(*) FILTER (hour = {h}) AS h{h:02d}" for h in HOURS) + " FROM ext GROUP BY id_extrap", i=" ".join(f"h{h:02d}" for h in HOURS))
def contacts_by_hour(spark, sf):
    return op.contacts_by_hour(_ext(spark, sf))


PCTS = list(range(5, 100, 5))


@query("hour_breaks", "A-08", sql=f"{NEAREST}, c AS (SELECT id_extrap, hour, count(*) AS n FROM ext GROUP BY ALL) SELECT " + ", ".join(f"quantile_cont(n, {p / 100}) - 1 AS p{p:02d}" for p in PCTS) + " FROM c",
       r=" ".join(f"p{p:02d}" for p in PCTS))
def hour_breaks(spark, sf):
    return op.hour_breaks(_ext(spark, sf))


def _stereo(spark, sf):
    """Detections with two microphones: odd ones direct, even ones in time expansion, whose files end by half a second."""
    d = _ext(spark, sf)
    return d.withColumn("file", F.concat(F.lit("Cir-2014-P-Tron"), (F.col("k") % 12).cast("string"), F.lit("-C_"), (F.col("k") % 2).cast("string"), F.lit("_00001_000"))) \
            .withColumn("end_time", F.when(F.col("k") % 2 == 1, F.col("prob")).when(F.col("prob") > 1, 0.5).otherwise(F.col("prob") / 2)).withColumn("section", F.concat(F.lit("t"), (F.col("k") % 3).cast("string")))


@query("stereo_channel", "A-09", sql=f"""{NEAREST} SELECT event_id, CASE WHEN k % 2 = 1 THEN 'Direct' ELSE 'Expansion' END AS channel FROM ext""", i="event_id")
def stereo_channel(spark, sf):
    return op.stereo_channel(_stereo(spark, sf)).select("event_id", "channel")


CH = f"""ch AS (SELECT id_extrap, count(*) FILTER (k % 2 = 0) AS e, count(*) FILTER (k % 2 = 1) AS d FROM ext GROUP BY id_extrap)"""


@query("transect_summary", "A-10", sql=f"""{NEAREST}, {RISK}, {EFFORT}, {REF}, {GRP}, {CH}, vf AS (SELECT id_extrap, count(DISTINCT CASE WHEN id_valid <> '' THEN (k % 12) * 10 + k % 2 END) AS files_validated FROM ext GROUP BY id_extrap)
SELECT grp.*, risk, conf_rank, files_validated, effort_class, e AS contacts_expansion, d AS contacts_direct, {WORDS}[CASE WHEN e = 0 THEN NULL ELSE {LEVEL.format(c='e')} END] AS activity_expansion,
  {WORDS}[CASE WHEN d = 0 THEN NULL ELSE {LEVEL.format(c='d')} END] AS activity_direct FROM grp JOIN risk USING (id_extrap) JOIN vf USING (id_extrap) JOIN eff USING (id_extrap, conf_rank) JOIN ch USING (id_extrap) LEFT JOIN ref USING (id_extrap)""",
       i="risk conf_rank files_validated contacts_expansion contacts_direct group_rank")
def transect_summary(spark, sf):
    d, ref = op.stereo_channel(_stereo(spark, sf)), _reference(spark, sf)
    return op.transect_summary(d, ref, ref, _groups(spark, sf))


@query("contacts_by_section", "A-10", sql=f"""{NEAREST} SELECT id_extrap, CASE WHEN k % 2 = 1 THEN 'Direct' ELSE 'Expansion' END AS channel, count(*) FILTER (k % 3 = 0) AS t0, count(*) FILTER (k % 3 = 1) AS t1,
  count(*) FILTER (k % 3 = 2) AS t2 FROM ext GROUP BY ALL""", i="t0 t1 t2")
def contacts_by_section(spark, sf):
    return op.contacts_by_section(op.stereo_channel(_stereo(spark, sf)), ["t0", "t1", "t2"], section="section")
