"""Variant, population-genetic and phylogenetic queries (G)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import cut_lineage
from ..operators import clean, genetics as op, phylogeny as ph
from ..sources import tree_closure
from .registry import query
from .views import GEN, OBS, VAR, genotypes, observations, table, variants


def _per_ind(v):
    return v.groupBy("ind").agg(F.count(F.lit(1)).alias("n"), F.count("gt").alias("called"))


def _per_pos(v):
    return v.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"), F.count("gt").alias("called"))


@query("filter_individual_missing", "G-01", sql=f"WITH {VAR} SELECT ind, count(*) AS n, count(g1) AS called FROM var GROUP BY ind HAVING avg((g1 IS NULL)::INT) < 0.075", i="n called")
def filter_individual_missing(spark, sf):
    return _per_ind(op.filter_individual_missing(variants(spark, sf), 0.075))


@query("filter_locus_missing", "G-02", sql=f"WITH {VAR} SELECT chrom, pos, count(*) AS n, count(g1) AS called FROM var GROUP BY ALL HAVING avg((g1 IS NULL)::INT) <= 0.08", i="pos n called")
def filter_locus_missing(spark, sf):
    return _per_pos(op.filter_locus_missing(variants(spark, sf), 0.08))


@query("mask_low_quality", "G-03", sql=f"WITH {VAR} SELECT chrom, pos, count(*) AS n, count(CASE WHEN gq >= 30 THEN g1 END) AS called FROM var GROUP BY ALL", i="pos n called")
def mask_low_quality(spark, sf):
    return _per_pos(op.mask_low_quality(variants(spark, sf), 30))


@query("mask_depth", "G-04", sql=f"WITH {VAR} SELECT chrom, pos, count(*) AS n, count(CASE WHEN dp > 6 AND dp < (SELECT round(2 * avg(dp), 2) FROM var) THEN g1 END) AS called FROM var GROUP BY ALL", i="pos n called")
def mask_depth(spark, sf):
    return _per_pos(op.mask_depth(variants(spark, sf), 6))


@query("biallelic_snps", "G-05", sql=f"WITH {VAR} SELECT chrom, pos, count(*) AS n, count(g1) AS called FROM var WHERE n_alt = 1 AND snp GROUP BY ALL", i="pos n called")
def biallelic_snps(spark, sf):
    return _per_pos(op.biallelic_snps(variants(spark, sf)))


MAC = f"""WITH {VAR}, c AS (SELECT chrom, pos, any_value(n_alt) AS na, coalesce(sum(g1 + g2), 0) AS alt, 2 * count(g1) - coalesce(sum(g1 + g2), 0) AS ref FROM var GROUP BY ALL),
mac AS (SELECT chrom, pos, CASE WHEN na > 1 OR alt = 0 OR ref = 0 THEN 0 ELSE least(alt, ref) END AS mac FROM c)"""


@query("minor_counts", "G-06", sql=f"{MAC} SELECT * FROM mac", i="pos mac")
def minor_counts(spark, sf):
    return op.minor_counts(variants(spark, sf))


@query("filter_minor_count", "G-06", sql=f"{MAC} SELECT chrom, pos, count(*) AS n, count(g1) AS called FROM var JOIN mac USING (chrom, pos) WHERE mac >= 9 GROUP BY ALL", i="pos n called")
def filter_minor_count(spark, sf):
    return _per_pos(op.filter_minor_count(variants(spark, sf), 9))


@query("filter_heterozygosity", "G-07", sql=f"WITH {VAR} SELECT chrom, pos, count(*) AS n, count(g1) AS called FROM var GROUP BY ALL HAVING avg(CASE WHEN g1 IS NOT NULL THEN (g1 <> g2)::INT END) < 0.45", i="pos n called")
def filter_heterozygosity(spark, sf):
    return _per_pos(op.filter_heterozygosity(variants(spark, sf), 0.45))


@query("subsample_snps", "G-08", sql=f"WITH {VAR} SELECT r AS replicate, least(20, count(DISTINCT pos)) AS variants FROM var, range(1, 4) t(r) GROUP BY r", i="replicate variants")
def subsample_snps(spark, sf):
    d = op.subsample_snps(variants(spark, sf), 20, 3, seed=9)
    return d.groupBy("replicate").agg(F.count_distinct("pos").alias("variants"))


@query("variant_filter_chain", "C-25 G-01 G-03 G-05 G-06", sql=f"""{MAC.replace('WITH ', 'WITH ', 1)}, b AS (SELECT * FROM var WHERE n_alt = 1 AND snp),
q AS (SELECT chrom, pos, ind, CASE WHEN gq >= 20 THEN g1 END AS g1, CASE WHEN gq >= 20 THEN g2 END AS g2 FROM b),
m2 AS (SELECT chrom, pos, coalesce(sum(g1 + g2), 0) AS alt, 2 * count(g1) - coalesce(sum(g1 + g2), 0) AS ref FROM q GROUP BY ALL), k AS (SELECT q.* FROM q JOIN m2 USING (chrom, pos) WHERE least(alt, ref) >= 5)
SELECT 0 AS step, 'start' AS filter, count(*) AS calls, count(g1) AS called, count(DISTINCT pos) AS variants FROM var UNION ALL SELECT 1, 'biallelic', count(*), count(g1), count(DISTINCT pos) FROM b
UNION ALL SELECT 2, 'quality', count(*), count(g1), count(DISTINCT pos) FROM q UNION ALL SELECT 3, 'mac', count(*), count(g1), count(DISTINCT pos) FROM k""", i="step calls called variants")
def variant_filter_chain(spark, sf):
    f = {"biallelic": op.biallelic_snps, "quality": lambda v: op.mask_low_quality(v, 20), "mac": lambda v: op.filter_minor_count(v, 5)}
    c = {"calls": F.count(F.lit(1)), "called": F.count("gt"), "variants": F.count_distinct("pos")}
    return clean.ordered_filters(cut_lineage(variants(spark, sf)), ["biallelic", "quality", "mac"], f, c)[1]


BASE = f"""WITH {GEN}, al AS (SELECT locus, pop, allele, count(*) AS c, sum(h) AS h FROM (SELECT locus, pop, unnest([a1, a2]) AS allele, (a1 <> a2)::INT AS h FROM gen WHERE a1 IS NOT NULL) GROUP BY ALL),
lp AS (SELECT locus, pop, sum(c) / 2.0::DOUBLE AS n, sum(h) / sum(c)::DOUBLE AS ho, sum(c * c) / pow(sum(c), 2) AS sp2 FROM al GROUP BY ALL),
pp AS (SELECT *, CASE WHEN n > 1 THEN n / (n - 1) * (1 - sp2 - ho / (2 * n)) END AS hs FROM lp),
pl AS (SELECT locus, count(*)::DOUBLE AS np, avg(ho) AS ho, avg(sp2) AS m2, count(*) / sum(1 / n) AS mn FROM lp GROUP BY locus),
pm AS (SELECT locus, sum(pow(p, 2)) AS pm2 FROM (SELECT al.locus, allele, sum(c / (2 * n)) / any_value(np) AS p FROM al JOIN lp ON lp.locus = al.locus AND lp.pop = al.pop JOIN pl ON pl.locus = al.locus GROUP BY al.locus, allele) GROUP BY locus),
l1 AS (SELECT locus, ho, np, mn, pm2, mn / (mn - 1) * (1 - m2 - ho / (2 * mn)) AS hs FROM pl JOIN pm USING (locus)),
lo AS (SELECT locus, ho, hs, 1 - pm2 + hs / (mn * np) - ho / (2 * mn * np) AS ht FROM l1)"""


@query("basic_stats_by_population", "G-10", sql=f"{BASE} SELECT locus, pop, n, ho, hs, CASE WHEN hs <> 0 THEN 1 - ho / hs END AS fis FROM pp", r="n:1 ho hs fis", i="pop")
def basic_stats_by_population(spark, sf):
    return op.basic_stats(genotypes(spark, sf))[0]


@query("basic_stats_by_locus", "G-10", sql=f"{BASE} SELECT locus, ho, hs, ht, ht - hs AS dst, 1 - hs / ht AS fst, 1 - ho / hs AS fis FROM lo", r="ho hs ht dst fst fis")
def basic_stats_by_locus(spark, sf):
    return op.basic_stats(genotypes(spark, sf))[1]


@query("basic_stats_overall", "G-10", sql=f"{BASE} SELECT avg(ho) AS ho, avg(hs) AS hs, avg(ht) AS ht, avg(ht - hs) AS dst, avg(ht - hs) / avg(ht) AS fst, 1 - avg(ho) / avg(hs) AS fis FROM lo", r="ho hs ht dst fst fis")
def basic_stats_overall(spark, sf):
    return op.basic_stats(genotypes(spark, sf))[2]


@query("null_allele_outliers", "G-09", sql=f"""{BASE}, f AS (SELECT locus, 1 - ho / hs AS fis FROM lo), q AS (SELECT quantile_cont(fis, 0.4) AS a, quantile_cont(fis, 0.6) AS b FROM f)
SELECT gen.locus, count(*) AS n FROM gen JOIN f USING (locus), q WHERE fis BETWEEN a - (b - a) AND b + (b - a) GROUP BY gen.locus""", i="n")
def null_allele_outliers(spark, sf):
    return op.null_allele_outliers(genotypes(spark, sf), .4, .6, 1.0).groupBy("locus").agg(F.count(F.lit(1)).alias("n"))


RICH = f"""{BASE}, sz AS (SELECT locus, pop, sum(c) AS tt FROM al GROUP BY ALL), mn AS (SELECT locus, min(tt) AS m FROM sz GROUP BY locus),
ar AS (SELECT al.locus, al.pop, sum(1 - list_reduce(list_prepend(1.0::DOUBLE, [CASE WHEN tt - c >= m THEN (tt - c - j) / (tt - j)::DOUBLE ELSE 0 END FOR j IN range(0, CAST(m AS BIGINT))]), lambda x, y: x * y)) AS ar
  FROM al JOIN sz ON sz.locus = al.locus AND sz.pop = al.pop JOIN mn ON mn.locus = al.locus GROUP BY ALL)"""


@query("allelic_richness", "G-11", sql=f"{RICH} SELECT pop, avg(ar) AS ar FROM ar GROUP BY pop", r="ar", i="pop")
def allelic_richness(spark, sf):
    return op.allelic_richness(genotypes(spark, sf))[1]


PAIR = f"""{BASE}, pr AS (SELECT a.locus, a.pop AS pop_a, b.pop AS pop_b, a.n AS na, b.n AS nb, a.sp2 AS qa, b.sp2 AS qb FROM lp a JOIN lp b ON a.locus = b.locus AND a.pop < b.pop),
aa AS (SELECT DISTINCT locus, allele FROM al), d AS (SELECT pr.*, aa.allele, coalesce(x.c, 0) AS ca, coalesce(x.h, 0) AS xa, coalesce(y.c, 0) AS cb, coalesce(y.h, 0) AS xb FROM pr JOIN aa USING (locus)
  LEFT JOIN al x ON x.locus = pr.locus AND x.pop = pop_a AND x.allele = aa.allele LEFT JOIN al y ON y.locus = pr.locus AND y.pop = pop_b AND y.allele = aa.allele WHERE coalesce(x.c, y.c) IS NOT NULL),
w0 AS (SELECT *, na + nb AS n, (na + nb) / 2 AS nbar, ca / (2 * na) AS p1, cb / (2 * nb) AS p2 FROM d),
w1 AS (SELECT *, n - (na * na + nb * nb) / n AS nc, (na * p1 + nb * p2) / n AS pbar, (xa + xb) / n AS hbar FROM w0),
w2 AS (SELECT *, (na * pow(p1 - pbar, 2) + nb * pow(p2 - pbar, 2)) / nbar AS s2 FROM w1),
w3 AS (SELECT pop_a, pop_b, nbar / nc * (s2 - (pbar * (1 - pbar) - s2 / 2 - hbar / 4) / (nbar - 1)) AS va, nbar / (nbar - 1) * (pbar * (1 - pbar) - s2 / 2 - (2 * nbar - 1) / (4 * nbar) * hbar) AS vb, hbar / 2 AS vc FROM w2),
fst AS (SELECT pop_a, pop_b, sum(va) / sum(va + vb + vc) AS fst FROM w3 GROUP BY ALL),
g0 AS (SELECT pr.*, (SELECT sum(pow((p1 + p2) / 2, 2)) FROM w0 WHERE w0.locus = pr.locus AND w0.pop_a = pr.pop_a AND w0.pop_b = pr.pop_b) AS pm2, 2 / (1 / na + 1 / nb) AS nh FROM pr),
g1 AS (SELECT *, 2 * nh / (2 * nh - 1) * (1 - (qa + qb) / 2) AS hs2 FROM g0), g2 AS (SELECT pop_a, pop_b, avg(hs2) AS hs, avg(1 - pm2 + hs2 / (4 * nh)) AS ht FROM g1 GROUP BY ALL),
gst AS (SELECT pop_a, pop_b, 1 - hs / ht AS gst, (ht - hs) / (1 - hs) * 2 AS jost_d FROM g2)"""


@query("pairwise_fst", "G-12", sql=f"{PAIR} SELECT * FROM fst", r="fst", i="pop_a pop_b")
def pairwise_fst(spark, sf):
    return op.pairwise_fst(genotypes(spark, sf))


@query("pairwise_gst_jost", "G-13", sql=f"{PAIR} SELECT * FROM gst", r="gst jost_d", i="pop_a pop_b")
def pairwise_gst_jost(spark, sf):
    return op.pairwise_gst_jost(genotypes(spark, sf))


@query("diversity_summary", "G-14", sql=f"""{PAIR}, mp AS (SELECT pop, avg(fst) AS mean_fst, avg(gst) AS mean_gst, avg(jost_d) AS mean_jost_d FROM (SELECT *, unnest([pop_a, pop_b]) AS pop FROM fst JOIN gst USING (pop_a, pop_b)) GROUP BY pop),
ni AS (SELECT pop, count(DISTINCT ind) AS n_ind FROM gen GROUP BY pop), st AS (SELECT pop, avg(ho) AS hobs, avg(hs) AS hexp, avg(CASE WHEN hs <> 0 THEN 1 - ho / hs END) AS fis FROM pp GROUP BY pop)
SELECT CAST(pop AS VARCHAR) AS pop, n_ind, round(hobs, 5) AS hobs, round(hexp, 5) AS hexp, round(fis, 5) AS fis, round(mean_fst, 5) AS mean_fst, round(mean_gst, 5) AS mean_gst, round(mean_jost_d, 5) AS mean_jost_d
FROM ni JOIN st USING (pop) LEFT JOIN mp USING (pop)""", r="hobs hexp fis mean_fst mean_gst mean_jost_d", d=5, i="n_ind")
def diversity_summary(spark, sf):
    d = op.diversity_summary(genotypes(spark, sf).withColumn("pop", F.col("pop").cast("string")))
    return d.filter("pop NOT IN ('mean', 'All_populations_combined')").drop("ar")


@query("diversity_summary_totals", "G-14")
def diversity_summary_totals(spark, sf):
    d = op.diversity_summary(genotypes(spark, sf).withColumn("pop", F.col("pop").cast("string")))
    return d.filter("pop IN ('mean', 'All_populations_combined')")


@query("check_individuals", "G-15", sql=f"WITH {GEN} SELECT count(DISTINCT ind) AS individuals FROM gen", i="individuals")
def check_individuals(spark, sf):
    g = genotypes(spark, sf)
    op.check_individuals(g, table(spark, sf, "customer").select(F.col("c_custkey").alias("ind"), F.col("c_nationkey").alias("pop")))
    return g.agg(F.count_distinct("ind").alias("individuals"))


@query("position_counts", "G-16", sql="""WITH c AS (SELECT source, unnest(range(0, CAST(len(text) AS BIGINT))) AS pos, unnest(string_split(upper(text), '')) AS base FROM (SELECT source, replace(replace(text, 'ß', 's'), 'ﬁ', 'f') AS text FROM documents))
SELECT pos, base, count(*) AS n FROM c GROUP BY ALL""", i="pos n")
def position_counts(spark, sf):
    d = table(spark, sf, "documents").select(F.translate("text", "ßﬁ", "sf").alias("seq"))
    return op.position_counts(d)


SEQ = """sq AS (SELECT p_partkey AS name, lpad(CAST((p_partkey * 7919) % 65536 AS VARCHAR), 5, '0') || lpad(CAST(CAST(floor(p_retailprice * 10) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS d FROM part),
ch AS (SELECT unnest(range(0, 8)) AS pos, ['A', 'C', 'G', 'T', 'A', 'A', 'C', 'T', 'G', '-'][unnest([CAST(substr(d, i, 1) AS INT) FOR i IN range(1, 9)]) + 1] AS base FROM sq)"""


def _aligned(spark, sf):
    p = table(spark, sf, "part")
    d = F.concat(F.lpad(((F.col("p_partkey") * 7919) % 65536).cast("string"), 5, "0"), F.lpad((F.floor(F.col("p_retailprice") * 10) % 1000).cast("string"), 3, "0"))
    return p.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("name"), F.translate(d, "0123456789", "ACGTAACTG-").alias("seq"))


@query("consensus", "G-16", sql=f"WITH {SEQ}, c AS (SELECT pos, base, count(*) AS n FROM ch GROUP BY ALL) SELECT pos, base FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY n DESC, base) AS rn FROM c) WHERE rn = 1", i="pos")
def consensus(spark, sf):
    return op.consensus(_aligned(spark, sf))


@query("consensus_codes", "G-16", sql=f"""WITH {SEQ}, c AS (SELECT pos, array_to_string(list_sort(list(DISTINCT base) FILTER (base <> '-')), '') AS b FROM ch GROUP BY pos)
SELECT pos, CASE b WHEN 'ACGT' THEN 'N' WHEN 'ACG' THEN 'V' WHEN 'ACT' THEN 'H' WHEN 'AGT' THEN 'D' WHEN 'CGT' THEN 'B' WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' ELSE b END AS base FROM c""", i="pos")
def consensus_codes(spark, sf):
    return op.consensus(_aligned(spark, sf), method="iupac")


# ---- phylogeny: a tree of parts (tips), brands within types, types and a root -------------

def _edges(spark, sf):
    p = table(spark, sf, "part")
    tip = p.select(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("node"), F.concat_ws("/", "p_type", "p_brand").alias("parent"),
                   (F.col("p_size") / 10).alias("length"), F.col("p_partkey").alias("tip"))
    mid = p.groupBy("p_type", "p_brand").agg(F.avg("p_size").alias("s")).select(
        F.concat_ws("/", "p_type", "p_brand").alias("node"), F.col("p_type").alias("parent"), F.round(F.col("s") / 7, 3).alias("length"), F.lit(None).cast("bigint").alias("tip"))
    top = p.select("p_type").distinct().select(F.col("p_type").alias("node"), F.lit("root").alias("parent"), F.length("p_type").cast("double").alias("length"), F.lit(None).cast("bigint").alias("tip"))
    root = top.limit(1).select(F.lit("root").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0.5).alias("length"), F.lit(None).cast("bigint").alias("tip"))
    return tip.unionByName(mid).unionByName(top).unionByName(root)


CLO = """mid AS (SELECT p_type, p_brand, round(avg(p_size) / 7, 3) AS s FROM part GROUP BY ALL),
clo AS (SELECT 't' || p_partkey AS edge, p_size / 10.0::DOUBLE AS length, p_partkey AS tip FROM part UNION ALL SELECT part.p_type || '/' || part.p_brand, s, p_partkey FROM part JOIN mid ON mid.p_type = part.p_type AND mid.p_brand = part.p_brand
  UNION ALL SELECT p_type, length(p_type), p_partkey FROM part UNION ALL SELECT 'root', 0.5, p_partkey FROM part)"""
COM = f"""{OBS}, {CLO}, com AS (SELECT DISTINCT s_nationkey AS cell, part AS species FROM obs JOIN supplier ON s_suppkey = site),
ce AS (SELECT DISTINCT cell, edge, length FROM com JOIN clo ON tip = species), pd AS (SELECT cell, sum(length) AS pd FROM ce GROUP BY cell)"""


def _community(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site"), F.col("s_nationkey").alias("cell"))
    return observations(spark, sf).drop("species").join(s, "site").select("cell", F.col("part").alias("species")).distinct()


@query("tree_closure", "S-08", sql=f"WITH {CLO} SELECT edge, count(*) AS tips, any_value(length) AS length FROM clo GROUP BY edge", r="length", i="tips")
def closure(spark, sf):
    return tree_closure(_edges(spark, sf)).groupBy("edge").agg(F.count(F.lit(1)).alias("tips"), F.max("length").alias("length"))


@query("phylo_diversity", "G-17", sql=f"WITH {COM} SELECT cell, pd FROM pd", r="pd:4", i="cell")
def phylo_diversity(spark, sf):
    return ph.phylo_diversity(tree_closure(_edges(spark, sf)), _community(spark, sf))


@query("phylo_diversity_ses", "G-18")
def phylo_diversity_ses(spark, sf):
    return ph.phylo_diversity_ses(cut_lineage(tree_closure(_edges(spark, sf))), _community(spark, sf), reps=999, seed=4)


@query("phylo_beta", "G-19", sql=f"""WITH {COM}, sh AS (SELECT a.cell AS cell_a, b.cell AS cell_b, sum(a.length) AS s FROM ce a JOIN ce b ON a.edge = b.edge AND a.cell < b.cell GROUP BY ALL)
SELECT cell_a, cell_b, 1 - 2 * s / (x.pd + y.pd) AS dissimilarity FROM sh JOIN pd x ON x.cell = cell_a JOIN pd y ON y.cell = cell_b""", r="dissimilarity", i="cell_a cell_b")
def phylo_beta(spark, sf):
    return ph.phylo_beta(cut_lineage(tree_closure(_edges(spark, sf))), cut_lineage(_community(spark, sf)))
