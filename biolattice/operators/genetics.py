"""Variant filters and population-genetic statistics (G-01 .. G-16)."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalars import ln_choose_ratio
from ..functions.scale import cut_lineage, exact_quantiles, first_per_key

SITE = ["chrom", "pos"]


# ---------------------------------------------------------------- variant filters

def filter_individual_missing(v: DataFrame, max_missing: float, ind: str = "ind", call: str = "gt") -> DataFrame:
    """G-01: keep individuals whose share of missing calls is below the limit."""
    ok = v.groupBy(ind).agg(F.avg(F.col(call).isNull().cast("double")).alias("_m")).filter(F.col("_m") < max_missing)
    return v.join(ok.select(ind), ind, "left_semi")


def filter_locus_missing(v: DataFrame, max_missing: float, locus: Sequence[str] = SITE, call: str = "gt") -> DataFrame:
    """G-02: drop loci whose share of missing calls is above the limit."""
    ok = v.groupBy(*locus).agg(F.avg(F.col(call).isNull().cast("double")).alias("_m")).filter(F.col("_m") <= max_missing)
    return v.join(ok.select(*locus), list(locus), "left_semi")


def mask_low_quality(v: DataFrame, min_gq: float) -> DataFrame:
    """G-03: calls below the quality become missing; calls without a quality stay."""
    return v.withColumn("gt", F.when(~F.coalesce(F.col("gq") < min_gq, F.lit(False)), F.col("gt")))


def mask_depth(v: DataFrame, min_dp: float) -> DataFrame:
    """G-04: missing when depth <= min or >= twice the mean depth (two decimals)."""
    top = v.agg(F.round(2 * F.avg("dp"), 2)).scalar()
    bad = F.coalesce((F.col("dp") <= min_dp) | (F.col("dp") >= top), F.lit(False))
    return v.withColumn("gt", F.when(~bad, F.col("gt")))


def biallelic_snps(v: DataFrame) -> DataFrame:
    """G-05: exactly two alleles, each one base."""
    return v.filter((F.size("alt") == 1) & (F.length("ref") == 1) & (F.length(F.col("alt")[0]) == 1)
                    & F.upper(F.col("alt")[0]).rlike("^[ACGTN]$"))


def minor_counts(v: DataFrame, locus: Sequence[str] = SITE) -> DataFrame:
    """Minor allele count per locus: the smallest count over all its alleles (absent ones are 0)."""
    n_all = F.size(F.col("alt")) + 1
    per = (v.select(*locus, n_all.alias("_a"), F.explode_outer("gt").alias("allele"))
            .groupBy(*locus, "allele").agg(F.count("allele").alias("_n"), F.max("_a").alias("_a")))
    seen = F.count(F.when(F.col("_n") > 0, 1))
    return per.groupBy(*locus).agg(
        F.when(seen < F.max("_a"), 0).otherwise(F.min(F.when(F.col("_n") > 0, F.col("_n")))).cast("long").alias("mac"))


def filter_minor_count(v: DataFrame, mac: int, locus: Sequence[str] = SITE) -> DataFrame:
    """G-06: drop variants whose minor allele count is below mac."""
    return v.join(minor_counts(v, locus).filter(F.col("mac") >= mac).select(*locus), list(locus), "left_semi")


def filter_heterozygosity(v: DataFrame, max_ho: float, locus: Sequence[str] = SITE) -> DataFrame:
    """G-07: keep variants whose share of 0/1 calls among the called is below the limit."""
    a, b = F.col("gt")[0], F.col("gt")[1]
    het = ((a == 0) & (b == 1)) | ((a == 1) & (b == 0))
    ok = (v.filter(F.col("gt").isNotNull()).groupBy(*locus).agg(F.avg(het.cast("double")).alias("_h"))
           .filter(F.col("_h") < max_ho))
    return v.join(ok.select(*locus), list(locus), "left_semi")


def subsample_snps(v: DataFrame, n: int, replicates: int, min_n: int = 0, polymorphic: bool = False, seed: int = 1,
                   locus: Sequence[str] = SITE) -> DataFrame:
    """G-08: n random variants per replicate, or the whole set (replicate 0) when it is small.

    Variants are ranked by a keyed hash: first within hash slices, then among the at most n best
    of each slice, so no task ranks all variants.
    """
    if polymorphic:
        v = filter_minor_count(v, 2, locus)
    ids = v.select(*locus).distinct()
    if ids.count() <= min_n:
        return v.withColumn("replicate", F.lit(0))
    d = ids.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    d = d.withColumn("_h", F.xxhash64(F.lit(seed), "replicate", *locus))
    d = d.withColumn("_s", F.pmod(F.xxhash64("_h"), F.lit(256)))
    w1, w2 = (W.partitionBy(*k).orderBy("_h", *locus) for k in (["replicate", "_s"], ["replicate"]))
    d = d.withColumn("_k", F.row_number().over(w1)).filter(F.col("_k") <= n)
    d = d.withColumn("_k", F.row_number().over(w2)).filter(F.col("_k") <= n)
    return v.join(d.select(*locus, "replicate"), list(locus))


def check_individuals(v: DataFrame, ind_pop: DataFrame, ind: str = "ind") -> None:
    """G-15: error when individuals have no population."""
    lost = v.select(ind).distinct().join(ind_pop.select(ind), ind, "left_anti")
    n = lost.count()
    if n:
        some = [r[0] for r in lost.limit(5).collect()]
        raise ValueError(f"{n} individual(s) have no population, such as {some}")


# ---------------------------------------------------------------- diversity

def _alleles(g: DataFrame) -> DataFrame:
    """Copies of each allele and heterozygotes carrying it, per locus and population."""
    het = (F.col("a1") != F.col("a2")).cast("long")
    one = g.filter(F.col("a1").isNotNull()).select(
        "locus", "pop", F.explode(F.array("a1", "a2")).alias("allele"), het.alias("het"))
    return one.groupBy("locus", "pop", "allele").agg(F.count(F.lit(1)).alias("n"), F.sum("het").alias("het"))


def allele_table(g: DataFrame) -> DataFrame:
    """The counts every statistic below starts from, stored once: genotypes are read a single time,
    and what follows works on one row per locus, population and allele."""
    return cut_lineage(_alleles(g))


def _locus_pop(al: DataFrame) -> DataFrame:
    """Per locus and population: genotypes called, observed heterozygosity, sum of p squared."""
    size = al.groupBy("locus", "pop").agg(F.sum("n").alias("_2n"), F.sum("het").alias("_h"),
                                          F.sum(F.col("n") * F.col("n")).alias("_q"))
    return size.select("locus", "pop", (F.col("_2n") / 2).alias("n"), (F.col("_h") / F.col("_2n")).alias("ho"),
                       (F.col("_q") / (F.col("_2n") * F.col("_2n"))).alias("sp2"))


def basic_stats(g: DataFrame | None, al: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G-10: (per locus and population: n, ho, hs, fis), (per locus: ho, hs, ht, dst, fst, fis),
    (overall means). Nei's estimators with harmonic-mean sample sizes."""
    al = al if al is not None else allele_table(g)
    lp = _locus_pop(al)
    hs = F.col("n") / (F.col("n") - 1) * (1 - F.col("sp2") - F.col("ho") / (2 * F.col("n")))
    per_pop = lp.withColumn("hs", F.when(F.col("n") > 1, hs)).withColumn("fis", 1 - F.try_divide(F.col("ho"), F.col("hs")))
    per = lp.groupBy("locus").agg(F.count(F.lit(1)).cast("double").alias("np"), F.avg("ho").alias("ho"), F.avg("sp2").alias("_m2"),
                                  (F.count(F.lit(1)) / F.sum(1 / F.col("n"))).alias("mn"))
    freq = (al.withColumnRenamed("n", "c").join(lp.select("locus", "pop", "n"), ["locus", "pop"])
              .groupBy("locus", "allele").agg(F.sum(F.col("c") / (2 * F.col("n"))).alias("_p")))
    mean2 = (freq.join(per.select("locus", "np"), "locus").groupBy("locus")
                 .agg(F.sum(F.pow(F.col("_p") / F.col("np"), 2)).alias("_pm2")))
    d = per.join(mean2, "locus")
    mn, np_, ho = F.col("mn"), F.col("np"), F.col("ho")
    hs_l = F.when(mn > 1, mn / (mn - 1) * (1 - F.col("_m2") - ho / (2 * mn)))
    d = d.withColumn("hs", hs_l)
    d = d.withColumn("ht", 1 - F.col("_pm2") + F.col("hs") / (mn * np_) - ho / (2 * mn * np_))
    loci = d.select("locus", "ho", "hs", "ht", (F.col("ht") - F.col("hs")).alias("dst"),
                    (1 - F.try_divide(F.col("hs"), F.col("ht"))).alias("fst"),
                    (1 - F.try_divide(ho, F.col("hs"))).alias("fis"))
    over = loci.agg(*[F.avg(c).alias(c) for c in ("ho", "hs", "ht", "dst")])
    over = over.withColumn("fst", F.try_divide(F.col("dst"), F.col("ht"))).withColumn("fis", 1 - F.try_divide(F.col("ho"), F.col("hs")))
    return per_pop.select("locus", "pop", "n", "ho", "hs", "fis"), loci, over


def null_allele_outliers(g: DataFrame, low: float = .25, high: float = .75, k: float = 1.5) -> DataFrame:
    """G-09: drop loci whose Fis is outside the quartiles -+ k times their distance."""
    loci = cut_lineage(basic_stats(g)[1].select("locus", "fis"))
    q = exact_quantiles(loci, [], "fis", {"a": low, "b": high})
    a, b = q.select("a").scalar(), q.select("b").scalar()
    bad = loci.filter((F.col("fis") < a - k * (b - a)) | (F.col("fis") > b + k * (b - a))).select("locus")
    return g.join(bad, "locus", "left_anti")


def allelic_richness(g: DataFrame | None, al: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """G-11: (per locus and population, mean per population) alleles expected in the smallest sample
    of the locus. Alleles of equal count are one row."""
    al = al if al is not None else allele_table(g)
    size = al.groupBy("locus", "pop").agg(F.sum("n").alias("_tot"))
    least = size.groupBy("locus").agg(F.min("_tot").alias("_min"))
    same = (al.groupBy("locus", "pop", "n").agg(F.count(F.lit(1)).alias("_times"))
              .join(size, ["locus", "pop"]).join(least, "locus"))
    e = 1 - F.coalesce(F.exp(ln_choose_ratio("_tot", "n", "_min")), F.lit(0.0))
    per = same.groupBy("locus", "pop").agg(F.sum(e * F.col("_times")).alias("ar"))
    return per, per.groupBy("pop").agg(F.avg("ar").alias("ar"))


def _pair_base(al: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Allele counts of both populations of every pair, an absent allele being 0.

    Populations per locus are few (they are survey groups); the pairs of populations are the
    answer's own rows. Pairs meet on the locus, alleles on (locus, allele).
    """
    lp = _locus_pop(al)
    a = lp.select("locus", F.col("pop").alias("pop_a"), F.col("n").alias("na"), F.col("ho").alias("ha"), F.col("sp2").alias("qa"))
    b = lp.select("locus", F.col("pop").alias("pop_b"), F.col("n").alias("nb"), F.col("ho").alias("hb"), F.col("sp2").alias("qb"))
    pairs = a.join(b, "locus").filter(F.col("pop_a") < F.col("pop_b"))
    pa = al.select("locus", F.col("pop").alias("pop_a"), "allele", F.col("n").alias("ca"), F.col("het").alias("xa"))
    pb = al.select("locus", F.col("pop").alias("pop_b"), "allele", F.col("n").alias("cb"), F.col("het").alias("xb"))
    left = pairs.join(pa, ["locus", "pop_a"]).select(*pairs.columns, "allele")
    right = pairs.join(pb, ["locus", "pop_b"]).select(*pairs.columns, "allele")
    both = left.unionByName(right).distinct()
    both = (both.join(pa, ["locus", "pop_a", "allele"], "left").join(pb, ["locus", "pop_b", "allele"], "left")
                .fillna(0, ["ca", "xa", "cb", "xb"]))
    return pairs, both


def pairwise_fst(g: DataFrame | None, al: DataFrame | None = None) -> DataFrame:
    """G-12: Weir-Cockerham theta per pair of populations, variance components added over loci."""
    _, d = _pair_base(al if al is not None else allele_table(g))
    na, nb = F.col("na"), F.col("nb")
    n = na + nb
    nbar = n / 2
    nc = n - (na * na + nb * nb) / n
    p1, p2 = F.col("ca") / (2 * na), F.col("cb") / (2 * nb)
    pbar = (na * p1 + nb * p2) / n
    s2 = (na * F.pow(p1 - pbar, 2) + nb * F.pow(p2 - pbar, 2)) / nbar
    hbar = (F.col("xa") + F.col("xb")) / n
    inner = pbar * (1 - pbar) - s2 / 2
    va = nbar / nc * (s2 - (inner - hbar / 4) / (nbar - 1))
    vb = nbar / (nbar - 1) * (inner - (2 * nbar - 1) / (4 * nbar) * hbar)
    vc = hbar / 2
    return (d.filter(nbar > 1).groupBy("pop_a", "pop_b")
             .agg(F.try_divide(F.sum(va), F.sum(va + vb + vc)).alias("fst")))


def pairwise_gst_jost(g: DataFrame | None, al: DataFrame | None = None) -> DataFrame:
    """G-13: Nei's Gst and Jost's D per pair, with Nei's small-sample heterozygosities averaged
    over loci."""
    pairs, d = _pair_base(al if al is not None else allele_table(g))
    p1, p2 = F.col("ca") / (2 * F.col("na")), F.col("cb") / (2 * F.col("nb"))
    mean2 = d.groupBy("locus", "pop_a", "pop_b").agg(F.sum(F.pow((p1 + p2) / 2, 2)).alias("_pm2"))
    x = pairs.join(mean2, ["locus", "pop_a", "pop_b"])
    nh = 2 / (1 / F.col("na") + 1 / F.col("nb"))
    hs = F.try_divide(2 * nh, 2 * nh - 1) * (1 - (F.col("qa") + F.col("qb")) / 2)
    x = x.withColumn("_hs", hs).withColumn("_ht", 1 - F.col("_pm2") + F.col("_hs") / (2 * nh * 2))
    m = x.groupBy("pop_a", "pop_b").agg(F.avg("_hs").alias("_hs"), F.avg("_ht").alias("_ht"))
    return m.select("pop_a", "pop_b", (1 - F.try_divide(F.col("_hs"), F.col("_ht"))).alias("gst"),
                    (F.try_divide(F.col("_ht") - F.col("_hs"), 1 - F.col("_hs")) * 2).alias("jost_d"))


def diversity_summary(g: DataFrame, combined: str = "All_populations_combined", digits: int = 5) -> DataFrame:
    """G-14: one row per population, one for all individuals together, one of means."""
    def stats(x: DataFrame, al: DataFrame) -> DataFrame:
        n = x.select("pop", "ind").distinct().groupBy("pop").agg(F.count(F.lit(1)).alias("n_ind"))
        per, _, _ = basic_stats(None, al)
        # one population alone: Ht equals Hs with its own sample size
        h = per.groupBy("pop").agg(F.avg("ho").alias("hobs"), F.avg("hs").alias("hexp"), F.avg("fis").alias("fis"))
        return n.join(h, "pop", "left").join(allelic_richness(None, al)[1], "pop", "left")

    al = allele_table(g)
    pairs = cut_lineage(pairwise_fst(None, al).join(pairwise_gst_jost(None, al), ["pop_a", "pop_b"]))
    both = (pairs.select(F.col("pop_a").alias("pop"), "fst", "gst", "jost_d")
                 .unionByName(pairs.select(F.col("pop_b").alias("pop"), "fst", "gst", "jost_d")))
    mean_pair = both.groupBy("pop").agg(*[F.avg(c).alias(f"mean_{c}") for c in ("fst", "gst", "jost_d")])
    cols = ["hobs", "hexp", "ar", "fis", "mean_fst", "mean_gst", "mean_jost_d"]
    pop = stats(g, al).join(mean_pair, "pop", "left").select("pop", "n_ind", *cols)
    pop = cut_lineage(pop)
    both_al = al.groupBy("locus", F.lit(combined).alias("pop"), "allele").agg(F.sum("n").alias("n"), F.sum("het").alias("het"))
    one = stats(g.withColumn("pop", F.lit(combined)), both_al)
    one = one.select("pop", "n_ind", "hobs", "hexp", "ar", "fis", *[F.lit(None).cast("double").alias(c) for c in cols[4:]])
    mean = pop.agg(F.lit("mean").alias("pop"), F.sum("n_ind").alias("n_ind"), *[F.avg(c).alias(c) for c in cols])
    out = reduce(DataFrame.unionByName, [pop, one, mean])
    return out.select("pop", "n_ind", *[F.round(c, digits).alias(c) for c in cols])


# ---------------------------------------------------------------- consensus

# Ambiguity codes by their sorted bases.
AMBIGUITY = {"A": "A", "C": "C", "G": "G", "T": "T", "AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K",
             "ACG": "V", "ACT": "H", "AGT": "D", "CGT": "B", "ACGT": "N"}


def position_counts(df: DataFrame, seq: str = "seq", by: Sequence[str] = ()) -> DataFrame:
    """Characters counted per alignment position, combined on the map side."""
    return (df.select(*by, F.posexplode(F.split(F.upper(seq), "")).alias("pos", "base")).filter(F.col("base") != "")
              .groupBy(*by, "pos", "base").agg(F.count(F.lit(1)).alias("n")))


def consensus(df: DataFrame, method: str = "string", gaps: bool = True, name: str = "name", seq: str = "seq") -> DataFrame:
    """G-16: pos, base of the consensus of an alignment.

    `string`: the most frequent character of a position (alphabetical on ties). `iupac`: the code
    for all bases found there. With gaps=False gaps do not take part. Fewer than two sequences or
    unequal lengths are an error.
    """
    got = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.length(seq)).alias("a"), F.max(F.length(seq)).alias("z")).first()
    if got.n < 2:
        raise ValueError("a consensus needs at least two sequences")
    if got.a != got.z:
        raise ValueError("the sequences have different lengths; align them first")
    c = position_counts(df, seq)
    if not gaps:
        c = c.filter(F.col("base") != "-")
    if method == "string":
        best = first_per_key(c, ["pos"], [-F.col("n"), F.col("base")])
        return best.select("pos", "base")
    table = F.create_map(*[F.lit(x) for kv in AMBIGUITY.items() for x in kv])
    bases = F.array_join(F.array_sort(F.collect_set(F.when(F.col("base") != "-", F.col("base")))), "")
    return (c.groupBy("pos").agg(bases.alias("_b"), F.max((F.col("base") == "-").cast("int")).alias("_g"))
             .select("pos", F.when(F.col("_b") == "", "-").otherwise(
                 F.coalesce(F.try_element_at(table, F.col("_b")), F.lit("N"))).alias("base")))


def consensus_sequence(df: DataFrame, method: str = "string", gaps: bool = True, name: str = "name",
                       seq: str = "seq") -> DataFrame:
    """G-16: the consensus as one record, named after the common start of the sequence names."""
    c = consensus(df, method, gaps, name, seq)
    s = c.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("seq"))
    ends = df.agg(F.min(name).alias("a"), F.max(name).alias("z")).first()
    k = 0
    while k < min(len(ends.a), len(ends.z)) and ends.a[k] == ends.z[k]:
        k += 1
    return s.select(F.lit("consensus_" + ends.a[:k]).alias("name"), "seq")
