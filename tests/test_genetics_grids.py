"""Genetics, phylogeny, grids, pixels and streams."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from biolattice import sources as so, streaming as st
from biolattice.functions import scale
from biolattice.operators import genetics, grids, permutation, phylogeny, pixels


@pytest.fixture(scope="module")
def variants(spark):
    rows = [("c", 1, ["G"], "i1", [0, 1], 50.0, 10.0), ("c", 1, ["G"], "i2", [1, 1], 5.0, 2.0), ("c", 1, ["G"], "i3", None, None, None),
            ("c", 2, ["G", "T"], "i1", [0, 2], 50.0, 10.0), ("c", 2, ["G", "T"], "i2", [0, 0], 50.0, 50.0), ("c", 2, ["G", "T"], "i3", [0, 0], 50.0, 10.0),
            ("c", 3, ["GA"], "i1", [0, 1], 50.0, 10.0), ("c", 3, ["GA"], "i2", [0, 1], 50.0, 10.0), ("c", 3, ["GA"], "i3", [0, 1], 50.0, 10.0)]
    return spark.createDataFrame([(*r[:2], ".", "A", *r[2:]) for r in rows], "chrom string, pos long, id string, ref string, alt array<string>, ind string, gt array<int>, gq double, dp double")


def pos(d):
    return sorted(r.pos for r in d.select("pos").distinct().collect())


def test_variant_filters(variants):
    assert {r.ind for r in genetics.filter_individual_missing(variants, 1 / 3).select("ind").distinct().collect()} == {"i1", "i2"}
    assert pos(genetics.filter_locus_missing(variants, .2)) == [2, 3] and pos(genetics.filter_locus_missing(variants, 1 / 3)) == [1, 2, 3]
    assert genetics.mask_low_quality(variants, 20).filter("gt IS NULL").count() == 2
    assert genetics.mask_depth(variants, 2).filter("gt IS NULL").count() == 3  # one low, one twice the mean, one missing before
    assert pos(genetics.biallelic_snps(variants)) == [1]
    assert {r.pos: r.mac for r in genetics.minor_counts(variants).collect()} == {1: 1, 2: 0, 3: 3}
    assert pos(genetics.filter_minor_count(variants, 2)) == [3] and pos(genetics.filter_heterozygosity(variants, .6)) == [1, 2]


def test_subsample_repeats_and_small_sets(variants):
    a, b = (genetics.subsample_snps(variants, 2, 3, seed=1).select("replicate", "pos").distinct() for _ in range(2))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 6
    assert genetics.subsample_snps(variants, 2, 3, min_n=5).select("replicate").distinct().count() == 1


def test_check_individuals(spark, variants):
    with pytest.raises(ValueError, match="i3"):
        genetics.check_individuals(variants, spark.createDataFrame([("i1", "p"), ("i2", "p")], "ind string, pop string"))


def test_fst_of_fixed_and_equal_populations(spark):
    rows = [(f"a{i}", "A", "L", 1, 1) for i in range(6)] + [(f"b{i}", "B", "L", 2, 2) for i in range(6)]
    rows += [(f"{p}{i}", p, "M", 1 + i % 2, 1 + (i + 1) % 2) for p in "CD" for i in range(6)] + [(f"{p}{i}", p, "L", 1, 2) for p in "CD" for i in range(6)]
    g = spark.createDataFrame(rows, "ind string, pop string, locus string, a1 int, a2 int")
    f = {(r.pop_a, r.pop_b): r.fst for r in genetics.pairwise_fst(g).collect()}
    assert f[("A", "B")] == pytest.approx(1.0) and f[("C", "D")] < 0.01
    j = {(r.pop_a, r.pop_b): r for r in genetics.pairwise_gst_jost(g).collect()}
    assert j[("A", "B")].jost_d == pytest.approx(1.0) and j[("A", "B")].gst == pytest.approx(1.0)
    s = {r["pop"]: r for r in genetics.diversity_summary(g).collect()}
    assert s["A"].hobs == 0 and s["C"].hobs == 1 and s["mean"].n_ind == 24 and s["All_populations_combined"].mean_fst is None


def test_consensus(spark):
    d = spark.createDataFrame([("ab_1", "ACG-"), ("ab_2", "ATG-"), ("ab_3", "ATCA")], "name string, seq string")
    assert genetics.consensus_sequence(d).first().asDict() == {"name": "consensus_ab_", "seq": "ATG-"}
    assert genetics.consensus_sequence(d, gaps=False).first().seq == "ATGA"
    assert genetics.consensus_sequence(d, "iupac").first().seq == "AYSA"
    with pytest.raises(ValueError):
        genetics.consensus(d.limit(1))
    with pytest.raises(ValueError):
        genetics.consensus(d.unionByName(spark.createDataFrame([("x", "A")], "name string, seq string")))


def test_phylogeny(spark):
    c = so.tree_closure(so.tree_edges(spark, "((A:1,B:2):0.5,(C:1,D:1):3):0;"))
    com = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C"), (3, "A"), (3, "C")], "cell int, species string")
    assert {r.cell: r.pd for r in phylogeny.phylo_diversity(c, com).collect()} == {1: 3.5, 2: 4.0, 3: 5.5}
    b = {(r.cell_a, r.cell_b): r.dissimilarity for r in phylogeny.phylo_beta(c, com).collect()}
    assert b[(1, 3)] == pytest.approx(1 - 2 * 1.5 / 9) and b[(1, 2)] == 1
    for model in ("tipshuffle", "rowwise", "colwise"):
        s = phylogeny.phylo_diversity_ses(c, com, model, reps=19, slice_size=19).toPandas()
        assert len(s) == 3 and s.p_value.between(0, 1).all() and s.pd_rank.between(1, 20).all()


@pytest.mark.parametrize("model", ["tipshuffle", "rowwise", "colwise"])
def test_large_trees_are_held_in_parts(spark, model, monkeypatch):
    """A closure above the bound is read in parts, none of them whole, and gives what the whole tree gives without a row for each presence and replicate."""
    tip = spark.range(0, 300).select(F.col("id").cast("string").alias("tip"), F.explode(F.array(
        F.concat(F.lit("t"), "id"), F.concat(F.lit("g"), F.col("id") % 40), F.concat(F.lit("f"), F.col("id") % 7), F.lit("root"))).alias("edge"))
    c = tip.withColumn("length", (F.length("edge") + F.ascii(F.reverse("edge"))) / 10).select("edge", "length", "tip").cache()
    com = spark.range(0, 900).select((F.col("id") % 9).alias("cell"), (F.col("id") * 7 % 300 - F.col("id") % 9).cast("string").alias("species"))
    whole = phylogeny.phylo_diversity_ses(c, com, model, reps=40, seed=3).toPandas().set_index("cell").sort_index()
    sizes, init = [], phylogeny.Tree.__init__
    monkeypatch.setattr(phylogeny.Tree, "__init__", lambda self, tip, *rest: (sizes.append(len(tip)), init(self, tip, *rest))[1])
    parts = phylogeny.phylo_diversity_ses(c, com, model, reps=40, seed=3, held_edges=200, slice_size=40).toPandas().set_index("cell").sort_index()
    assert sum(sizes) == 1200 and max(sizes) < 900 and len(sizes) > 2
    assert list(whole.index) == list(parts.index) == list(range(9))
    for col in ("pd_obs", "pd_rand_mean", "pd_rand_sd", "pd_rank", "p_value"):
        assert whole[col].tolist() == pytest.approx(parts[col].tolist()), col


def test_permutation_of_many_by_one_key():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 1000, 123456):
        for key in (0, 12345, 2**64 - 1):
            i = rng.integers(0, n, min(n, 5000)).astype(np.uint64)
            assert np.array_equal(scale.permute_by(i, n, key), scale.permute(i, np.full(len(i), n, np.uint64), np.full(len(i), key, np.uint64)))


def _by_hand(spark, closure, cells, tips, reps, seed):
    """Diversities (replicate, cell) and the observed ones of cells (sets of tip numbers), edge by edge."""
    keys = [r[0] & (1 << 64) - 1 for r in spark.range(reps).select(F.xxhash64(F.col("id").cast("int"), F.lit(seed))).collect()]
    under, length = {}, {}
    for edge, x, tip in closure:
        under.setdefault(edge, set()).add(tip)
        length[edge] = x or 0.0
    pd_of = lambda met: sum(x for e, x in length.items() if under[e] & met)
    moved = [scale.permute_by(np.arange(tips, dtype=np.uint64), tips, k).astype(int) for k in keys]
    return np.array([[pd_of({int(to[i]) for i in c}) for c in cells] for to in moved]), np.array([pd_of(c) for c in cells])


@pytest.mark.parametrize("held", [1 << 21, 100, 40])
def test_cells_of_many_tips_share_a_look_at_each_tip(spark, monkeypatch, held):
    """Many cells in one pass over the tips of a replicate, whatever edges share tips; only cells of few tips go one by one."""
    tips, few = 100, []
    rng = np.random.default_rng(2)
    rows = [(f"own{i}", i / 10, i) for i in range(tips)] + [(f"of{k}", None if k == 3 else k + .5, int(i)) for k in range(8) for i in rng.choice(tips, 2 + 7 * k, False)] + [("root", .5, i) for i in range(tips)]
    c = spark.createDataFrame(rows, "edge string, length double, tip long").cache()
    sp = {r.tip: r.k for r in scale.dense_index(c.select("tip").distinct(), "tip", "k").collect()}
    sets = {k: [*range(k, tips, 2 + k % 5)] for k in range(66)} | {66: [1], 67: [*range(tips)]}
    com = spark.createDataFrame([(k, i) for k, v in sets.items() for i in v] + [(None, 1), (1, 999)], "cell int, species long")
    old = phylogeny._dealt_tips
    monkeypatch.setattr(phylogeny, "_dealt_tips", lambda trees, coded, *rest: (few.extend(r[0] for r in coded.groupBy("_c").count().select("count").collect()), old(trees, coded, *rest))[1])
    got = {r.cell: r for r in phylogeny.phylo_diversity_ses(c, com, reps=30, seed=6, held_edges=held).collect()}
    assert few == [1] and len(got) == 68
    x, seen = _by_hand(spark, [(e, v, sp[t]) for e, v, t in rows], [{sp[i] for i in v} for v in sets.values()], tips, 30, 6)
    for k, (of, here) in enumerate(zip(x.T, seen)):
        tie = abs(of - here) < 1e-9 * here
        assert got[k].pd_obs == pytest.approx(here) and got[k].pd_rand_mean == pytest.approx(of.mean()) and got[k].pd_rand_sd == pytest.approx(of.std(ddof=1), abs=1e-6)
        assert got[k].pd_rank == 1 + ((of < here) & ~tie).sum() + tie.sum() / 2


def test_an_edge_of_two_lengths(spark):
    """What is observed counts both lengths, as `phylo_diversity` does; replicates take the larger one."""
    c = spark.createDataFrame([(e, v, t) for t in range(6) for e, v in ((f"t{t}", 1.0), ("root", 2.0), ("root", 5.0))], "edge string, length double, tip int")
    com = spark.createDataFrame([(1, t) for t in range(4)] + [(2, t) for t in range(6)], "cell int, species int")
    got = {r.cell: (r.pd_obs, r.pd_rand_mean, r.pd_rank) for r in phylogeny.phylo_diversity_ses(c, com, reps=9).collect()}
    assert got == {1: (11.0, 9.0, 10.0), 2: (13.0, 11.0, 10.0)}
    assert {r.cell: r.pd for r in phylogeny.phylo_diversity(c, com).collect()} == {1: 11.0, 2: 13.0}


def test_undone_permutation():
    for n in (1, 2, 7, 1000, 123456):
        for key in (0, 12345, 2**64 - 1):
            to = scale.permute_by(np.arange(n, dtype=np.uint64), n, key)
            assert np.array_equal(scale.unpermute_by(to, n, key), np.arange(n))


def test_replicates_of_phylogenetic_diversity(spark):
    """Arrays of replicates give what joined rows give, and what the moved presences add up to by hand."""
    names = "ABCDEFGH"
    c = so.tree_closure(so.tree_edges(spark, "(((A:1,B:2):0.5,(C:1,D:1.5):3):1,((E:0.7,F:2.2):0.4,(G:1,H:4):0.1):2):0;")).cache()
    rows = [(k, names[(k * j + j) % 8]) for k in range(1, 7) for j in range(1, k + 1)]
    com = spark.createDataFrame([*rows, *rows, (1, "gone"), (None, "A")], "cell int, species string")
    for model in ("tipshuffle", "rowwise"):
        held, joined = (phylogeny.phylo_diversity_ses(c, com, model, reps=200, seed=3, slice_size=200, held_edges=h).toPandas().set_index("cell").sort_index() for h in (1 << 21, 0))
        assert list(held.index) == [1, 2, 3, 4, 5, 6]
        for col in ("pd_obs", "pd_rand_mean", "pd_rand_sd", "pd_rank", "p_value"):
            assert held[col].tolist() == pytest.approx(joined[col].tolist()), (model, col)

    # tip names dealt to a single species: the mean over many replicates is that over all tips
    one = phylogeny.phylo_diversity_ses(c, spark.createDataFrame([(1, "A")], "cell int, species string"), reps=4000, seed=5).first()
    path = c.groupBy("tip").agg(F.sum("length").alias("s")).agg(F.avg("s")).first()[0]
    assert one.pd_obs == 2.5 and one.reps == 4000 and one.pd_rand_mean == pytest.approx(path, rel=0.02)

    # colwise: presences of a replicate collected and counted by hand
    above = {}
    for r in c.collect():
        above.setdefault(r.tip, {})[r.edge] = r.length
    sp = {r.tip: r.k for r in scale.dense_index(c.select("tip").distinct(), "tip", "k").collect()}
    good = com.filter("cell IS NOT NULL AND species <> 'gone'").distinct()
    ce = {r.cell: r.k for r in scale.dense_index(good, "cell", "k").collect()}
    raw = spark.createDataFrame([(ce[r.cell], sp[r.species], 1.0) for r in good.collect()], "_i long, _j long, _n double")
    name, cells, found = {v: k for k, v in sp.items()}, {v: k for k, v in ce.items()}, {}
    for r in permutation.moved_counts(raw, len(ce), 1, 0, 60, 3).collect():
        for i, j in zip(np.frombuffer(r.place, "<i8"), np.frombuffer(r.kind, "<i4")):
            found.setdefault((cells[i], r.rep), set()).update(above[name[j]].items())
    got = phylogeny.phylo_diversity_ses(c, com, "colwise", reps=60, seed=3).collect()
    assert len(got) == 6
    for r in got:
        x = np.array([sum(v for _, v in found.get((r.cell, rep), ())) for rep in range(60)])
        assert r.pd_rand_mean == pytest.approx(x.mean()) and r.pd_rand_sd == pytest.approx(x.std(ddof=1))
        tie = abs(x - r.pd_obs) < 1e-9
        assert r.pd_rank == 1 + ((x < r.pd_obs) & ~tie).sum() + tie.sum() / 2
    assert phylogeny.phylo_diversity_ses(c, com.limit(0), reps=5).count() == 0
    with pytest.raises(ValueError):
        phylogeny.phylo_diversity_ses(c, com, "other")


def test_grid_selection(spark):
    rows = [(f"2000-0{m}-01", la, lo, None if (la, lo) == (1.0, 1.0) else la * 10 + lo + m) for m in (1, 2, 3) for la in (0.0, 1.0, 2.0) for lo in (0.0, 1.0)]
    g = spark.createDataFrame(rows, "time string, lat double, lon double, v double").withColumn("time", F.to_timestamp("time"))
    assert grids.grid_filter(g, "v#bi#5#15", "v").filter("v IS NOT NULL").count() == 3
    assert grids.grid_filter(g, "lat#e#1.5", "v").select("lat").distinct().first().lat == 2.0  # the larger one on a tie
    assert grids.nearest_cell(g, 1.05, 0.8, "v", with_value=True).select("lat", "lon").distinct().first() == (1.0, 0.0)
    assert grids.nearest_cell(g, 5.0, 0.0, "v", tolerance=1.0).count() == 0
    p = spark.createDataFrame([("x", 0.2, 0.9), ("y", 1.1, 0.9)], "place string, lat double, lon double")
    got = {r.place: (r.lat, r.lon) for r in grids.select_at_points(g, p, "v").select("place", "lat", "lon").distinct().collect()}
    assert got == {"x": (0.0, 1.0), "y": (1.0, 1.0)}
    assert {r.place: (r.lat, r.lon) for r in grids.select_at_points(g, p, "v", with_value=True).select("place", "lat", "lon").distinct().collect()}["y"] in ((1.0, 0.0), (2.0, 1.0), (0.0, 1.0))
    assert grids.index_select(g, "time", 1, 2).select("time").distinct().count() == 1
    assert grids.where(g, "v > 10 and lon = 1", ["v"]).filter("v IS NOT NULL").count() == 3
    for bad in ("drop(v) > 1", "v > 1; select 1", "other > 2"):
        with pytest.raises(ValueError):
            grids.where(g, bad, ["v"])


def test_band_formulas(spark):
    d = spark.createDataFrame([(5.0, 5.0, 2.0)], "B4 double, B8 double, B2 double")
    r = pixels.index_from_expression(d, "(B8 - B4) / (B8 - B4) + sqrt(B2 * 2)").first()
    assert r["index"] is None
    assert pixels.index_from_expression(d, "-(B8 / B2) ** 2").first()["index"] == pytest.approx(-6.25)
    with pytest.raises(ValueError):
        pixels.index_from_expression(d, "__import__('os')")
    assert pixels.closest_bands({"x": 500.0, "y": 860.0}, {"B2": 496.6, "B8A": 864.8}) == {"B2": "x", "B8A": "y"}
    assert len(pixels.ALL_INDICES) == 39


def test_moving_window_equals_brute_force(spark):
    r = np.random.default_rng(3)
    m = r.integers(0, 5, (7, 6)).astype(float)
    m[2, 3] = 254
    d = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(7) for j in range(6)], "row long, col long, value double")
    got = {(x.row, x.col): x for x in pixels.moving_diversity(d, window=3, alpha=2).collect()}
    assert (2, 3) not in got and len(got) == 41
    for (i, j), x in got.items():
        w = m[max(0, i - 1):i + 2, max(0, j - 1):j + 2].ravel()
        w = w[w < 252]
        v, n = np.unique(w, return_counts=True)
        p = n / n.sum()
        assert x.shannon == pytest.approx(-(p * np.log(p)).sum(), abs=1e-9) and x.hill == pytest.approx(1 / (p * p).sum())
        assert x.rao == pytest.approx((np.abs(v[:, None] - v) * np.outer(p, p)).sum(), abs=1e-9)
        s = 1 - np.cumsum(p)[:-1]
        assert x.cre == pytest.approx(-(s * np.log(s) * np.diff(v)).sum(), abs=1e-9)


def test_mosaic_resample_geojson(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "row int, col int, value double")
    b = spark.createDataFrame([(0, 1, 9.0), (0, 0, -1.0)], "row int, col int, value double")
    assert {(r.row, r.col): r.value for r in pixels.mosaic([a, b], nodata=-1.0).collect()} == {(0, 0): 1.0, (0, 1): 9.0}
    up = pixels.resample(a.withColumnRenamed("value", "v"), (0, 1, 1, 1), (0, 1, .5, .5), (2, 4), ["v"]).collect()
    assert sorted((r.row, r.col, r.v) for r in up) == [(i, j, 1.0 if j < 2 else 2.0) for i in range(2) for j in range(4)]
    j = pixels.points_to_geojson(spark.createDataFrame([(1.0, 2.0, "x")], "lat double, lon double, n string")).first().feature
    assert j == '{"type":"Feature","geometry":{"type":"Point","coordinates":[2.0,1.0]},"properties":{"n":"x"}}'


def test_streams_equal_batch(spark, tmp_path):
    r = np.random.default_rng(1)
    p = pd.DataFrame({"file": r.choice(["a", "b"], 200), "taxon": r.choice(["x", "y", "empty"], 200), "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(r.integers(0, 86400, 200)), unit="s")})
    d = spark.createDataFrame(p).withColumn("species", F.col("taxon"))
    d.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    for k, (op, mode) in enumerate(((lambda t: st.tidy_live(t, delay="2 days").select("file", "taxon"), "append"), (lambda t: st.hourly_contacts(t, delay="2 days"), "complete"),
                                    (lambda t: st.detection_sessions(t, delay="2 days"), "complete"))):
        live = st.read_detections(spark, str(tmp_path / "in"), d.schema, files_per_trigger=1)
        q = op(live).writeStream.format("memory").queryName(f"m{k}").outputMode(mode).option("checkpointLocation", str(tmp_path / f"c{k}")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert sorted(map(tuple, spark.table(f"m{k}").collect())) == sorted(map(tuple, op(d).collect()))
