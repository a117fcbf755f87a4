"""Steps whose cost or input broke on larger tables."""
import datetime

import numpy as np

from biolattice.functions import scale
from biolattice.operators import community, coverage, joins, permutation, trends


def test_nearest_marked_has_no_frame_that_is_summed_anew(spark):
    d = spark.createDataFrame([("a", float(i), i % 7 == 3, i) for i in range(300)] + [("b", 1.0, False, 0)], "g string, t double, m boolean, v int")
    got = scale.nearest_marked(d, ["g"], "t", "m", ["v"], buckets=8)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing" not in plan
    marks = np.arange(3, 300, 7)
    for r in got.collect():
        if r.g == "b":
            assert r.near_v is None
        else:
            gap = abs(marks - r.t)
            assert r.near_v == marks[gap == gap.min()].max()


def test_expansion_side_stays_below_half_a_second(spark, tmp_path):
    from biolattice.plans import all_queries
    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i), i, "view", 560.0 if i < 4 else 20.0, f'{{"k": {i}}}') for i in range(30)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.channel for r in all_queries()["stereo_channel"](spark, str(tmp_path)).collect()}
    assert got == {i: "Direct" if i % 2 else "Expansion" for i in range(30)}
    assert all_queries()["contacts_by_section"](spark, str(tmp_path)).count()
    assert all_queries()["transect_summary"](spark, str(tmp_path)).count()


def test_rounded_join_makes_no_row_for_each_pair(spark):
    a = spark.createDataFrame([(1, 0.001, 2.0, 5.0), (1, 0.0, 2.0, None), (2, 0.0, 2.004, 7.0), (2, 1.0, 2.0, 1.0), (None, 0.0, 2.0, 3.0), (4, None, 2.0, 3.0)],
                              "station int, lat double, lon double, w double")
    b = spark.createDataFrame([("x", 0.0, 2.0, 1), ("x", 0.002, 2.0, None), ("x", 1.0, 2.0, 10), ("y", 0.0, 2.0, None), ("z", 0.0, 2.0, 4), ("z", 0.0, 2.0, 5)],
                              "cluster string, lat double, lon double, v int")
    got = joins.rounded_coordinate_join(a, b, ["station", "cluster"], ["v", "w"])
    assert got.columns == ["station", "cluster", "v", "w"]
    assert {tuple(r) for r in got.collect()} == {(1, "x", 1.0, 5.0), (2, "x", 5.5, 5.0), (1, "z", 4.5, 5.0), (2, "z", 4.5, 7.0)}
    many = [a.limit(0).union(spark.range(2000).selectExpr("cast(id as int)", "0D", "2D", "1D")), b.limit(0).union(spark.range(2000).selectExpr("'x'", "0D", "2D", "1"))]
    plan = joins.rounded_coordinate_join(*many, ["station", "cluster"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate", plan.index("Join"))  # sums stand below the join


def test_coverage_documents_are_dealt_out(spark):
    xml = "<eml><geographicCoverage><geographicDescription> p </geographicDescription><boundingCoordinates>" + "".join(
        f"<{s}BoundingCoordinate>{v}</{s}BoundingCoordinate>" for s, v in (("west", 1), ("east", 2), ("north", 4), ("south", 3))) + "</boundingCoordinates></geographicCoverage></eml>"
    got = coverage.metadata_coverage(spark.range(500).selectExpr("id", f"'{xml}' as xml").coalesce(1), key="id")
    assert got.rdd.getNumPartitions() > 1 and got.distinct().count() == 500
    assert {tuple(r)[1:] for r in got.collect()} == {("p", 1.0, 2.0, 4.0, 3.0, "rectangle")}


def test_day_grid_query_has_no_aggregate_above_the_grid(spark, tmp_path):
    from biolattice.plans import all_queries
    when = [datetime.datetime(1996, 1, 1), datetime.datetime(1996, 6, 5), datetime.datetime(1996, 6, 5)]
    spark.createDataFrame([(i, 1, 7, 1, 2.0 + i, 1.0, 0.0, 0.0, t) for i, t in enumerate(when)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "n", "b", "SMALL", 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = all_queries()["day_grid"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("Generate")]
    rows = got.collect()
    assert len(rows) == len({(r.month, r.week, r.day_week) for r in rows}) == 366 and all(r.days == 1 for r in rows)
    assert {r.dayno: r["count"] for r in rows if r["count"]} == {157: 7.0} and sum(r.anchor for r in rows) == 10


def test_turned_medians_come_from_one_count(spark):
    rows = [(1, 1, 3), (1, 3, 1), (1, 0, 0), (1, None, 1), (2, 1, 3), (2, 1, 1), (2, 3, 0), (None, 0, 2)]
    got = community.turned_block_score(spark.createDataFrame(rows, "site int, turned int, unturned int"), ["site"])
    m = {r.site: (r.score_median, r.share_median, r.rest_median, r.n) for r in got.collect()}
    assert m == {1: (3.0, 50.0, 50.0, 2), 2: (3.0, 50.0, 50.0, 3), None: (0.0, 0.0, 100.0, 1)}
    assert "Generate inline" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_lcbd_held_and_moved_replicates_agree(spark):
    rng = np.random.default_rng(1)
    rows = [(s, f"k{k}", float(rng.integers(1, 9))) for s in range(40) for k in range(5) if rng.random() < .5]
    d = spark.createDataFrame(rows, "site int, species string, number double")
    held, moved = ({r.site: tuple(r) for r in permutation.lcbd_permutation(d, reps=60, seed=3, held_counts=h).collect()} for h in (1 << 24, 0))
    assert {k: v[2:] for k, v in held.items()} == {k: v[2:] for k, v in moved.items()} and len(held) == len({r[0] for r in rows})


def test_no_replicate_vector_is_moved_for_a_region(spark):
    rows = [(r, c, p, 5.0 + c, .3) for r in (None, "a", "b") for c in range(3) for p in (1, 2)] + [("lost", 0, 2, 5.0, .3)]
    d = spark.createDataFrame(rows, "region string, category int, period int, mean double, half_width double")
    by, overall = permutation.geometric_mean_uncertainty(d, reps=50, seed=3, reference=1)
    assert by._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInPandas") == 0
    # dealt over tasks, as a large region is, it gives the same
    more, whole = permutation.geometric_mean_uncertainty(d, reps=50, seed=3, reference=1, region_rows=4)
    for x, y in ((by, more), (overall, whole)):
        x, y = ({tuple(r)[:-4]: tuple(r)[-4:] for r in f.collect()} for f in (x, y))
        assert x.keys() == y.keys() and all(np.allclose(x[k], y[k], rtol=1e-12) for k in x)
    assert {tuple(r)[:2] for r in by.collect()} == {(r, p) for r in (None, "a", "b") for p in (1, 2)}
