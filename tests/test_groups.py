"""NULL groups, equal rows, unlisted levels, trees that are none."""
import math
import statistics

import pytest
from pyspark.sql import functions as F

from biolattice.functions import scale
from biolattice.operators import community, models
from biolattice.sources.trees import tree_closure

ROWS = [(g, float(v)) for g, n in (("a", 7), (None, 10), ("b", 1)) for v in range(n)]


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(ROWS, "g string, v double")


def of(name):
    return [v for g, v in ROWS if g == name]


def test_null_groups_have_quantiles(groups):
    for frame in (community.describe_by(groups, "v", ["g"]), scale.describe_exact(groups, ["g"], "v", {"median": .5}),
                  community.dissimilarity_summary(groups, ["g"], "v")):
        got = {r.g: r for r in frame.collect()}
        assert set(got) == {"a", "b", None} and all(got[g].median == statistics.median(of(g)) for g in got)
        assert abs(got[None].sd - statistics.stdev(of(None))) < 1e-12


def test_null_group_of_turned_blocks(spark):
    rows = [(g, t, u) for g in ("x", None) for t, u in ((1, 9), (5, 5), (9, 1))]
    got = {r.site: r for r in community.turned_block_score(spark.createDataFrame(rows, "site string, turned int, unturned int"), ["site"]).collect()}
    assert set(got) == {"x", None} and got[None].share_median == 50 == got["x"].share_median


def test_null_groups_in_ordered_steps(groups):
    n = len(ROWS)
    assert scale.value_index(groups, ["g"], "v", ["v"]).filter("idx = v").count() == n
    prev = {(r.g, r.v): r.prev_v for r in scale.previous_row(groups, ["g"], "v", ["v"]).collect()}
    assert len(prev) == n and prev[None, 4.0] == 3.0 and prev[None, 0.0] is None
    near = scale.nearest_marked(groups.withColumns({"m": F.col("v") == 3, "w": F.col("v")}), ["g"], "v", "m", ["w"]).collect()
    assert len(near) == n and {r.near_w for r in near if r.g is None} == {3.0}


def test_equal_rows_are_dealt_out(spark):
    d = spark.range(0, 40000, 1, 16).select(F.lit("k").alias("k"), F.lit(1).alias("x"))
    small = spark.createDataFrame([("k", 5)], "k string, y int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = scale.join_small(d, small, ["k"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40000 and got.filter("y = 5").count() == 40000 and len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_null_keys_meet_on_request(spark):
    a, b = spark.createDataFrame([(None, 1), ("k", 2)], "k string, x int"), spark.createDataFrame([(None, 3), ("k", 4)], "k string, y int")
    assert sorted(scale.join_small(a, b, ["k"], nulls=True).select("x", "y").collect()) == [(1, 3), (2, 4)]
    assert [tuple(r) for r in scale.join_small(a, b, ["k"]).select("x", "y").collect()] == [(2, 4)]


def test_unlisted_levels_take_no_part(spark):
    rows = [("a", 3), ("a", 3), ("b", 6), ("b", 6), ("c", 500), ("c", 700)]
    d = spark.createDataFrame(rows, "f string, y int")
    coef, fits = models.grouped_glm(d, "y", [], factors={"f": ["a", "b"]}, family="poisson")
    got = {r.term: r.estimate for r in coef.collect()}
    assert abs(got["(Intercept)"] - math.log(3)) < 1e-6 and abs(got["fb"] - math.log(2)) < 1e-6
    assert fits.first().n == 4


@pytest.mark.parametrize("edges", [[(1, 1, 1.0, "x")], [(1, 2, 1.0, "x"), (2, 1, 1.0, None)], [(0, None, 0.0, None), (1, 2, 1.0, "x"), (2, 3, 1.0, None), (3, 1, 1.0, None)]])
def test_a_cycle_raises(spark, edges):
    with pytest.raises(ValueError, match="cycle"):
        tree_closure(spark.createDataFrame(edges, "node long, parent long, length double, tip string"))
