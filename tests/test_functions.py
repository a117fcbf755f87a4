"""Scale helpers against brute force, and tails against published values."""
import numpy as np
import pandas as pd
import math

import pytest
from pyspark.sql import functions as F

from biolattice.functions import (MissingColumns, dense_index, exact_quantiles, first_per_key, ln_choose_ratio, nearest_marked,
                                  ordered_index, permuted_index, previous_row, require_columns, week_of_year)
from biolattice.functions.scale import join_small, range_buckets, value_index
from biolattice.functions.tails import erfc, f_upper, ln_gamma, t_two_sided, z_two_sided


def frame(seed=1, n=400):
    r = np.random.default_rng(seed)
    return pd.DataFrame({"g": r.integers(0, 3, n), "v": np.round(r.normal(5, 80, n), 1), "t": r.integers(0, 200, n),
                         "m": r.random(n) < .06, "id": np.arange(n)})


def test_tails_match_tables():
    assert t_two_sided([2.228139, 12.706205], [10, 1]) == pytest.approx([0.05, 0.05], abs=1e-6)
    assert f_upper([4.102821], [2], [10]) == pytest.approx([0.05], abs=1e-6)
    assert z_two_sided([1.959964]) == pytest.approx([0.05], abs=1e-6)


def test_quantiles_are_exact_per_group_and_overall(spark):
    p = frame()
    probs = {"a": 0.0, "b": .25, "c": .5, "d": .98, "e": 1.0}
    got = exact_quantiles(spark.createDataFrame(p), ["g"], "v", probs).toPandas().sort_values("g")
    want = p.groupby("g").v.quantile(list(probs.values())).unstack()
    np.testing.assert_allclose(got[list(probs)].to_numpy(), want.to_numpy(), atol=1e-9)
    one = exact_quantiles(spark.createDataFrame(p), [], "v", {"m": .5}).first()
    assert one.m == pytest.approx(p.v.median())


def test_quantiles_with_one_hot_value(spark):
    p = pd.DataFrame({"g": ["a"] * 100, "v": [7.0] * 90 + list(range(10))})
    got = exact_quantiles(spark.createDataFrame(p), ["g"], "v", {"q": .5, "low": .05}).first()
    assert got.q == 7.0 and got.low == pytest.approx(np.quantile(p.v, .05))


def test_nearest_marked_equals_brute_force(spark):
    p = frame(2)
    got = nearest_marked(spark.createDataFrame(p), ["g"], "t", "m", ["id"]).toPandas()
    for x in got.itertuples():
        c = p[(p.g == x.g) & p.m]
        d = (c.t - x.t).abs()
        best = c[d == d.min()]
        best = best[best.t == best.t.max()]
        assert x.near_t == best.t.max() and x.near_id == best.id.max()


def test_nearest_marked_without_marks_is_null(spark):
    d = spark.createDataFrame([("a", 1.0, False), ("b", 2.0, True)], "g string, t double, m boolean")
    got = {r.g: r.near_t for r in nearest_marked(d, ["g"], "t", "m", []).collect()}
    assert got == {"a": None, "b": 2.0}


def test_previous_row_equals_lag(spark):
    p = frame(3).drop_duplicates(["g", "t"])
    got = previous_row(spark.createDataFrame(p), ["g"], "t", ["t", "v"], buckets=7).toPandas()
    want = p.sort_values(["g", "t"])
    want["prev_v"] = want.groupby("g").v.shift()
    m = got.merge(want[["g", "t", "prev_v"]], on=["g", "t"])
    assert ((m.prev_v_x == m.prev_v_y) | (m.prev_v_x.isna() & m.prev_v_y.isna())).all() and len(m) == len(p)


def test_indexes_are_dense_and_ordered(spark):
    p = frame(4)
    d = dense_index(spark.createDataFrame(p), "id").toPandas()
    assert sorted(d.idx) == list(range(len(p)))
    o = value_index(spark.createDataFrame(p), ["g"], "v", ["v", "id"]).toPandas().sort_values(["g", "v", "id"])
    assert (o.idx == o.groupby("g").cumcount()).all()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 97, 1000])
def test_permutation_is_a_bijection(spark, n):
    for key in (1, 2):
        got = spark.range(n).select(permuted_index("id", F.lit(n), F.lit(key)).alias("p")).toPandas().p
        assert sorted(got) == list(range(n))


def test_first_per_key_and_last(spark):
    d = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert {r.k: r.v for r in first_per_key(d, ["k"], ["o"]).collect()} == {"a": "y", "b": "z"}
    assert {r.k: r.v for r in first_per_key(d, ["k"], ["o"], last=True).collect()} == {"a": "x", "b": "z"}


def test_choose_ratio(spark):
    got = spark.range(1).select(F.exp(ln_choose_ratio(F.lit(10), F.lit(3), F.lit(4))).alias("r"), ln_choose_ratio(F.lit(5), F.lit(3), F.lit(4)).alias("n")).first()
    assert got.r == pytest.approx(35 / 210) and got.n is None


@pytest.mark.parametrize("total,ni,n", [(10_000_000, 3, 4_000_000), (10_000_000, 5000, 2000), (10_000_000, 4_000_000, 7), (30, 2, 28), (12, 1, 1), (1000, 500, 500), (3, 0, 2)])
def test_choose_ratio_of_large_counts(spark, total, ni, n):
    got = spark.range(1).select(ln_choose_ratio(F.lit(total), F.lit(ni), F.lit(n)).alias("r")).first().r
    small, large = min(ni, n), max(ni, n)
    exact = sum(math.log((total - large - j) / (total - j)) for j in range(small))
    assert got == pytest.approx(exact, rel=1e-9, abs=1e-10)


@pytest.mark.parametrize("shape", ["narrow", "outlier", "hot"])
def test_range_buckets_split_any_scale(spark, shape):
    d = spark.range(5000)
    v = {"narrow": 1.7e9 + F.col("id") * 100, "outlier": F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") * 1.0), "hot": F.col("id") * 1.0}[shape]
    g = F.when(F.col("id") % 100 == 0, "rare").otherwise("hot") if shape == "hot" else F.lit("one")
    b = range_buckets(d.select(g.alias("g"), v.alias("v")), ["g"], "v").groupBy("g", "_b").count().toPandas()
    top = b[b.g != "rare"]
    assert len(top) > 60 and top["count"].max() < 4 * top["count"].mean()


def test_join_small_is_a_join_and_splits_a_key(spark):
    big = spark.range(1000).selectExpr("id", "case when id < 990 then 'a' when id < 999 then 'b' end as k")
    small = big.groupBy("k").count()
    got = join_small(big, small, ["k"]).toPandas()
    assert len(got) == 999 and (got[got.k == "a"]["count"] == 990).all()
    assert join_small(big, small.filter("k = 'b'"), ["k"], "left_anti").count() == 991
    assert join_small(big, big.agg(F.max("id").alias("m")), []).filter("m = 999").count() == 1000
    plan = join_small(big, small, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_week_number(spark):
    d = spark.sql("SELECT explode(sequence(date'2015-12-25', date'2018-01-10')) AS d").select("d", week_of_year("d").alias("w")).toPandas()
    assert all(int(x.d.strftime("%W")) == x.w for x in d.itertuples())


def test_require_columns(spark):
    d = spark.createDataFrame([(1,)], "a int")
    assert require_columns(d, ["a"]) is d
    with pytest.raises(MissingColumns):
        require_columns(d, ["b"])
    with pytest.raises(MissingColumns):
        require_columns(d, [], 2)


def test_special_functions_against_the_library():
    x = np.concatenate([np.linspace(0, 6, 301), [2.4999, 2.5, 10.0, 25.0]])
    assert erfc(x) == pytest.approx([math.erfc(v) for v in x], rel=1e-10)
    z = np.concatenate([np.linspace(0.05, 30, 300), [1e3, 1e7]])
    assert ln_gamma(z) == pytest.approx([math.lgamma(v) for v in z], rel=1e-11, abs=1e-12)


def test_ln_gamma_column(spark):
    from biolattice.functions.scalars import ln_gamma as column
    got = spark.createDataFrame([(v,) for v in (0.3, 1.0, 2.0, 11.5, 12.0, 170.0, 1e6)], "z double").select("z", column(F.col("z")).alias("g")).collect()
    assert all(r.g == pytest.approx(math.lgamma(r.z), rel=1e-11, abs=1e-11) for r in got)


def test_checkpoints_can_be_dropped(spark):
    import glob
    from biolattice.functions.scale import cut_lineage, drop_checkpoint
    a = cut_lineage(spark.range(10))
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{base}/rdd-*"))
    drop_checkpoint(a)
    assert len(before - set(glob.glob(f"{base}/rdd-*"))) == 1
    drop_checkpoint(spark.range(3))
