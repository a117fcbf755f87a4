"""M-05 against a plain version that works row by row, and its rules."""
import math
import random

import numpy as np
import pytest

from biolattice.operators import boosting as B


def plain_trees(rows, y, trees, rate, least):
    """Boosting of single rows: every pair of splits is tried by hand; returns the log odds of the rows."""
    mean = sum(y) / len(y)
    score = [math.log(mean / (1 - mean))] * len(y)

    def split(ids, z):
        best = (0.0, None, None)
        for f in range(len(rows[0])):
            for cut in sorted({rows[i][f] for i in ids}):
                left = [i for i in ids if rows[i][f] <= cut]
                right = [i for i in ids if rows[i][f] > cut]
                if len(left) >= least and len(right) >= least:
                    a, b = (sum(z[i] for i in s) / len(s) for s in (left, right))
                    gain = len(left) * len(right) / len(ids) * (a - b) ** 2
                    if gain > best[0] + 1e-12:
                        best = (gain, left, right)
        return best

    for _ in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in score]
        z = [a - b for a, b in zip(y, p)]
        gain, left, right = split(range(len(y)), z)
        if left is None:
            continue
        one, two = split(left, z), split(right, z)
        if one[1] is None and two[1] is None:
            leaves = [left, right]
        else:
            leaves = [*one[1:], right] if one[0] >= two[0] else [left, *two[1:]]
        for leaf in leaves:
            v = rate * sum(z[i] for i in leaf) / sum(p[i] * (1 - p[i]) for i in leaf)
            for i in leaf:
                score[i] += v
    return score


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_equal_a_plain_version(seed):
    rng = random.Random(seed)
    rows = [[rng.randrange(6), rng.randrange(4), rng.randrange(8)] for _ in range(200)]
    y = [int(rng.random() < (0.8 if a > 2 and c < 5 else 0.2)) for a, b, c in rows]
    cells = sorted({tuple(r) for r in rows})
    n = np.array([sum(tuple(r) == c for r in rows) for c in cells])
    k = np.array([sum(v for r, v in zip(rows, y) if tuple(r) == c) for c in cells])
    fit = B.Boosting(np.array(cells), n, k, 8, 0.1, least=7)
    for _ in range(25):
        fit.grow()
    want = dict(zip(map(tuple, rows), plain_trees(rows, y, 25, 0.1, 7)))
    assert np.allclose(fit.score, [want[c] for c in cells])
    assert np.allclose(B.scores(fit.model(), np.array(cells)), fit.score)


def test_rows_are_dealt_whole():
    n, start = np.array([0, 1, 9, 10, 11, 34]), np.array([3, 9, 0, 4, 9, 7])
    parts = np.array([B.dealt(n, start, f, 10) for f in range(10)])
    assert (parts.sum(0) == n).all() and (parts.max(0) - parts.min(0) <= 1).all() and parts[9, 1] == 1


def test_curve_measures():
    y, n, p = np.array([0, 1, 2]), np.array([2, 2, 2]), np.array([0.1, 0.5, 0.9])
    rows = [(0, .1), (0, .1), (1, .5), (0, .5), (1, .9), (1, .9)]
    assert abs(B.deviance(y, n, p) - np.mean([-2 * math.log(q if v else 1 - q) for v, q in rows])) < 1e-12
    pairs = [1.0 if a > b else 0.5 if a == b else 0.0 for v, a in rows if v for u, b in rows if not u]
    assert abs(B.area_under_curve(y, n, p) - np.mean(pairs)) < 1e-12


def test_species_distribution(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(-3 * x[:, 0]))
    rows = [("a", *map(float, r), int(rng.random() < q)) for r, q in zip(x, p)] + [("one", *map(float, r), 1) for r in x[:60]]
    rows += [("a", None, 1.0, 1), ("a", 1.0, 1.0, None), (None, 1.0, 1.0, 1)]
    d = spark.createDataFrame(rows, "sp string, u double, v double, presence int")
    g = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:100])] + [(100, None, 0.0), (101, float("nan"), 0.0)], "id long, u double, v double")
    args = dict(species="sp", rate=0.1, least_rate=0.05, least_trees=100, most_trees=100, folds=3, bins=16)
    pred, ev = B.species_distribution(d, g, ["u", "v"], **args)
    got, ev = pred.toPandas(), {r.sp: r for r in ev.collect()}
    assert set(ev) == {"a", "one"} and len(got) == 2 * 102 and list(got.columns) == ["id", "u", "v", "sp", "pred"]
    assert ev["a"].deviance_explained > 0.2 and ev["a"].auc > 0.8 and ev["a"].rate in (0.1, 0.05) and ev["a"].trees % 50 == 0
    assert ev["one"].auc is None and ev["one"].deviance_explained is None
    a = got[got.sp == "a"].sort_values("id")
    assert a.pred[-2:].isna().all() and np.corrcoef(a.pred[:100], p[:100])[0, 1] > 0.9
    assert (got[(got.sp == "one") & (got.id < 100)].pred > 0.99).all()
    small = B.species_distribution(d.repartition(7), g, ["u", "v"], **args, block_mb=0)[0].toPandas()
    assert small.sort_values(["sp", "id"]).pred.fillna(-1).tolist() == got.sort_values(["sp", "id"]).pred.fillna(-1).tolist()
    assert B.species_distribution(d.limit(0), g, ["u", "v"], **args)[0].count() == 0
