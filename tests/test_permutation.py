"""Permutation p of indicator species against all relabelings of a small table."""
import math
from itertools import permutations

from biolattice.operators import permutation

SITES = [("s1", "x"), ("s2", "x"), ("s3", "y"), ("s4", "y"), ("s5", "y")]
COUNTS = {"only_x": {"s1": 4, "s2": 5}, "mixed": {"s1": 3, "s3": 1, "s4": 2}, "even": {s: 2 for s, _ in SITES}}


def value(counts, label):
    best = 0.0
    groups = {c: [s for s in label if label[s] == c] for c in set(label.values())}
    mean = {c: sum(counts.get(s, 0) for s in g) / len(g) for c, g in groups.items()}
    for c, g in groups.items():
        best = max(best, math.sqrt(mean[c] / sum(mean.values()) * sum(s in counts for s in g) / len(g)))
    return best


def test_indicator_p_is_the_exact_one(spark):
    rows = [(s, c, sp, float(n.get(s, 0))) for sp, n in COUNTS.items() for s, c in SITES]
    d = spark.createDataFrame(rows, "site string, cluster string, species string, number double")
    reps = 9999
    got = {r.species: r for r in permutation.indicator_species(d, reps=reps).collect()}
    label = dict(SITES)
    for sp, counts in COUNTS.items():
        seen = value(counts, label)
        every = [value(counts, dict(zip(label, p))) >= seen - 1e-12 for p in permutations(label.values())]
        exact = sum(every) / len(every)
        assert abs(got[sp].indval - seen) < 1e-12
        assert abs(got[sp].p_value - exact) < 5 * math.sqrt(exact * (1 - exact) / reps) + 2 / reps, (sp, got[sp], exact)
    whole = {r.species: r.p_value for r in permutation.indicator_species(d, reps=200, seed=4).collect()}
    slices = {r.species: r.p_value for r in permutation.indicator_species(d.repartition(9), reps=200, seed=4, slice_size=64).collect()}
    assert whole == slices


def test_no_rows_give_no_species(spark):
    d = spark.createDataFrame([], "site string, cluster string, species string, number double")
    assert permutation.indicator_species(d, reps=19).count() == 0


def contributions(rows):
    """LCBD of every site from dense shares; rows: one list of counts for each site."""
    y = [[math.sqrt(x / sum(r)) if sum(r) else 0.0 for x in r] for r in rows]
    mean = [sum(c) / len(y) for c in zip(*y)]
    ss = [sum((v - m) ** 2 for v, m in zip(r, mean)) for r in y]
    return [v / sum(ss) for v in ss]


def test_lcbd_p_is_the_exact_one(spark):
    counts = [[4, 0], [3, 0], [0, 2], [1, 6], [0, 0.5]]
    rows = [(f"s{i}", f"k{j}", float(x)) for i, r in enumerate(counts) for j, x in enumerate(r) if x]
    rows += [(None, "k0", 3.0), ("s1", None, 9.0)]
    d = spark.createDataFrame(rows, "site string, species string, number double")
    reps = 9999
    got = {r.site: r for r in permutation.lcbd_permutation(d, reps=reps, slice_size=5000).collect()}
    seen = contributions(counts)
    first, second = [r[0] for r in counts], [r[1] for r in counts]
    every = [contributions(list(zip(a, b))) for a in set(permutations(first)) for b in set(permutations(second))]
    for i in range(5):
        exact = sum(e[i] >= seen[i] - 1e-12 for e in every) / len(every)
        assert abs(got[f"s{i}"].lcbd - seen[i]) < 1e-12
        assert abs(got[f"s{i}"].p_value - exact) < 5 * math.sqrt(exact * (1 - exact) / reps) + 2 / reps, (i, got[f"s{i}"], exact)


def test_lcbd_blocks_and_slices_agree(spark):
    rows = [(i, j, float((i * 7 + j * 3) % 5 + 1)) for i in range(23) for j in range(6) if (i + j * j) % 4 == 0]
    d = spark.createDataFrame(rows, "site int, species int, number double")
    one = {tuple(r) for r in permutation.lcbd_permutation(d, reps=60, seed=3).select("site", "p_value", "p_holm").collect()}
    # blocks of about one count: many get nothing in a replicate
    many = {tuple(r) for r in permutation.lcbd_permutation(d.repartition(7), reps=60, seed=3, slice_size=25, block_rows=1).select("site", "p_value", "p_holm").collect()}
    assert one == many and len(one) == len({r[0] for r in rows})
    assert permutation.lcbd_permutation(d.filter("false"), reps=5).count() == 0
