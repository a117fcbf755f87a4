"""A few rows of published survey data and the results that belong to them, copied by hand."""
import pytest

from biolattice.operators import community, trends

# Individuals per rotation (observation unit, rotation, species, number) of three stationary video surveys.
SURVEYS = [
    ("AB100029", 1, "Zebrscop", 4), ("AB100029", 2, "Zebrscop", 4), ("AB100029", 3, "Zebrscop", 3), ("AB100029", 3, "Hemifasc", 1),
    ("AB100029", 1, "Zebrscop", 1), ("AB100029", 2, "Zebrscop", 1), ("AB100029", 3, "Zebrscop", 1), ("AB100029", 1, "Zebrscop", 1),
    ("AB100029", 2, "Zebrscop", 5), ("AB100062", 1, "Zebrscop", 2), ("AB100062", 2, "Zebrscop", 1), ("AB100062", 3, "Zebrscop", 1),
    ("AB100062", 1, "Zebrscop", 1), ("AB100062", 2, "Zebrscop", 1), ("AB100062", 3, "Zebrscop", 1), ("AB100062", 1, "Hemifasc", 1),
    ("AB100062", 2, "Zebrscop", 1), ("AB100062", 2, "Hemifasc", 1), ("AB100062", 3, "Zebrscop", 1), ("AB100132", 2, "Zebrscop", 1),
    ("AB100132", 3, "Zebrscop", 1), ("AB100132", 1, "Zebrscop", 1), ("AB100132", 2, "Hemifasc", 1), ("AB100132", 2, "Zebrscop", 1),
    ("AB100132", 3, "Zebrscop", 2), ("AB100132", 3, "Hemifasc", 1), ("AB100132", 1, "Zebrscop", 2), ("AB100132", 3, "Zebrscop", 1),
    ("AB100132", 2, "Zebrscop", 3), ("AB100132", 2, "Zebrscop", 1)]

# Number, species richness, Simpson, its complement, Shannon, Pielou, Hill.
METRICS = {
    "AB100029": (7, 2, 0.909297052154195, 0.0907029478458048, 0.191444081957717, 0.276195427647939, 0.0748993922015743),
    "AB100062": (3.66666666666667, 2, 0.702479338842975, 0.297520661157025, 0.474139313057837, 0.684038435639042, 0.185182969156178),
    "AB100132": (5, 2, 0.768888888888889, 0.231111111111111, 0.392674467227552, 0.566509506552905, 0.156057437428911)}


def test_rotations_and_community_metrics(spark):
    d = spark.createDataFrame(SURVEYS, "observation_unit string, rotation int, species string, number int")
    per = community.rotation_abundance(d, ["observation_unit", "species"])
    row = per.filter("observation_unit = 'AB100029' AND species = 'Zebrscop'").first().asDict()
    assert (row["number"], row["number_max"]) == (pytest.approx(6.66666666666667), 10) and row["number_sd"] == pytest.approx(3.05505046330389)
    got = {r.observation_unit: tuple(r)[1:] for r in community.community_metrics(per, ["observation_unit"]).collect()}
    assert set(got) == set(METRICS)
    for unit, want in METRICS.items():
        assert got[unit] == pytest.approx(want)


@pytest.mark.parametrize("trend,p,low,high,words", [(1.005, 0.432, 0.993, 1.016, "Stable")])
def test_category_of_a_published_trend(spark, trend, p, low, high, words):
    from pyspark.sql import functions as F
    got = spark.range(1).select(trends.trend_category(*map(F.lit, (trend, p, low, high))).alias("c")).first().c
    assert got == words
