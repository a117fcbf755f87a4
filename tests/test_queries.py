"""Named queries beside their SQL on the smallest tables (ORACLE=all for every query)."""
import os

import pytest

import __spark_entry__ as entry
from oracle import compare

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
SOME = ["community_metrics", "rotation_abundance", "lcbd", "bray_curtis", "describe_by", "tidy_detections", "recording_time", "accretion_correct", "clip_and_fill",
        "merge_complementary", "nearest_point", "nearest_in_time", "enrich_with_grid", "extrapolate_ids", "site_summary", "abundance_index", "annual_variation", "group_index",
        "glm_poisson", "levene", "variant_filter_chain", "pairwise_fst", "consensus", "phylo_diversity", "spectral_indices", "moving_diversity", "vcf_roundtrip", "live_tidy"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def names():
    return list(entry.queries()) if os.environ.get("ORACLE") == "all" else SOME


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, name):
    ok, msg, _ = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, msg


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
