"""The registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SAMPLE = [
    "ag01_corroboration_score",
    "ag38_all_tiers_in_one_pass",
    "fl01_first_failing_rule",
    "jn03_network_lookup",
    "jn06_first_seen_merge",
    "ag14_class_overlap",
    "ag20_network_rollup",
    "tk03_persistent_networks",
    "src05_netblock_json",
    "sk07_lookup_table",
    "jn03_overlapping_ranges",
    "jn04_explain_lookup",
    "jn14_contiguous_runs",
    "src07_ipv6_ranges",
    "src09_levels_by_path",
    "src18_gzip_lines",
    "ag39_ablation_and_floor_sweep",
    "sk09_published_schema",
    "tk05_address_order",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, sf, name):
    result, _ = compare(spark, con, sf, entry.queries()[name], entry.oracle_sql()[name])
    assert result == "ok"


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
