"""Statistics per address family on rows of the test's own."""

from __future__ import annotations

from quorumlens.functions import constants as K
from quorumlens.operators import families


def test_flat_dimensions_of_both_families(spark):
    rows = [
        (4, 70.0, "high", ["b", "a"], ["x"], ["s"]),
        (4, 70.0, "high", ["a", "b"], ["x", "y"], ["s", "t"]),
        (6, 50.0, "medium", ["a"], ["x"], ["s"]),
        (6, 60.0, "medium", ["b"], ["y"], ["s"]),
    ]
    schema = (
        "family int, score double, band string, categories array<string>, independence_classes array<string>, "
        "sources array<string>"
    )
    found = families.flat_dimensions(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.family, r.analysis, r.distinct_values) for r in found) == sorted(
        [
            (4, K.FLAT_SCORES, 1),
            (4, K.FLAT_BANDS, 1),
            (4, K.FLAT_CATEGORIES, 1),
            (6, K.FLAT_BANDS, 1),
            (6, K.FLAT_CHANGES, 1),
            (6, K.FLAT_NETWORKS, 0),
        ]
    )
