"""Repeated rows that are the first to hold a passage."""

from __future__ import annotations

import numpy as np

from quorumlens.llm import suffixes
from tests.llm import brute


def test_a_repeated_row_keeps_what_it_is_first_to_hold(spark):
    rng = np.random.default_rng(14)
    letters = list("abcdefgh ")

    def some(n):
        return "".join(rng.choice(letters, n))

    passage = some(400)
    once = [
        (1, some(150) + passage + some(150)),
        (2, some(90) + passage[:260] + some(90)),
        (3, some(70) + passage[130:] + some(70)),
        (None, some(80) + passage[50:350] + some(80)),
    ]
    rows = once + [r for r in once if r[0] != 3 for _ in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, tuple((s.begin, s.end) for s in r.spans)) for r in suffixes.dedup_substrings(df).collect()}
    want = {i: (gone, n) for i, _, gone, n, _ in brute.repeats([(-1 if i is None else i, t) for i, t in once])}
    assert len(found) == len(once)
    assert {-1 if i is None else i: (sum(b - a for a, b in s), len(s)) for i, s in found} == want
