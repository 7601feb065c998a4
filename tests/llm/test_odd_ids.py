"""Exact substrings under null, negative and extreme ids, and under one id with contents whose hashes agree in half."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quorumlens.llm import suffixes
from tests.llm import brute

FIRST, LAST = -(1 << 63), (1 << 63) - 1


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffixes.dedup_substrings(df)
    got = [(r.doc_id, suffixes.kept_bytes(r.text, r.spans)) for r in found.collect()]
    order = df.distinct().select("doc_id", F.xxhash64("text").alias("c"), "text").collect()
    order = sorted(order, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.c))
    left = {k: sha for k, _, _, _, sha in brute.repeats([(k, r.text) for k, r in enumerate(order)])}
    want = {(r.doc_id, r.text): left[k] for k, r in enumerate(order)}
    return sorted((str(i), hashlib.sha256(raw).hexdigest()) for i, raw in got), sorted(
        (str(i), want[i, t]) for i, t in rows
    )


def passage(rng, size):
    return "".join(rng.choice(list("abcdefghijklmnop qrstuvwxyz"), size))


@pytest.mark.parametrize("seed", [1, 2])
def test_every_id_is_itself(spark, seed):
    rng = np.random.default_rng(seed)
    shared = [passage(rng, n) for n in (120, 150, 400, 900)]
    rows = []
    for i in (None, -1, 0, 1, FIRST, FIRST + 1, LAST, LAST - 1, -2):
        for _ in range(2):
            rows.append((i, passage(rng, 60).join(str(x) for x in rng.permutation(shared)[:2]) + passage(rng, 30)))
    rows += [(None, shared[2]), (-1, shared[2]), (FIRST, shared[2]), (LAST, shared[2]), (LAST, shared[2])]
    got, want = kept(spark, rows)
    assert got == want


def test_the_first_occurrence_stays_where_half_of_two_hashes_agrees(spark):
    rng = np.random.default_rng(7)
    shared = passage(rng, 150)
    seen: dict[int, str] = {}
    pair = None
    k = 0
    while pair is None:
        text = f"{k} {shared} {k}"
        half = xxhash.xxh64_intdigest(text.encode(), 42) >> 32
        if half in seen:
            pair = (seen[half], text)
        seen[half] = text
        k += 1
    got, want = kept(spark, [(None, pair[0]), (None, pair[1]), (3, "other " + passage(rng, 200))])
    assert got == want
    assert any(len(raw) for raw in got)
