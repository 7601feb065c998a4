"""The pipeline's near-duplicate stage against all pairs of shingle sets."""

from __future__ import annotations

from itertools import combinations

import numpy as np

import corpus_pipeline
from quorumlens.llm import near, simhash
from tests.llm import brute


def kept(rows, similarity=0.8):
    """The smallest id of each component of texts with Jaccard similarity."""
    sets = {i: brute.shingles(t) for i, t in rows}
    close = [
        (a, b)
        for a, b in combinations(sets, 2)
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9
    ]
    return sorted(set(brute.union(sets, close).values())), len(close)


def edited(rng, base, words, edits):
    text = list(base)
    for _ in range(edits):
        text[rng.integers(len(text))] = str(rng.choice(words))
    return " ".join(text)


def test_near_copies_from_similarity_080(spark):
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(5000)]
    rows = []
    for g in range(60):
        base = [str(x) for x in rng.choice(words, rng.integers(40, 400))]
        for _ in range(4):
            rows.append((len(rows), edited(rng, base, words, int(len(base) * rng.uniform(0, 0.035)))))
    rows += [(1000, ""), (1001, "two words"), (1002, "Two  words"), (1003, "two words more")]
    want, n = kept(rows)
    assert n > 100 and len(want) > 70  # pairs on both sides of the threshold
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == want


def test_cut_groups_are_joined_whole(spark, monkeypatch):
    rng = np.random.default_rng(12)
    words = [f"w{k}" for k in range(5000)]
    base = [str(x) for x in rng.choice(words, 200)]
    rows = []
    # A chain whose ends are unlike, and copies of two far members.
    for k in range(60):
        rows.append((k, " ".join(base)))
        for _ in range(2):
            base[rng.integers(len(base))] = str(rng.choice(words))
    rows += [(100 + k, edited(rng, base, words, 3)) for k in range(40)]
    rows += [(200 + k, edited(rng, rows[5][1].split(), words, 9)) for k in range(40)]
    want, _ = kept(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for shingles, band in ((2_000_000, 4096), (2000, 16)):
        monkeypatch.setattr(near, "SHINGLES", shingles)
        monkeypatch.setattr(near, "BAND_ROWS", band)
        assert sorted(r.doc_id for r in near.keep_one(df).collect()) == want, shingles


def test_fingerprints_alone_lead_to_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(13)
    words = [f"w{k}" for k in range(5000)]
    rows = []
    for _ in range(40):
        base = [str(x) for x in rng.choice(words, 300)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, edited(rng, base, words, 1))]
    rows += [(1000, ""), (1001, None), (1002, "two words")]
    fps = {i: simhash.majority(near.shingle_set(t, 5)) for i, t in rows}
    want = [i for i, _ in rows if i != 1001 and not (i < 80 and i % 2 and (fps[i] ^ fps[i - 1]).bit_count() <= 4)]
    assert 5 < len(rows) - len(want) < 42  # copies within the radius and beyond it
    monkeypatch.setattr(near, "candidates", lambda classes, _: spark.createDataFrame([], "a long, b long"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == want
