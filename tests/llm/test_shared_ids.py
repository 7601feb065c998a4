"""Texts that share an id with other texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quorumlens.llm import lines
from tests.llm import brute


def test_similar_lines_of_texts_with_one_id(spark):
    rng = np.random.default_rng(13)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in (None, 7, 9):
        base = [[str(x) for x in rng.choice(words, 12, replace=False)] for _ in range(12)]
        for _ in range(12):
            text = []
            for k in rng.permutation(12)[:4]:
                line = list(base[k])
                line[rng.integers(12)] = str(rng.choice(words))
                text.append(" ".join(line))
            rows.append((i, "\n".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # The documented order: null ids first, then by content hash.
    order = df.select("doc_id", F.xxhash64("text").alias("c"), "text").collect()
    order = sorted(order, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.c))
    want = brute.line_rows([(k, r.text) for k, r in enumerate(order)])
    got = [(r.doc_id, r.text) for r in lines.dedup_lines(df).select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(((order[k].doc_id, t) for k, t in want), key=str)
