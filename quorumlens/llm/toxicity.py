"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text, from a bounded sample of labelled
rows.  Toxic text is mostly ordinary text, so what the toxic dictionary is trained on is contrast: the words of toxic
lines that are many times more frequent there than in ordinary lines.  Each line counts once, so that copies and
shared passages do not pass for a trait of a class.  A text is cut into overlapping windows of bytes, and each window
is compressed twice: with the ordinary dictionary, and with the toxic one in front of it.  Both see the ordinary part
alike, so the difference of the two lengths is what the toxic part saves.  A logistic curve over the largest
differences, the numbers of windows over two levels and the number of windows is fitted on sample rows that no
dictionary has seen, weighted back to the frequencies of the labels; it turns them into a score from 0 to 1.

Only the fit is bounded (SAMPLE_ROWS rows a class, of at most SAMPLE_BYTES each, the least by hash of the id).
Scoring reads every text whole, on the executors, and never sees labels, ids or other columns.

Edge cases: null and empty texts have no windows and get the score of that; repeated rows get equal scores; without
labelled rows of both classes the score is the share of toxic ones (0 without any); where the sample is too small to
train a dictionary, the sample's own text takes its place.
"""

from __future__ import annotations

import re
from collections import Counter
from random import Random

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of each class, and bytes of a row, that the fit may use.
SAMPLE_ROWS, SAMPLE_BYTES = 2500, 32_768
#: Share of the sample that trains dictionaries; the rest fits the curve.
TRAIN_SHARE = 0.7
#: Bytes of a window and between the starts of two.
WINDOW, STEP = 48, 24
#: Bytes of the dictionaries, and the compression level.
ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 65_536, 3072, 5
#: A word is toxic content if it is so many times more frequent in toxic lines, in so many lines at least.
CONTRAST, LEAST_LINES = 60, 8
#: Letters of the word beginnings that are counted like words, for languages that inflect.
STEMS = (4, 5)
#: Bytes saved in a window that count as little and as much.
LEVELS = (3, 5)

_EDGE = re.compile(r"^\W+|\W+$")


def windows(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STEP), STEP)] if raw else []


def _dictionary(samples: list[bytes], size: int) -> bytes:
    size = max(256, min(size, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too even samples
        return b" ".join(samples)[-size:]


class Model:
    """Two dictionaries and the calibrated curve; small, and sent to the tasks as it is."""

    def __init__(self, ordinary: bytes = b"", toxic: bytes = b"", curve=None, share: float = 0.0):
        self.ordinary, self.toxic, self.curve, self.share = ordinary, toxic, curve, share
        self._pair = None

    def __getstate__(self):
        return (self.ordinary, self.toxic, self.curve, self.share)

    def __setstate__(self, state):
        self.__init__(*state)

    def differences(self, text: str | None) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        if self._pair is None:
            level = zstandard.ZstdCompressionParameters.from_level(
                LEVEL,
                write_content_size=0,
                write_checksum=0,
                write_dict_id=0,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            self._pair = [
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                    compression_params=level,
                ).compress
                for raw in (self.ordinary, self.toxic + self.ordinary)
            ]
        ordinary, both = self._pair
        return np.array([len(ordinary(w)) - len(both(w)) for w in windows(text)], np.float64)

    def features(self, text: str | None) -> list[float]:
        d = np.sort(self.differences(text))[::-1]
        if not len(d):
            return [0.0] * 5
        return [d[0], d[:3].mean(), *(np.log1p((d >= x).sum()) for x in LEVELS), np.log1p(len(d))]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.curve is None or not texts:
            return np.full(len(texts), self.share)
        mean, scale, weights = self.curve
        x = (np.array([self.features(t) for t in texts]) - mean) / scale
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ weights, -500, 500)))


def _units(word: str) -> list[str]:
    """A word and its stems, as far as it has that many letters."""
    word = _EDGE.sub("", word)
    return [word, *(word[:k] + "-" for k in STEMS if len(word) > k)]


def _words(line: str) -> set[str]:
    return {u for w in line.lower().split() for u in _units(w)}


def toxic_samples(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """What sets toxic lines apart: of each line that only toxic texts have, the words far more frequent there."""
    plain = {x for t in ordinary for x in t.split("\n")}
    own = {x for t in toxic for x in t.split("\n")} - plain
    inside, outside = Counter(), Counter()
    for x in own:
        inside.update(_words(x))
    for x in plain:
        outside.update(_words(x))
    least = max(2, min(LEAST_LINES, len(own) // 500))
    kept = {
        w
        for w, n in inside.items()
        if w and n >= least and n / len(own) >= CONTRAST * (outside[w] + 0.5) / (len(plain) + 1)
    }
    lines = (" ".join(w for w in x.lower().split() if not kept.isdisjoint(_units(w))) for x in sorted(own))
    return [x.encode("utf-8", "surrogatepass") for x in lines if x]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Logistic regression by Newton steps, lightly held back."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 0.1 * w
        bend = (z.T * (weight * p * (1 - p))) @ z + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of the labelled rows whose crc32(id) modulo 5 is not 0."""
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & (F.crc32("id") % 5 != 0))
    marks = marks.groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return Model(share=share)
    # Ids are picked from the labels alone; they are few by SAMPLE_ROWS and travel to the texts.
    pick = lambda k: marks.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    picked = F.broadcast(pick(0).union(pick(1)))
    rows = own.where(F.octet_length("text") <= SAMPLE_BYTES).join(picked, "id")
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    by_class = [sorted(r["text"] for r in rows if r["label"] == k and r["text"]) for k in (0, 1)]
    for texts in by_class:
        Random(3).shuffle(texts)
    cut = [int(len(texts) * TRAIN_SHARE) for texts in by_class]
    ordinary, toxic = (texts[:k] for texts, k in zip(by_class, cut))
    if not ordinary or not toxic:
        return Model(share=share)
    lines = sorted({x for t in ordinary for x in t.split("\n")})
    pieces = [w for x in lines for w in windows(x)]
    pieces = Random(7).sample(pieces, min(len(pieces), 100_000))
    contrast = toxic_samples(toxic, ordinary)
    model = Model(_dictionary(pieces, ORDINARY_BYTES), _dictionary(contrast, TOXIC_BYTES) if contrast else b"", None, share)
    rest = [texts[k:] or texts for texts, k in zip(by_class, cut)]
    x = np.array([model.features(t) for texts in rest for t in [*texts, ""]])
    y = np.concatenate([np.full(len(texts) + 1, k, float) for k, texts in enumerate(rest)])
    weight = np.concatenate(
        [[*np.full(len(t), counts[k] / total * len(x) / len(t)), counts[k] / total] for k, t in enumerate(rest)]
    )
    model.curve = _curve(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col`` (double): how likely ``text_col`` is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != out_col]
    where = docs.columns.index(text_col)
    keep = [docs.columns.index(c) for c in names]

    def run(batches):
        for batch in batches:
            found = sent.value.scores(batch.column(where).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(found)], [*names, out_col])

    return docs.mapInArrow(run, docs.select(*names, F.lit(0.0).alias(out_col)).schema)
