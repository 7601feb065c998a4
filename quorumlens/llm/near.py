"""Near-duplicate documents by their word shingles: SimHash and MinHash candidates, verified on the sets by Jaccard.

Documents with one set of shingles are one class, and only classes are compared.  A class has a SimHash fingerprint (the
bits set in over half of its shingles' hashes), and classes within RADIUS bits are candidates, by the grid of ``simhash``.
A pair of similarity 0.8 differs in some ten bits, which no grid reaches at scale, so a class also has ROWS * BANDS
minima: two classes are candidates too if all minima of a band agree and the low bytes of at least LIKELY minima do.  A
pair of similarity 0.8 meets in no band with a chance of 5e-8 and has fewer likely minima with one of 8e-8.

Candidates only tell which classes may belong together: the components of their links are groups.  A group's sets then
meet in one task and are compared exactly, in one sweep that joins each class to its component.  A group with more than
SHINGLES is cut into blocks, each of which also gets the group's first set.  Where that leaves a cut group in several
parts, every two blocks of it meet as well, so nothing rests on the order or on the cuts.

Sets are moved once, or once per block of a cut group that falls apart; a large group of near copies is joined through
its first set.  Shingles are known by hashes of 64 bits.

Edge cases: blanks are ASCII white space and only A-Z is lowered; a text shorter than a shingle is one shingle; null
texts and texts without words are alike and similar to nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm import simhash
from quorumlens.llm.common import (
    block_tasks,
    components,
    hash_bitmap,
    in_bitmap,
    mixed,
    same,
    settled,
    text_key,
    whole_runs,
)
from quorumlens.llm.decontaminate import shingle_hashes

WORDS, SIMILARITY = 5, 0.8
#: Bits in which the fingerprints of two candidates may differ.
RADIUS = 4
#: Minima of a band, bands, and minima of which the low bytes agree in a candidate (0.6 of all).
ROWS, BANDS, LIKELY = 4, 32, 77
#: Classes of a band's value that one task takes at a time.
BAND_ROWS = 4096
#: Shingles of a group that one task compares at a time.
SHINGLES = 2_000_000

_FLIPS = mixed(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64))
_FACTORS = mixed(_FLIPS) | np.uint64(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text, as ascending hashes."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1])
    return np.unique(shingle_hashes(b" ".join(parts), starts, ends[min(words, len(parts)) - 1 :]))


def set_name(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes()) if len(own) else 0


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each of ROWS * BANDS orders."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 1024):
        np.minimum(least, ((own[at : at + 1024, None] ^ _FLIPS) * _FACTORS).min(0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A name for each band and its minima."""
    names = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for row in least.reshape(BANDS, ROWS).T:
        names = mixed(names ^ row)
    return names


def sketches(texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, content, name, n, fp, bands, sketch) of ``texts`` (doc_id, content, text)."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                names, sizes, fps, keys, low = [], [], [], [], []
                for text in batch.column(2).to_pylist():
                    own = shingle_set(text, words)
                    names.append(set_name(own))
                    sizes.append(len(own))
                    fps.append(simhash.majority(own))
                    least = minima(own)
                    keys.append(bands(least).tobytes() if len(own) else b"")
                    low.append(((least >> np.uint64(24)) & np.uint64(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        pa.array(np.array(names, np.uint64).view(np.int64)),
                        pa.array(sizes, pa.int32()),
                        pa.array(np.array(fps, np.uint64).view(np.int64)),
                        pa.array(keys, pa.binary()),
                        pa.array(low, pa.binary()),
                    ],
                    ["doc_id", "content", "name", "n", "fp", "bands", "sketch"],
                )

    schema = "doc_id long, content long, name long, n int, fp long, bands binary, sketch binary"
    return texts.select("doc_id", "content", "text").mapInArrow(run, schema)


def _visits(classes: DataFrame, wanted=None) -> DataFrame:
    """(band, name): the bands of each class; with ``wanted``, only bands in that bitmap, and n and sketch too."""
    light = wanted is None
    schema = "band long, name long" + ("" if light else ", n int, sketch binary")

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                batch = whole.slice(lo, 4096)
                raws = batch.column(1).to_pylist()
                band = np.frombuffer(b"".join(raws), np.int64)
                row = np.repeat(np.arange(len(raws)), [len(r) // 8 for r in raws])
                if not light:
                    some = in_bitmap(wanted.value, band)
                    band, row = band[some], row[some]
                take = pa.array(row)
                rest = [] if light else [batch.column(k).take(take) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(band), batch.column(0).take(take), *rest],
                    ["band", "name", *([] if light else ["n", "sketch"])],
                )

    return classes.select("name", "bands", "n", "sketch").mapInArrow(run, schema)


def _swept(n: int, near) -> tuple[list[int], list[int]]:
    """(child, root): links that join the components of 0 .. n - 1; ``near(k, rest)`` tells who of ``rest`` is near k."""
    rest = np.arange(n)
    child, root = [], []
    while len(rest) > 1:
        first, rest = int(rest[0]), rest[1:]
        front = [first]
        while front and len(rest):
            hit = near(front.pop(), rest)
            found, rest = rest[hit].tolist(), rest[~hit]
            child += found
            root += [first] * len(found)
            front += found
    return child, root


def _sized(n: np.ndarray, k: int, rest: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n[k], n[rest]) >= np.maximum(n[k], n[rest]) * similarity - 1e-9


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_fingerprints(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all classes (name, n, fp) whose fingerprints are within ``radius`` bits."""
    some = classes.where("n > 0").select("name", "fp")
    first = settled(some.groupBy("fp").agg(F.min("name").alias("first")), "class-fingerprints")
    equal = some.join(first, "fp").select(F.col("name").alias("a"), F.col("first").alias("b")).where("a != b")
    a, b = (first.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in ("a", "b"))
    close = simhash.links(first, radius).join(a, "a").join(b, "b")
    return equal.union(close.select("first_a", "first_b"))


def candidates(classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between classes (name, n, bands, sketch) that connect all candidates of the bands."""
    context = classes.sparkSession.sparkContext
    shared = settled(_visits(classes).groupBy(F.col("band").alias("hash")).count().where("count > 1"), "shared-bands")
    wanted = context.broadcast(hash_bitmap(shared, shared.count()))
    visits = settled(_visits(classes, wanted), "band-visits")
    likely = LIKELY if similarity >= SIMILARITY else 0  # for less alike pairs bands alone decide
    tasks = block_tasks(visits, "band", "name", BAND_ROWS)

    def run(batches):
        for task, name, n, raws in whole_runs(batches):
            sketch = np.frombuffer(b"".join(raws), np.uint8).reshape(len(raws), -1)
            cut = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
            a, b = [], []
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi - lo > 1:
                    own, size = sketch[lo:hi], n[lo:hi]

                    def near(k, rest, own=own, size=size):
                        return _sized(size, k, rest, similarity) & ((own[rest] == own[k]).sum(1) >= likely)

                    child, root = _swept(hi - lo, near)
                    a += name[lo:hi][child].tolist()
                    b += name[lo:hi][root].tolist()
            yield _pairs(a, b)

    dealt = tasks.select("task", "name", "n", "sketch").repartition("task").sortWithinPartitions("task", "name")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _compared(tasks: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join the classes of each task (task, name, part, shingles) that are similar.

    Classes of one part are known to belong together and are not compared.
    """

    def run(batches):
        for task, name, part, raws in whole_runs(batches):
            cut = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
            a, b = [], []
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi - lo < 2:
                    continue
                size = np.array([len(r) // 8 for r in raws[lo:hi]])
                ends = np.concatenate([[0], np.cumsum(size)])
                own, place = np.unique(np.frombuffer(b"".join(raws[lo:hi]), np.uint64), return_inverse=True)
                parts = part[lo:hi]

                def near(k, rest, size=size, ends=ends, place=place, own=own, parts=parts):
                    hit = parts[rest] == parts[k]
                    some = np.flatnonzero(~hit & _sized(size, k, rest, similarity))
                    if len(some):
                        mark = np.zeros(len(own), bool)
                        mark[place[ends[k] : ends[k + 1]]] = True
                        at = rest[some]
                        n = np.array([np.count_nonzero(mark[place[ends[x] : ends[x + 1]]]) for x in at.tolist()])
                        hit[some] = n * (1 + similarity) >= (size[at] + size[k]) * similarity - 1e-9
                    return hit

                child, root = _swept(hi - lo, near)
                a += name[lo:hi][child].tolist()
                b += name[lo:hi][root].tolist()
            yield _pairs(a, b)

    dealt = tasks.select("task", "name", "part", "shingles")
    dealt = dealt.repartition("task").sortWithinPartitions("task", "name")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def links(texts: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): links that connect all classes of at least ``similarity`` as their full graph would."""
    met = near_fingerprints(classes).union(candidates(classes, similarity))
    linked = components(met).select(F.col("node").alias("name"), "root")
    groups = settled(linked, "groups")
    wanted = texts.sparkSession.sparkContext.broadcast(
        hash_bitmap(groups.select(F.col("name").alias("hash")), groups.count())
    )

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                sets = [shingle_set(t, words) for t in whole.column(0).slice(at, 256).to_pylist()]
                names = np.array([set_name(s) for s in sets], np.uint64).view(np.int64)
                some = np.flatnonzero(in_bitmap(wanted.value, names)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[some]), pa.array([sets[k].tobytes() for k in some], pa.binary())],
                    ["name", "shingles"],
                )

    # A set that many texts have is folded before it meets its group.
    sets = texts.select("text").mapInArrow(run, "name long, shingles binary")
    sets = sets.groupBy("name").agg(F.first("shingles").alias("shingles"))
    members = settled(sets.join(groups, "name").withColumn("part", F.col("name")), "group-sets")
    size = F.sum(F.octet_length("shingles") / 8)
    cut = members.groupBy("root").agg(F.ceil(size / SHINGLES).cast("int").alias("blocks"), F.count("*").alias("rows"))
    cut = settled(cut.where("blocks > 1").withColumn("blocks", F.least("blocks", "rows")).drop("rows"), "cut-groups")
    dealt = members.join(cut, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    # The first of a group, after which it is named, goes to all blocks.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("name") == F.col("root"), every).otherwise(F.array(own))))
    near = settled(_compared(dealt.withColumn("task", F.xxhash64("root", "block")), similarity), "near-sets")
    if not cut.limit(1).count():
        return near
    parts = settled(components(near).select(F.col("node").alias("name"), F.col("root").alias("joined")), "parts")
    left = members.join(cut, "root").drop("part").join(parts, "name", "left")
    left = left.withColumn("part", F.coalesce("joined", "name")).drop("joined")
    several = left.groupBy("root").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b").select("root")
    # All pairs of blocks, for cut groups that have more than one part.
    met = left.join(several, "root").withColumn("x", own)
    met = met.withColumn("y", F.explode(every))
    task = F.xxhash64("root", F.least("x", "y"), F.greatest("x", "y"))
    return near.union(_compared(met.withColumn("task", task), similarity))


def keep_one(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id that is not null, then the least content hash.

    Rows that agree in id and text are one document, of which one row stays.
    """
    keyed = docs.select(*text_key(id_col, text_col), F.struct(*docs.columns).alias("row"))
    keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = keyed.select("doc_id", "content", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    found = settled(sketches(texts, words), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("first")
    same_set = [F.first(c).alias(c) for c in ("n", "fp", "bands", "sketch")]
    classes = settled(found.groupBy("name").agg(first, *same_set), "classes")
    roots = components(links(texts, classes, words, similarity)).select(F.col("node").alias("name"), "root")
    rooted = classes.select("name", "first").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.content")
    stay = keyed.join(kept, same(keyed, kept, "doc_id", "content"), "left_semi")
    return stay.groupBy("doc_id", "content").agg(F.first("row").alias("row")).select("row.*")
