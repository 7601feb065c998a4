"""SimHash near-duplicates through segment popcounts.

Fingerprints are cut into two-bit segments, and a fingerprint is mapped to the vector of its segments' bit counts.
The Manhattan distance of two such vectors never exceeds the number of bits in which the fingerprints differ, so a
range join of the vectors finds every link.  The vector is split into groups of segments with a distance allowed
in each, chosen so that a pair within the radius is within the allowance of some group (the allowances plus one
each add up to radius + 1): on each group the join is a grid lookup with cells of one count.  A fingerprint lies
in its own cell and visits the cells within the allowance; whoever meets in a cell is compared bit by bit.

Only distinct fingerprints are joined.  A cell that holds many is cut into blocks, and pairs of blocks are tasks of
their own; within one, members are joined to their component in one sweep and a member gives one link to it, so
neither a large group of near copies nor a full cell yields all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import block_tasks, components, same, settled, text_key, whole_runs

BITS, SEGMENT = 64, 2
#: Rows of a cell that one task takes at a time; fuller cells are cut into blocks of half of it.
CELL_ROWS = 8192


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes ``h``."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        some = h[at : at + (1 << 16)]
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """Bits set in over half of the shingles' XXH64; 0 for a text without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    one = xxhash.xxh64_intdigest
    h = np.fromiter((one(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)
    return majority(h)


def fingerprints(docs: DataFrame, words: int, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col`` (long, the 64 bits).  Blanks are ASCII white space and only A-Z is lowered.

    A null text has no words; a text with fewer words than a shingle is one shingle; without words it is 0.
    """
    rest = [c for c in docs.columns if c != out_col]
    where = rest.index(text_col)

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.column(where).to_pylist()]
            bits = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, bits], [*rest, out_col])

    return docs.select(*rest).mapInArrow(run, docs.select(*rest, F.lit(0).cast("long").alias(out_col)).schema)


def plan(radius: int) -> list[tuple[int, int, int]]:
    """(first segment, end, distance allowed): groups in which a pair within ``radius`` must be near in one."""
    allowed = [1] * ((radius + 1) // 2) + [0] * ((radius + 1) % 2)
    cuts = np.linspace(0, BITS // SEGMENT, len(allowed) + 1).round().astype(int)
    return [(int(a), int(b), r) for a, b, r in zip(cuts, cuts[1:], allowed)]


def cells(fps: np.ndarray, groups: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``fps``, cell): the own cell on each group, and the cells one count above it where allowed.

    Of two that differ by one count, the lower one visits the other's cell, so they meet there.
    """
    shifts = np.arange(0, BITS, SEGMENT, dtype=np.uint64)
    counts = np.bitwise_count((fps[:, None] >> shifts) & np.uint64((1 << SEGMENT) - 1)).astype(np.uint64)
    at, out = [], []
    for g, (a, b, r) in enumerate(groups):
        weights = np.uint64(SEGMENT + 1) ** np.arange(b - a, dtype=np.uint64)
        own = (counts[:, a:b] * weights).sum(1, dtype=np.uint64) + (np.uint64(g) << np.uint64(56))
        at.append(np.arange(len(fps)))
        out.append(own)
        if r:
            row, seg = np.nonzero(counts[:, a:b] < SEGMENT)
            at.append(row)
            out.append(own[row] + weights[seg])
    return np.concatenate(at), np.concatenate(out).view(np.int64)


def touched(task: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Which rows are within ``radius`` of another row of their task; ``task`` is sorted, ``fp`` unsigned."""
    n = len(task)
    begin = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
    end = np.concatenate([begin[1:], [n]])
    hit = np.zeros(n, bool)
    small = end - begin <= 256
    stop = np.repeat(np.where(small, end, begin), end - begin)
    at, d = np.flatnonzero(stop - np.arange(n) > 1), 1
    while len(at):  # rows and their d-th neighbour, for all small tasks at once
        near = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        hit[near] = hit[near + d] = True
        d += 1
        at = at[stop[at] - at > d]
    for a, b in zip(begin[~small], end[~small]):
        for lo in range(a, b, 256):
            close = np.bitwise_count(fp[lo : min(lo + 256, b), None] ^ fp[None, a:b]) <= radius
            hit[lo : lo + 256][: b - lo] |= close.sum(1) > 1  # itself and another
    return hit


def near_pairs(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each component of ``members`` (distinct, ascending) to its first: at most one a member."""
    rest = members
    child, root = [], []
    while len(rest) > 1:
        first, rest = rest[0], rest[1:]
        front = np.array([first], np.uint64)
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for f in front[:1024]:
                hit |= np.bitwise_count(rest ^ f) <= radius
            found, rest = rest[hit], rest[~hit]
            child.append(found)
            root.append(np.full(len(found), first, np.uint64))
            front = np.concatenate([front[1024:], found])
    if not child:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(child), np.concatenate(root)


def _visits(fps: DataFrame, groups) -> DataFrame:
    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                fp = whole.column(0).slice(lo, 4096).to_numpy(zero_copy_only=False)
                at, cell = cells(fp.view(np.uint64), groups)
                yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(cell)], ["fp", "cell"])

    return fps.select("fp").mapInArrow(run, "fp long, cell long")


def links(fps: DataFrame, radius: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links that connect all of ``fp`` (distinct longs) within ``radius`` bits as their full graph would."""
    visits = settled(_visits(fps, plan(radius)), "cells")
    tasks = block_tasks(visits, "cell", "fp", cell_rows)

    def run(batches):
        for task, fp in whole_runs(batches):
            fp = fp.view(np.uint64)
            hit = touched(task, fp, radius)
            task, fp = task[hit], fp[hit]
            found = [near_pairs(np.unique(x), radius) for x in np.split(fp, np.flatnonzero(np.diff(task)) + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v).view(np.int64)) for v in zip(*found)], ["a", "b"]
            )

    dealt = tasks.select("task", "fp").repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that links within ``radius`` bits lead to.

    One row per row of ``docs``.  Null ids are linked like others and never name a component, unless nothing else
    is in it (then null).  Equal texts, and all texts without words, have equal fingerprints and are linked.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = settled(fingerprints(rows, words).select("doc_id", "fingerprint"), "fingerprints")
    classes = settled(
        found.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "classes"
    )
    roots = components(links(classes, radius)).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, words: int = 5, radius: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id that is not null, then the least content hash.

    Rows that agree in id and text are one document, of which one row stays.
    """
    keyed = docs.select(*text_key(id_col, text_col), F.struct(*docs.columns).alias("row"))
    keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = keyed.select("doc_id", "content", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    found = settled(fingerprints(texts, words).select("doc_id", "content", "fingerprint"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("first")
    classes = settled(found.groupBy(F.col("fingerprint").alias("fp")).agg(first), "classes")
    roots = components(links(classes, radius)).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.content")
    stay = keyed.join(kept, same(keyed, kept, "doc_id", "content"), "left_semi")
    return stay.groupBy("doc_id", "content").agg(F.first("row").alias("row")).select("row.*")
