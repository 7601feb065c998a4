"""What the operators of this subpackage share: tables in the shared folder, checked broadcasts, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.session import checkpoint_dir

#: Largest bitmap that a job broadcasts (bits), whatever the size of the corpus.
BITMAP_BITS = 29
#: Rows of a side that may be broadcast after they have been counted.
BROADCAST_ROWS = 20_000


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark)}/llm-{kind}-{uuid.uuid4().hex}"


def settled(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work done once, and kept if an executor is lost."""
    folder = shared_folder(df.sparkSession, kind)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_key(id_col: str, text_col: str) -> list[Column]:
    """(id, content hash): rows that agree in both are one document given twice and are treated alike."""
    return [F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("content")]


def same(left: DataFrame, right: DataFrame, *cols: str) -> Column:
    """Equality of ``cols`` on both sides in which null equals null."""
    on = F.lit(True)
    for c in cols:
        on = on & left[c].eqNullSafe(right[c])
    return on


def counted_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows; else as it is, and the join shuffles.

    Hand in a written table: the rows are counted here.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links ``a`` - ``b`` lead to, for every node with a link.

    Rounds of contraction: each node points at its smallest neighbour, pointers are doubled once, and the
    links between the nodes pointed at go on.  A round at least halves the nodes that still have links, so the
    number of rounds is logarithmic.  Each round is a written table; nothing is gathered on the driver.
    """
    pair = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = settled(pair.where(F.col("a") != F.col("b")).distinct(), "links")
    labels = None
    while left.limit(1).count():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        near = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to"))
        up = near.select(F.col("node").alias("to"), F.col("to").alias("top"))
        step = settled(near.join(up, "to").select("node", F.col("top").alias("to")), "step")
        if labels is None:
            labels = step.select("node", F.col("to").alias("root"))
        else:
            moved = step.select(F.col("node").alias("root"), F.col("to").alias("next"))
            labels = settled(
                labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels"
            )
        a = step.select(F.col("node").alias("a"), F.col("to").alias("pa"))
        b = step.select(F.col("node").alias("b"), F.col("to").alias("pb"))
        went = left.join(a, "a").join(b, "b").where(F.col("pa") != F.col("pb"))
        left = settled(
            went.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links"
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def hash_bitmap(hashes: DataFrame, rows: int, max_bits: int = BITMAP_BITS) -> np.ndarray:
    """One bit per slot for the 64-bit ``hash`` column: sixteen slots a row, and never over ``2 ** max_bits``.

    A set bit means "may be in"; an unset one means "is not in".  Beyond the bound more slots are shared and
    more rows pass; nothing is lost.  Slices of the bitmap are made on the executors and joined here.
    """
    bits = min(max_bits, max(16, int(rows * 16).bit_length()))
    slices = 64
    width = (1 << bits) // slices

    def build(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = slot_of(batch.column(0).to_numpy(zero_copy_only=False), bits)
            for s in np.unique(slot // width):
                own = parts.setdefault(int(s), np.zeros(width, np.uint8))
                own[slot[slot // width == s] % width] = 1
        if parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(parts), pa.int32()),
                    pa.array([np.packbits(x).tobytes() for x in parts.values()], pa.binary()),
                ],
                ["slice", "bits"],
            )

    by_slice = hashes.select("hash").repartition(
        slices, F.shiftrightunsigned(F.col("hash"), 64 - 6).cast("int")
    )
    whole = np.zeros((1 << bits) // 8, np.uint8)
    built = by_slice.mapInArrow(build, "slice int, bits binary")
    # A small bitmap comes in one job, a large one slice by slice.
    for row in built.collect() if bits <= 26 else built.toLocalIterator():
        at = row["slice"] * width // 8
        whole[at : at + width // 8] |= np.frombuffer(row["bits"], np.uint8)
    return whole


def slot_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap slot of 64-bit hashes: their highest bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` may be in."""
    slot = slot_of(hashes, (len(bitmap) * 8).bit_length() - 1)
    return (bitmap[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser over 64-bit words: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def block_tasks(rows: DataFrame, key: str, spread: str, limit: int) -> DataFrame:
    """``rows`` with ``task``: all rows of a ``key`` meet in one task, or, where a key has over ``limit`` rows, every
    two blocks of it meet in a task of at most that size.  ``spread`` (a long) deals the rows of a key to blocks.

    Hand in a written table: rows are counted by key first.
    """
    half = max(1, limit // 2)
    full = settled(rows.groupBy(key).count().where(F.col("count") > limit), "full-keys")
    blocks = counted_broadcast(full.select(key, F.ceil(F.col("count") / half).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64(spread), F.coalesce("blocks", F.lit(1))).cast("int")
    # Block x meets every block y in the task (min, max); a key that is not cut is the task (0, 0).
    met = rows.join(blocks, key, "left").withColumn("x", own)
    met = met.withColumn("y", F.explode(F.expr("sequence(0, coalesce(blocks, 1) - 1)")))
    task = F.xxhash64(key, F.least("x", "y"), F.greatest("x", "y")).alias("task")
    return met.select(task, *[c for c in rows.columns if c != key])


def whole_runs(batches):
    """Numpy columns of Arrow batches sorted by the first column, cut only between two values of it."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last value's rows may go on
        if last:
            held.append([c[:last] for c in columns])
            yield [np.concatenate(v) for v in zip(*held)]
            held = []
        held.append([c[last:] for c in columns])
    if held:
        yield [np.concatenate(v) for v in zip(*held)]
