"""A Merkle manifest of a table: one root for all rows, proofs for any of them, few levels kept.

Every row is a leaf: the SHA-256 (lowercase hex) of its fields, each written as ``-`` if null, else as its UTF-8 byte
count, ``:`` and its text.  The leaves of a group (a source) ascend by id; while several nodes remain, every ``ARITY``
consecutive ones become the hash of their hex digests.  The nodes left over, one a group, are the leaves of one more
tree in the order of the groups (null first, then bytewise), whose last node is the root.

Checkpoint and recompute: of each tree the levels 0, STRIDE, 2 * STRIDE, ... and its last node are written; the levels
between are not.  A node of level ``k`` and its ARITY ** STRIDE stored descendants of level ``k - STRIDE`` are an aligned
subtree: one key of one shuffle, of bounded size whatever the size of a group.  ``prove`` goes down from the root: each
subtree is read, its missing levels are made again from the stored ones, every node gets the siblings on its way to the
subtree's top and behind them those of the subtree's own top, and the missing levels are dropped.  The siblings above a
leaf's subtree are carried once a subtree, not once a leaf.

Positions: rows are range-partitioned by (group, id, leaf); each partition numbers its rows, and the counts of the
partitions before it (one row a partition and group) move them on.  No group needs to fit in a task.

Edge cases: a null group is a group; null ids come first in theirs; rows of equal id stand in order of their leaf, so equal
rows (equal leaves) are interchangeable and each keeps a place of its own; a lone leaf is its group's node and a lone
group's node is the root; an empty table has no root and no proofs.  Other columns of the table play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlens.llm.common import counted_broadcast, shared_folder

ARITY, STRIDE = 16, 2
BLOCK = ARITY**STRIDE
#: Digits of a digest.
WIDE = 64


@dataclass
class Manifest:
    """The written tables of a manifest.

    ``leaves``: tree (number of the group in order), idx (place in the group), size (leaves of the group), digest, group,
    id and the kept columns.  ``levels``: the stored levels of the groups' trees (tree, idx, size, digest), level 0 first;
    ``top``: the same for the tree over the groups.  ``nodes``: the groups' nodes (tree, digest).  ``groups``: their number.
    ``root``: the root's digest, None if there are no rows.
    """

    folder: str
    leaves: DataFrame
    levels: list[DataFrame]
    nodes: DataFrame
    top: list[DataFrame]
    groups: int
    root: str | None


def field(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    written = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(written)


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _placed(rows: DataFrame, group: str, order: list[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` by (group, order) with ``part`` and ``own`` (place in the group within the part), and what that adds up to.

    The second table has group, part, ``before`` (rows of the group in earlier parts) and size (rows of the group).  The sorted
    rows are written with their part, so that places are counted over rows that stay as they are.
    """
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = rows.columns.index(group)

    def number(batches):
        from pyspark import TaskContext

        part, last, count = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            own = np.empty(batch.num_rows, np.int64)
            for k, value in enumerate(batch.column(at).to_pylist()):
                if value != last:
                    last, count = value, 0
                own[k] = count
                count += 1
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, pa.array(own)], [*batch.schema.names, "part", "own"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = _written(ordered.mapInArrow(number, f"{kinds}, part int, own long"), folder)
    counts = placed.groupBy(group, "part").agg(F.count("*").alias("rows"))
    mine = Window.partitionBy(group)  # one row a part
    before = F.sum("rows").over(mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return placed, counts.select(
        group, "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(mine).alias("size")
    )


def _hashed(members: Column) -> Column:
    """Hash of the digests of (idx, digest) rows in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(members)), lambda m: m["digest"]), "")
    return F.sha2(joined.cast("binary"), 256)


def _grow(leaves: DataFrame, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of the trees whose level 0 is ``leaves`` (tree, idx, size, digest), and (tree, digest) of their last nodes.

    ``size`` is the number of leaves of the tree and stays; level ``k`` of it has ceil(size / ARITY ** k) nodes.
    """
    levels, done = [leaves], leaves.where("size = 1").select("tree", "digest")
    deep = leaves.agg(F.max("size")).first()[0] or 0
    width = 1  # leaves below a node of the present level
    while deep > width:
        rows = levels[-1].where(F.col("size") > width)
        # All shuffles of a step are one: blocks are whole in a task, and so are the runs of a block.
        step = rows.select(
            "tree",
            "size",
            F.expr(f"idx div {BLOCK}").alias("block"),
            F.expr(f"idx div {ARITY}").alias("run"),
            F.struct("idx", "digest").alias("node"),
        ).repartition("tree", "block")
        runs = step.groupBy("tree", "block", "run").agg(F.first("size").alias("size"), _hashed(F.col("node")).alias("digest"))
        member = F.when(F.col("size") > width * ARITY, F.struct(F.col("run").alias("idx"), "digest"))
        above = runs.groupBy("tree", "block").agg(
            F.first("size").alias("size"), F.first("digest").alias("only"), _hashed(member).alias("many")
        )
        # A tree whose runs were one has its last node there; a level further up would hash a lone node.
        digest = F.when(F.col("size") > width * ARITY, F.col("many")).otherwise(F.col("only"))
        made = above.select("tree", F.col("block").alias("idx"), "size", digest.alias("digest"))
        made = _written(made, f"{folder}/level={len(levels) * STRIDE}")
        width *= BLOCK
        done = done.union(made.where(F.col("size") <= width).select("tree", "digest"))
        levels.append(made)
    return levels, _written(done, f"{folder}/last")


def build(
    docs: DataFrame, leaf: Column, group_col: str, id_col: str, keep: dict[str, Column] | None = None
) -> Manifest:
    """Write the manifest of ``docs``; ``keep`` names further columns that stay with the leaves."""
    folder = shared_folder(docs.sparkSession, "manifest")
    more = [c.alias(f"k_{name}") for name, c in (keep or {}).items()]
    rows = docs.select(F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf.alias("digest"), *more)
    placed, counts = _placed(rows, "group", ["id", "digest"], f"{folder}/rows")
    counts = _written(counts, f"{folder}/counts")
    # Groups are numbered in their order; trees go by these numbers.
    groups = counts.select(F.lit(0).alias("all"), "group").distinct()
    ranked, parts = _placed(groups, "all", ["group"], f"{folder}/groups")
    trees = ranked.join(parts, ["all", "part"]).select(
        F.col("group").alias("named"), (F.col("before") + F.col("own")).alias("tree")
    )
    trees = _written(trees, f"{folder}/trees")
    bases = counts.join(trees, counts["group"].eqNullSafe(trees["named"])).select(
        "named", F.col("part").alias("of"), "tree", "before", "size"
    )
    on = placed["group"].eqNullSafe(bases["named"]) & (placed["part"] == bases["of"])
    leaves = placed.join(bases, on).select(
        "tree", (F.col("before") + F.col("own")).alias("idx"), "size", "digest", "group", "id", *[f"k_{k}" for k in keep or {}]
    )
    leaves = _written(leaves, f"{folder}/leaves")
    levels, last = _grow(leaves.select("tree", "idx", "size", "digest"), f"{folder}/trees-of-groups")
    n = last.count()
    top = last.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n).cast("long").alias("size"), "digest"
    )
    top, root = _grow(top, f"{folder}/top-tree")
    found = root.first()
    return Manifest(folder, leaves, levels, last, top, n, found["digest"] if found else None)


def shape_of(idx: int, size: int) -> list[tuple[int, int]]:
    """(place in its run, nodes of the run) of the nodes above leaf ``idx`` of a tree with ``size`` leaves."""
    out = []
    while size > 1:
        out.append((idx % ARITY, min(ARITY, size - idx // ARITY * ARITY)))
        idx, size = idx // ARITY, -(-size // ARITY)
    return out


def fold(digest: str, siblings: str, shape: list[tuple[int, int]]) -> str:
    """The node that ``digest`` and its siblings, level by level and left to right, lead to."""
    at = 0
    for place, n in shape:
        cut, end = at + place * WIDE, at + (n - 1) * WIDE
        digest = hashlib.sha256(f"{siblings[at:cut]}{digest}{siblings[cut:end]}".encode()).hexdigest()
        at = end
    return digest


def subtree_siblings(digests: list[str], levels: int) -> list[str]:
    """For every node of an aligned subtree, in order: its siblings on each of ``levels`` levels, one after another.

    The levels above the given one are made here and dropped once their siblings are written.
    """
    paths, below = [""] * len(digests), 1
    for _ in range(levels):
        above = []
        for a in range(0, len(digests), ARITY):
            run = digests[a : a + ARITY]
            for k in range(len(run)):
                others = "".join(run[:k] + run[k + 1 :])
                for i in range((a + k) * below, min((a + k + 1) * below, len(paths))):
                    paths[i] += others
            above.append(hashlib.sha256("".join(run).encode()).hexdigest())
        digests, below = above, below * ARITY
    return paths


def _walk(level: DataFrame, k: int, above: DataFrame | None, consume: Callable, schema: str) -> DataFrame:
    """Rows of a stored level ``k`` (tree, idx, size, digest, ...) with ``path``, the siblings up to the top of the trees.

    ``above`` (tree, block, path, note) has what stands above the top node of each subtree, one row a subtree.  It goes
    through the shuffle as one more row of its subtree.  ``consume`` gets Arrow batches of the level's columns, path and note.
    """
    own = level.columns
    names = [*own, "block", "path", "note"]
    rows = level.withColumns(
        {"block": F.expr(f"idx div {BLOCK}"), "path": F.lit(None).cast("string"), "note": F.lit(None).cast("string")}
    )
    if above is not None:
        rows = rows.unionByName(above.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
    rows = rows.select(*names).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    width = ARITY**k

    def extend(batches):
        for block in _blocks(batches, names.index("tree"), names.index("block")):
            tail = note = None
            if block.column("idx")[0].as_py() < 0:
                tail, note = block.column("path")[0].as_py(), block.column("note")[0].as_py()
                block = block.slice(1)
            remain = -(-block.column("size")[0].as_py() // width)
            paths = subtree_siblings(block.column("digest").to_pylist(), min(STRIDE, len(shape_of(0, remain))))
            if tail:
                paths = [p + tail for p in paths]
            columns = [*block.select(own).columns, pa.array(paths, pa.string())]
            columns.append(pa.array([note] * len(paths), pa.string()))
            yield from pa.table(columns, [*own, "path", "note"]).combine_chunks().to_batches()

    return rows.mapInArrow(lambda batches: consume(extend(batches)), schema)


def _blocks(batches, *keys: int):
    """Tables of the rows that agree in the key columns (longs); these rows stand together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = values[:, a].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _paths(levels: list[DataFrame]) -> DataFrame | None:
    """(tree, block, path, note) for the subtrees of level 0 that are not whole trees: down the stored levels from the top."""
    above = None
    for j in range(len(levels) - 1, 0, -1):
        # A tree's last node has nothing above it.
        own = levels[j].where(F.col("size") > ARITY ** (j * STRIDE))
        above = _walk(own, j * STRIDE, above, _of_blocks, "tree long, block long, path string, note string")
    return above


def _of_blocks(batches):
    for batch in batches:
        yield batch.select(["tree", "idx", "path", "note"]).rename_columns(["tree", "block", "path", "note"])


def prove(manifest: Manifest, consume: Callable, schema: str) -> DataFrame:
    """Every leaf with its proof, handed to ``consume`` as Arrow batches in the task that makes them.

    Columns: tree, idx, size, digest, group, id, the kept columns (``k_`` before the name), path (the digests of the
    siblings, level by level up to the root) and note (the group's node).  The tree's number is its leaf in the last tree, so
    ``fold(digest, path, shape_of(idx, size) + shape_of(tree, manifest.groups))`` is the root.
    """
    folder = shared_folder(manifest.leaves.sparkSession, "proofs")
    upper = _walk(manifest.top[0], 0, _paths(manifest.top), _of_groups, "tree long, upper string")
    upper = _written(upper.join(manifest.nodes, "tree"), folder)
    blocks = manifest.leaves.where(F.col("idx") % BLOCK == 0).select("tree", F.expr(f"idx div {BLOCK}").alias("block"))
    lower = _paths(manifest.levels)
    if lower is None:
        blocks = blocks.withColumn("path", F.lit(""))
    else:
        blocks = blocks.join(lower.drop("note"), ["tree", "block"], "left")
    above = blocks.join(counted_broadcast(upper), "tree").select(
        "tree",
        "block",
        F.concat(F.coalesce("path", F.lit("")), "upper").alias("path"),
        F.col("digest").alias("note"),
    )
    return _walk(manifest.leaves, 0, above, consume, schema)


def _of_groups(batches):
    for batch in batches:
        yield batch.select(["idx", "path"]).rename_columns(["tree", "upper"])
