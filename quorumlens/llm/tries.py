"""A prefix trie of conversations by vertical bitmaps: which conversations share how many first turns, and what it saves.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start with it.

Conversations are range-partitioned by id, and each task cuts its sorted rows into shards of whole conversations (at most
SHARD_TURNS turns, unless one conversation has more).  In a shard every (position, turn) has a bitset of conversations.
The trie is walked depth first: the bitset of a node is intersected with the posting of its lowest member's next turn,
which gives a child; that child's members are taken off, and so on until none is left.  Popcounts are member counts, and members
that have no further turn are the node's end list.  A shard is an interval of ids, so end lists of one node in several
shards follow each other.

Shards meet by node: a node's key is a chained 128-bit digest of its turns, as the walk goes down.  Counts add up.
What counts distinct nodes below a node adds up too once every node has one owner, its smallest member: a second step
gives each shard the owners of its nodes, and sums over a node's subtree (a range of the walk's order) count owned nodes.
No node gathers its members; hot nodes bring one row a shard.

Edge cases: turns without a conversation id belong to no conversation and are left out; null roles and texts are
empty; equal turn numbers stand in order of role and text; repeated rows are turns of their own; a conversation without turns
is a member of the root; an empty table has no nodes.  Other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlens.llm.common import settled

#: Turns and conversations of a shard.
SHARD_TURNS, SHARD_ROWS = 32_768, 4_096
#: The textless root's key.
ROOT = bytes(16)

_LOCAL = (
    "shard long, place long, key binary, depth int, first long, n long, size long, n_ends long, ends binary, first_end long"
)
_NAMES = [f.split()[0] for f in _LOCAL.split(", ")]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, size): turns in order from 1, each as a digest of role and text, and its text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    written = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    digest = F.substring(F.unhex(F.sha2(written, 256)), 1, 16)
    # Texts end here: what is sorted and shuffled from now on are digests and sizes.  Ties need role and text.
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select(
        "conv_id", F.row_number().over(order).alias("pos"), digest.alias("turn"), F.char_length("text").cast("long").alias("size")
    )


def rebuilt(turns: DataFrame, donor: Column, taken: Column, most: int) -> DataFrame:
    """Conversations whose first turns are those of another one: the first ``taken`` (at most ``most``) turns of conversation
    ``donor`` (all if it has fewer, none if it is absent), then the own turns after the first ``taken``.

    ``turns`` is a written table as of ``ordered_turns``; ``donor`` and ``taken`` are expressions over conv_id.  The result
    has one more row a conversation, with pos 0 and no turn.
    """
    convs = turns.select("conv_id").distinct().select("conv_id", donor.alias("donor"), taken.cast("int").alias("taken"))
    heads = turns.where(F.col("pos") <= most).groupBy(F.col("conv_id").alias("donor")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn", "size"))).alias("head")
    )
    asked = convs.join(heads, "donor", "left")
    head = F.slice("head", F.lit(1), F.greatest(F.col("taken"), F.lit(0)))
    asked = settled(asked.select("conv_id", "taken", F.coalesce(head, F.array().cast(_HEAD)).alias("head")), "heads")
    start = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("size")))
    first = asked.select("conv_id", F.inline(F.concat(start.cast(_HEAD), "head")))
    own = turns.join(asked.select("conv_id", "taken", F.size("head").alias("got")), "conv_id").where("pos > taken")
    return first.union(own.select("conv_id", F.expr("pos - taken + got"), "turn", "size"))


_HEAD = "array<struct<pos:int,turn:binary,size:bigint>>"


class Shard:
    """Vertical bitmaps of some conversations in ascending id: a bitset for every (position, turn) and for every length."""

    def __init__(self, ids: list[int], turns: list[list[bytes]], sizes: list[list[int]]):
        self.ids, self.turns, self.sizes = ids, turns, sizes
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ending: dict[int, int] = {}
        for k, own in enumerate(turns):
            bit = 1 << k
            for at in enumerate(own):
                self.postings[at] = self.postings.get(at, 0) | bit
            self.ending[len(own)] = self.ending.get(len(own), 0) | bit

    def nodes(self):
        """Rows of _LOCAL in depth-first order."""
        place, shard = 0, self.ids[0]
        todo = [(ROOT, 0, (1 << len(self.ids)) - 1)]
        while todo:
            key, depth, members = todo.pop()
            low = (members & -members).bit_length() - 1
            ends = members & self.ending.get(depth, 0)
            listed = self.listed(ends)
            yield (
                shard,
                place,
                key,
                depth,
                self.ids[low],
                members.bit_count(),
                self.sizes[low][depth - 1] if depth else 0,
                ends.bit_count(),
                ",".join(map(str, listed)).encode() if listed else None,
                listed[0] if listed else None,
            )
            place += 1
            left = members & ~ends
            while left:
                turn = self.turns[(left & -left).bit_length() - 1][depth]
                child = left & self.postings[depth, turn]
                left &= ~child
                todo.append((hashlib.blake2b(key + turn, digest_size=16).digest(), depth + 1, child))

    def listed(self, bits: int) -> list[int]:
        out = []
        while bits:
            out.append(self.ids[(bits & -bits).bit_length() - 1])
            bits &= bits - 1
        return out


def _shards(batches, most_rows: int, most_turns: int):
    """Shards of rows (conv_id, pos, turn, size) sorted by conv_id and pos."""
    ids: list[int] = []
    turns: list[list[bytes]] = []
    sizes: list[list[int]] = []
    held = 0
    for batch in batches:
        for conv, pos, turn, size in zip(*(c.to_pylist() for c in batch.columns)):
            if pos == 0:
                if ids and (held >= most_turns or len(ids) >= most_rows):
                    yield Shard(ids, turns, sizes)
                    ids, turns, sizes, held = [], [], [], 0
                ids.append(conv)
                turns.append([])
                sizes.append([])
            else:
                turns[-1].append(turn)
                sizes[-1].append(size)
                held += 1
    if ids:
        yield Shard(ids, turns, sizes)


def _batches(rows, types: list[pa.DataType], names: list[str], size: int = 8_192):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


_LONG, _BIN = pa.int64(), pa.binary()
_LOCAL_TYPES = [_LONG, _LONG, _BIN, pa.int32(), _LONG, _LONG, _LONG, _LONG, _BIN, _LONG]


def local_nodes(turns: DataFrame, shard_rows: int = SHARD_ROWS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every shard (_LOCAL) of conversations (conv_id, pos, turn, size)."""

    def walk(batches):
        for shard in _shards(batches, shard_rows, shard_turns):
            yield from _batches(shard.nodes(), _LOCAL_TYPES, _NAMES)

    rows = turns.select("conv_id", "pos", "turn", "size").repartitionByRange("conv_id")
    return rows.sortWithinPartitions("conv_id", "pos").mapInArrow(walk, _LOCAL)


def _summed(batches):
    """Per local node what its shard adds to the node: rows (shard, place, key, depth, n, size, first, owner, childless)."""
    for rows in _whole_shards(batches):
        at = {name: k for k, name in enumerate(rows.schema.names)}
        col = lambda c: rows.column(at[c]).to_numpy(zero_copy_only=False)
        depth, n, size, owner = (col(c).astype(np.int64) for c in ("depth", "n", "size", "owner"))
        owned = (col("first") == owner).astype(np.int64)
        count = len(depth)
        # In depth-first order a subtree ends before the next node that is not deeper.
        parent, end = np.full(count, -1, np.int64), np.full(count, count, np.int64)
        stack: list[int] = []
        for k, d in enumerate(depth.tolist()):
            while len(stack) > d:
                end[stack.pop()] = k
            if stack:
                parent[k] = stack[-1]
            stack.append(k)
        over = lambda x: (lambda c: c[end] - c[:-1])(np.concatenate([[0], np.cumsum(x)]))
        leaves = over(owned * col("childless").astype(np.int64))
        saved = over(n * size - owned * size)
        children = np.bincount(parent[1:], owned[1:], count).astype(np.int64)
        above = np.where(parent >= 0, owner[parent], 0)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(at["key"]),
                pa.array(depth.astype(np.int32)),
                pa.array(owner),
                pa.array(above, mask=parent < 0),
                *(pa.array(x) for x in (n, children, leaves, saved)),
            ],
            ["key", "depth", "owner", "above", "n", "children", "leaves", "saved"],
        )


def _whole_shards(batches):
    """One Arrow batch a shard; rows stand in order of (shard, place)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and shards[a] != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            last = shards[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _digests(batches):
    """(key, ends_sha256) of rows (key, ends) that stand in order of key and ids: a stream, whatever the length of a list."""

    def rows():
        last = state = None
        for batch in batches:
            for key, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    if last is not None:
                        yield last, state.hexdigest()
                    last, state = key, hashlib.sha256(ends)
                else:
                    state.update(b"," + ends)
        if last is not None:
            yield last, state.hexdigest()

    yield from _batches(rows(), [_BIN, pa.string()], ["key", "ends_sha256"])


def trie(turns: DataFrame, shard_rows: int = SHARD_ROWS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of conversations (conv_id, pos, turn, size), one row of pos 0 in each.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  A node's turns
    are the first ``depth`` turns of conversation ``conv_id``.
    """
    local = settled(local_nodes(turns, shard_rows, shard_turns), "local-nodes")
    owners = local.groupBy("key").agg(F.min("first").alias("owner"), (F.sum("n") == F.sum("n_ends")).alias("childless"))
    told = local.select("shard", "place", "key", "depth", "first", "n", "size").join(owners, "key")
    told = told.select("shard", "place", "key", "depth", "first", "n", "size", "owner", "childless")
    sums = told.repartition("shard").sortWithinPartitions("shard", "place").mapInArrow(
        _summed, "key binary, depth int, owner long, above long, n long, children long, leaves long, saved long"
    )
    nodes = sums.groupBy("key").agg(
        F.min("owner").alias("conv_id"),
        F.min("depth").cast("long").alias("depth"),
        F.min("above").alias("parent_conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    # A list that lies in one shard is whole there; others are hashed in order of their shards.
    ends = local.where("n_ends > 0").select("key", "first_end", "ends")
    hashed = ends.repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends")
    hashed = hashed.mapInArrow(_digests, "key binary, ends_sha256 string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(hashed, "key", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
