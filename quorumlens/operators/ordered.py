"""Rows in one total order over range partitions, walked in several passes.

Some questions are answered by walking rows in order: which range started last, which networks touch.  A window without
a partition would walk them in one task, and one per address block leaves a hot block in one task.  Here rows are
range-partitioned by the order itself, so no task holds more than its share whatever the keys look like; a first
pass tells what each partition hands on (a few values), the driver folds these in partition order (one row per
partition, as the range partitioner's own bounds), and the next pass starts every partition from what it is handed.

The partitions are kept on the executors' disks between passes.  Their bounds belong to the shuffle, so a lost executor's
partitions are made again as they were.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: The whole IPv6 space.
LAST6 = (1 << 128) - 1


class Ordered:
    """``rows`` sorted by ``keys``; ``release`` frees the disks."""

    def __init__(self, rows: DataFrame, *keys: Column | str):
        self.rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).persist(StorageLevel.DISK_ONLY)

    def told(self, summary: Callable[[Iterable[pa.RecordBatch]], Iterator[tuple]], schema: str) -> dict[int, tuple]:
        """What ``summary`` says of each partition (one row, or none if it is empty), by its number."""
        names = [part.split()[0] for part in schema.split(", ")]

        def run(batches):
            from pyspark import TaskContext

            for row in summary(batches):
                columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), *(pa.array([v]) for v in row)]
                yield pa.RecordBatch.from_arrays(columns, ["part", *names])

        rows = self.rows.mapInArrow(run, f"part int, {schema}").collect()
        return {row[0]: tuple(row[1:]) for row in sorted(rows, key=lambda r: r[0])}

    def each(self, step: Callable, given: Callable[[int], object], schema) -> DataFrame:
        """Rows of ``step(batches, given(part))`` over all partitions."""

        def run(batches):
            from pyspark import TaskContext

            yield from step(batches, given(TaskContext.get().partitionId()))

        return self.rows.mapInArrow(run, schema)

    def release(self) -> None:
        self.rows.unpersist()


# ------------------------------------------------------------------ places


def ranked(rows: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """``rows`` with their place (from 1) by ``order`` within column ``group``; a group may be as large as the table.

    ``order`` is total over distinct rows of a group.
    """
    walk = Ordered(rows, F.col(group), *order)
    at = rows.columns.index(group)

    def cuts(batch):
        values = batch.column(at).to_pylist()
        return values, [0, *(k for k in range(1, len(values)) if values[k] != values[k - 1]), len(values)]

    def edges(batches):
        first = last = None
        n, groups = 0, 0
        for batch in batches:
            values, found = cuts(batch)
            for a, b in zip(found, found[1:]):
                if groups and values[a] == last[0]:
                    n += b - a
                else:
                    first = first or (values[a],)
                    last, n, groups = (values[a],), b - a, groups + 1
        if groups:
            yield repr(first[0]), repr(last[0]), n, groups

    before, open_group, count = {}, None, 0
    for part, (first, last, n, groups) in walk.told(edges, "first string, last string, n bigint, groups bigint").items():
        if first != open_group:
            count = 0
        before[part] = count
        count = n + (count if groups == 1 else 0)
        open_group = last

    def number(batches, start):
        count, last = start, None
        for batch in batches:
            values, found = cuts(batch)
            place = np.empty(len(values), np.int64)
            for a, b in zip(found, found[1:]):
                if last is not None and values[a] != last[0]:
                    count = 0
                place[a:b] = np.arange(count + 1, count + 1 + b - a)
                count, last = count + b - a, (values[a],)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, out])

    schema = StructType([*rows.schema.fields, StructField(out, LongType())])
    return walk.each(number, lambda part: before.get(part, 0), schema)


# ------------------------------------------------------------------ as-of


def as_of(probes: DataFrame, ranges: DataFrame, payload: list[str], out: str = "match") -> DataFrame:
    """Add struct ``out``: the ``payload`` of the range (BIGINT lo, hi) with the greatest start at or before the probe's
    ``lo``, NULL if the probe lies behind that range's end, before all ranges, or has no ``lo``.

    Ranges of equal start: the last by end and payload.  Every probe comes out once.
    """
    kind = ranges.select(F.struct(*payload).alias("p")).schema["p"].dataType
    row_type = probes.select(F.struct(*probes.columns).alias("r")).schema["r"].dataType
    tie = F.xxhash64(*[F.col(c) for c, t in probes.dtypes if not t.startswith("map")])
    left = ranges.select(
        F.col("lo").alias("_at"), F.lit(0).alias("_kind"), F.col("hi").alias("_tie"), F.col("hi").alias("_hi"),
        F.struct(*payload).alias("_payload"), F.lit(None).cast(row_type).alias("_row"),
    )
    # The hash lets many probes of one address lie in several partitions.
    right = probes.select(
        F.col("lo").alias("_at"), F.lit(1).alias("_kind"), tie.alias("_tie"), F.lit(None).cast("bigint").alias("_hi"),
        F.lit(None).cast(kind).alias("_payload"), F.struct(*probes.columns).alias("_row"),
    )
    order = [F.col("_at").asc_nulls_first(), "_kind", "_tie", "_payload"]
    walk = Ordered(left.unionByName(right), *order)

    def last_range(batches):
        last = None
        for batch in batches:
            at = np.flatnonzero(batch.column(1).to_numpy(zero_copy_only=False) == 0)
            if len(at):
                last = (batch.column(3)[at[-1]].as_py(), batch.slice(at[-1], 1).select(["_payload"]))
        if last is not None:
            yield last[0], _pack(last[1])

    found = walk.told(last_range, "hi bigint, payload binary")
    parts = list(found)

    def before(part: int):
        at = bisect.bisect_left(parts, part)
        return found[parts[at - 1]] if at else (None, None)

    def answer(batches, start):
        hi, carried = start
        carried = _unpack(carried) if carried is not None else None
        for batch in batches:
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            is_range = kinds == 0
            # Number of the batch's last range row so far; 0 is the range handed in.
            place = np.maximum.accumulate(np.where(is_range, np.arange(1, len(kinds) + 1), 0))
            payloads = batch.column(4)
            first = carried if carried is not None else pa.nulls(1, payloads.type)
            pool = pa.concat_arrays([first, payloads])
            ends = np.concatenate([[-1 if hi is None else hi], batch.column(3).fill_null(-1).to_numpy()])
            if len(kinds) and place[-1]:
                hi, carried = int(ends[place[-1]]), pool.slice(int(place[-1]), 1)
            at = batch.column(0)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            inside = known & (at.fill_null(0).to_numpy() <= ends[place])
            wanted = pa.array(np.where(inside, place, 0)[~is_range], mask=~inside[~is_range])
            rows = batch.column(5).filter(pa.array(~is_range))
            yield pa.RecordBatch.from_arrays([rows, pool.take(wanted)], ["_row", out])

    schema = StructType([StructField("_row", row_type), StructField(out, kind)])
    return walk.each(answer, before, schema).select("_row.*", out)


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


# ------------------------------------------------------------------ touching networks


def _networks(batch: pa.RecordBatch, cover: int):
    """(low, high, outermost) of each network of a batch; ``cover`` is the highest address listed before."""
    for low, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        low = int.from_bytes(low)
        high = low | ((1 << (128 - prefix)) - 1)
        outer = high > cover
        cover = high if outer else cover
        yield low, high, outer


def _runs(batches: list[pa.RecordBatch], cover: int) -> list[list[int]]:
    """[start, end] of the runs of touching outermost networks of a partition."""
    found: list[list[int]] = []
    for batch in batches:
        for low, high, outer in _networks(batch, cover):
            if outer:
                cover = high
                if found and low == found[-1][1] + 1:
                    found[-1][1] = high
                else:
                    found.append([low, high])
    return found


def _common(a: int, b: int) -> int:
    return 128 - (a ^ b).bit_length()


def _block(low: int, start: int, end: int) -> tuple[int, int]:
    """(address, prefix) of the widest aligned block around ``low`` inside [start, end]."""
    before = _common(low, start - 1) if start else -1
    behind = _common(low, end + 1) if end < LAST6 else -1
    prefix = max(before, behind) + 1
    return low >> (128 - prefix) << (128 - prefix), prefix


def _blocks(batches: list[pa.RecordBatch], cover: int, entry, first, last):
    """The block of every network of a partition, given the runs that its first and last networks belong to."""
    local = _runs(batches, cover)
    bounds = [tuple(r) for r in local]
    if bounds:
        bounds[0], bounds[-1] = first, last
    at = -1
    for batch in batches:
        found = []
        for low, high, outer in _networks(batch, cover):
            if outer:
                cover = high
                if at + 1 < len(local) and low == local[at + 1][0]:
                    at += 1
            found.append(_block(low, *(bounds[at] if at >= 0 else entry)))
        yield batch, found


def collapsed(networks: DataFrame) -> DataFrame:
    """Every IPv6 network (lo6, prefix, indicator) with the widest block that listed networks around it fill.

    (block, block_prefix, member, members): ``members`` is the number of networks in the block.  Networks that touch form
    a run [start, end]; a network's block is the widest aligned one around it inside its run, which common leading bits with
    the addresses beside the run tell at once, for all 128 lengths.  Exact; two shuffles.
    """
    walk = Ordered(networks.select("lo6", "prefix", "indicator").distinct(), "lo6", "prefix", "indicator")

    def highest(batches):
        top = -1
        for batch in batches:
            top = max([top, *(high for _, high, _ in _networks(batch, top))])
        if top >= 0:
            yield (top.to_bytes(16),)

    covers, top = {}, -1
    for part, (high,) in walk.told(highest, "high binary").items():
        covers[part] = top
        top = max(top, int.from_bytes(high))

    def ends_of(batches):
        from pyspark import TaskContext

        found = _runs(batches, covers.get(TaskContext.get().partitionId(), -1))
        if found:
            yield (len(found), *(x.to_bytes(16) for x in (*found[0], *found[-1])))

    told = walk.told(ends_of, "n bigint, a binary, b binary, c binary, d binary")
    runs, entries, open_run = {}, {}, None
    for part in covers:
        entries[part] = open_run
        if part not in told:
            continue
        n, *values = told[part]
        a, b, c, d = map(int.from_bytes, values)
        if open_run is not None and a == open_run[1] + 1:
            open_run[1] = b
            first = open_run
        else:
            first = [a, b]
        open_run = first if n == 1 else [c, d]
        runs[part] = (first, open_run)
    given = {
        part: (covers[part], *(tuple(r) if r else None for r in (entries[part], *runs.get(part, (None, None)))))
        for part in covers
    }

    def edges(batches):
        from pyspark import TaskContext

        counts: list[list] = []
        for _, found in _blocks(list(batches), *given.get(TaskContext.get().partitionId(), (-1, None, None, None))):
            for key in found:
                if not counts or counts[-1][0] != key:
                    # Only the first and the last block of a partition can go on elsewhere.
                    if len(counts) == 2:
                        counts.pop()
                    counts.append([key, 0])
                counts[-1][1] += 1
        if counts:
            (a, p), n = counts[0]
            (b, q), m = counts[-1]
            yield len(counts), a.to_bytes(16), p, n, b.to_bytes(16), q, m

    totals: dict[tuple, int] = {}
    edge = walk.told(edges, "n bigint, a binary, p bigint, x bigint, b binary, q bigint, y bigint")
    for n, a, p, x, b, q, y in edge.values():
        totals[a, p] = totals.get((a, p), 0) + x
        if n > 1:
            totals[b, q] = totals.get((b, q), 0) + y
    shared = {part: {(int.from_bytes(k), w): totals[k, w] for k, w in ((e[1], e[2]), (e[4], e[5]))} for part, e in edge.items()}

    nothing = (-1, None, None, None)

    def finish(batches, state):
        held = list(batches)
        own: dict[tuple, int] = {}
        for _, found in _blocks(held, *state[0]):
            for key in found:
                own[key] = own.get(key, 0) + 1
        own.update(state[1])
        for batch, found in _blocks(held, *state[0]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k.to_bytes(16) for k, _ in found], pa.binary()),
                    pa.array([w for _, w in found], pa.int32()),
                    batch.column(2),
                    pa.array([own[key] for key in found], pa.int64()),
                ],
                ["block", "block_prefix", "member", "members"],
            )

    state = {part: (given[part], shared.get(part, {})) for part in covers}
    state_of = lambda part: state.get(part, (nothing, {}))
    return walk.each(finish, state_of, "block binary, block_prefix int, member string, members bigint")
