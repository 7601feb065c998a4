"""Embedding near-duplicates over an inverted multi-index.

Vectors are cut in halves, and each half gets a codebook of its own, fitted on a bounded sample; pairs of codes form
a grid of cells.  Every vector lies in one cell and visits the cells nearest to it in the order of the sum of its
distances to the two codes (the multi-sequence order), as many as are needed to meet a partner at the threshold with
the target recall.  That number is measured: sample vectors get partners at exactly the threshold, the least similar
that count, and the depth at which either meets the other is taken at the target quantile.  Real partners are closer.
Whoever meets is compared in double precision.

Equal vectors are folded into one row with a count before anything else.  Cells are packed into slots of bounded size,
and a cell beyond that is cut into several; a slot's vectors sit in a task while visitors stream past.  A task adds up
link counts and reduces links to one per vector and component, so a large group of near copies yields no pairs.

Edge cases: null and empty vectors, and those with a null or non-finite component or without length, link with
nothing; vectors of different lengths do not link; repeated ids are vectors of their own; a null id never names a
component unless no other id is in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import components, settled

THRESHOLD, TARGET_RECALL = 0.9, 0.98
#: Vectors and bytes that fit the codebooks, and those that measure the depth.
SAMPLE_ROWS, SAMPLE_BYTES, PROBES = 20_000, 64 << 20, 600
#: Codes of a half: about the square root of the vectors over eight, between these.
CODES_LEAST, CODES_MOST = 4, 256
#: Vectors of a slot, and visitors compared at a time.
SLOT_ROWS, VISITORS = 4096, 2048


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # first, so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)


def codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm with starts drawn by distance; at most ``k`` codes."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    codes = x[rng.integers(len(x), size=1)]
    near = _distances(x, codes)[:, 0]
    while len(codes) < k:
        p = np.maximum(near, 0)
        new = x[rng.choice(len(x), p=p / p.sum())] if p.sum() > 0 else x[rng.integers(len(x))]
        codes = np.vstack([codes, new])
        near = np.minimum(near, _distances(x, codes[-1:])[:, 0])
    for _ in range(8):
        own = _distances(x, codes).argmin(1)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(codes))
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return codes


class Grid:
    """Two codebooks and the depth of the traversal."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float, recall: float):
        unit = _unit(sample)
        self.half = unit.shape[1] // 2 or unit.shape[1]
        self.books = [codebook(h, codes, n) for n, h in enumerate(self.halves(unit))]
        self.depth = 1
        rng = np.random.default_rng(5)
        probe = unit[rng.permutation(len(unit))[:PROBES]]
        other = rng.standard_normal(probe.shape)
        other -= (other * probe).sum(1)[:, None] * probe
        length = np.linalg.norm(other, axis=1)
        if (length > 1e-9).all():
            far = threshold * probe + np.sqrt(max(0.0, 1 - threshold**2)) * other / length[:, None]
            ranks = np.minimum(self._rank(probe, self.cell(far)), self._rank(far, self.cell(probe)))
            self.depth = int(np.quantile(ranks, recall, method="higher")) + 1

    def halves(self, x: np.ndarray):
        first, second = x[:, : self.half], x[:, self.half :]
        return first, second if second.shape[1] else np.zeros((len(x), 1))

    def parts(self, x: np.ndarray):
        return [_distances(h, b) for h, b in zip(self.halves(x), self.books)]

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = (d.argmin(1) for d in self.parts(x))
        return a * len(self.books[1]) + b

    def _rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), 100):
            a, b = self.parts(x[at : at + 100])
            sums = (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)
            out.append((sums < sums[np.arange(len(a)), cell[at : at + 100]][:, None]).sum(1))
        return np.concatenate(out)

    def visits(self, x: np.ndarray) -> np.ndarray:
        """The nearest ``depth`` cells of each vector: of sums of two sorted lists only pairs of places (p, q) with
        p * q <= depth can be among them."""
        a, b = self.parts(x)
        ka, kb = len(self.books[0]), len(self.books[1])
        depth = min(self.depth, ka * kb)
        pairs = [(p, q) for p in range(ka) for q in range(min(kb, depth // (p + 1)))]
        p, q = np.array(pairs).T
        oa, ob = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        rows = np.arange(len(x))[:, None]
        sums = np.take_along_axis(a, oa, 1)[:, p] + np.take_along_axis(b, ob, 1)[:, q]
        best = np.argpartition(sums, depth - 1, axis=1)[:, :depth]
        return oa[rows, p[best]] * kb + ob[rows, q[best]]


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for links a - b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


_MET = "kind int, a long, b long"


def meet(slot_rows, threshold: float):
    """Links of one slot after another from (slot, visitor, key, n, vector, own, slots) rows in that order."""

    class Members:
        def __init__(self):
            self.rows = []

        def ready(self):
            t = pa.Table.from_batches(self.rows).combine_chunks()
            self.key, self.n = (t.column(c).to_numpy() for c in ("key", "n"))
            self.unit = _unit(np.frombuffer(b"".join(t.column("vector").to_pylist()), np.float32).reshape(len(t), -1))
            lists = t.column("slots").to_pylist()
            self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            self.slot = np.array([x for v in lists for x in v], np.int64)

    def compare(m: Members, batch: pa.RecordBatch):
        key, n, own = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("key", "n", "own"))
        raw = b"".join(batch.column(batch.schema.names.index("vector")).to_pylist())
        unit = _unit(np.frombuffer(raw, np.float32).reshape(len(key), -1))
        r, c = np.nonzero(unit @ m.unit.T >= threshold)
        # A pair that meets in both its slots counts where the lesser key is the visitor.
        slots, at = np.unique(own, return_inverse=True)
        visits = np.zeros((len(m.key), len(slots)), bool)
        where = np.minimum(np.searchsorted(slots, m.slot), len(slots) - 1)
        known = slots[where] == m.slot
        visits[m.row[known], where[known]] = True
        once = (key[r] != m.key[c]) & (~visits[c, at[r]] | (key[r] < m.key[c]))
        r, c = r[once], c[once]
        if not len(r):
            return
        u = np.bincount(r, m.n[c], len(key)).astype(np.int64)
        v = np.bincount(c, n[r], len(m.key)).astype(np.int64)
        nodes, roots = _roots(key[r], m.key[c])
        kinds = [np.zeros((u > 0).sum() + (v > 0).sum(), np.int32), np.ones(len(nodes), np.int32)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(kinds)),
                pa.array(np.concatenate([key[u > 0], m.key[v > 0], nodes])),
                pa.array(np.concatenate([u[u > 0], v[v > 0], roots])),
            ],
            ["kind", "a", "b"],
        )

    slot, members, ready = None, None, False
    for whole in slot_rows:
        s = whole.column(0).to_numpy()
        visitor = whole.column(1).to_numpy()
        edge = np.flatnonzero((s[1:] != s[:-1]) | (visitor[1:] != visitor[:-1])) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(s)]):
            if a == b:
                continue
            if s[a] != slot:
                slot, members, ready = s[a], Members(), False
            if not visitor[a]:
                members.rows.append(whole.slice(a, b - a))
                continue
            if not members.rows:
                continue
            if not ready:
                members.ready()
                ready = True
            for at in range(a, b, VISITORS):
                yield from compare(members, whole.slice(at, min(VISITORS, b - at)))


def _linked(classes: DataFrame, size: int, threshold: float, recall: float) -> DataFrame:
    """(kind, a, b) over ``classes`` (key, n, vector) of one length: 0 for b links of a, 1 for a link a - b."""
    spark = classes.sparkSession
    rows = classes.count()
    most = max(100, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * size)))
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(most).select("vector").collect()
    flat = np.frombuffer(b"".join(bytes(r["vector"]) for r in sample), np.float32).reshape(len(sample), size)
    codes = int(min(CODES_MOST, max(CODES_LEAST, np.sqrt(rows / 8))))
    grid = spark.sparkContext.broadcast(Grid(flat, codes, threshold, recall))

    def place(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(batch.num_rows, size)
                unit = _unit(x)
                seen = grid.value.visits(unit).astype(np.int32)
                ends = np.arange(len(seen) + 1, dtype=np.int32) * seen.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(grid.value.cell(unit).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(seen.ravel())),
                    ],
                    ["key", "n", "vector", "cell", "cells"],
                )

    placed = settled(
        classes.select("key", "n", "vector").mapInArrow(
            place, "key long, n long, vector binary, cell int, cells array<int>"
        ),
        "cells",
    )
    # At most CODES_MOST squared rows: full cells in order, packed into slots; a cell over the bound gets several.
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    slots: dict[int, tuple[int, int]] = {}
    slot, room = -1, 0
    for cell in sorted(counts):
        if counts[cell] > SLOT_ROWS:
            many = -(-counts[cell] // SLOT_ROWS)
            slots[cell], slot, room = (slot + 1, many), slot + many, 0
            continue
        if counts[cell] > room:
            slot, room = slot + 1, SLOT_ROWS
        slots[cell], room = (slot, 1), room - counts[cell]
    sent = spark.sparkContext.broadcast(slots)

    def deal(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                key, cell = (batch.column(k).to_numpy() for k in (0, 3))
                out: list[list] = [[] for _ in range(5)]
                for k, cells in enumerate(batch.column(4).to_pylist()):
                    first, many = sent.value[int(cell[k])]
                    own = first + int(key[k]) % many
                    all_of = set()
                    for c in {*cells, int(cell[k])}:
                        if c in sent.value:
                            a, n = sent.value[c]
                            all_of.update(range(a, a + n))
                    all_of = sorted(all_of)
                    for s, visitor in ((own, 0), *((s, 1) for s in all_of)):
                        for x, v in zip(out, (s, visitor, k, own, [] if visitor else all_of)):
                            x.append(v)
                take = pa.array(out[2])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[0], pa.int32()),
                        pa.array(out[1], pa.int32()),
                        *(batch.column(k).take(take) for k in range(3)),
                        pa.array(out[3], pa.int32()),
                        pa.array(out[4], pa.list_(pa.int32())),
                    ],
                    ["slot", "visitor", "key", "n", "vector", "own", "slots"],
                )

    dealt = placed.mapInArrow(
        deal, "slot int, visitor int, key long, n long, vector binary, own int, slots array<int>"
    )
    dealt = dealt.repartition(F.col("slot")).sortWithinPartitions("slot", "visitor")
    return dealt.mapInArrow(lambda batches: meet(batches, threshold), _MET)


def near_duplicates(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows``."""
    spark = rows.sparkSession
    own = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("v")
    )
    fine = F.expr("v is not null and forall(v, x -> x is not null and abs(x) < float('inf') and not isnan(x))")
    good = F.coalesce(fine, F.lit(False)) & F.expr("exists(v, x -> x != 0)")

    def pack(batches):
        for batch in batches:
            raw = [np.array(v, np.float32).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["vec_id", "vector"])

    # -0.0 and 0.0 are one value, so that equal vectors have equal bytes.
    plain = own.where(good).select("vec_id", F.expr("transform(v, x -> x + float(0))").alias("v"))
    vectors = settled(plain.mapInArrow(pack, "vec_id long, vector binary"), "vectors")
    keyed = vectors.withColumn("key", F.xxhash64("vector"))
    classes = settled(
        keyed.groupBy("vector").agg(F.min("key").alias("key"), F.min("vec_id").alias("least"), F.count("*").alias("n")),
        "vector-classes",
    )
    met = None
    for size in [r[0] for r in classes.select(F.octet_length("vector")).distinct().collect()]:
        few = _linked(classes.where(F.octet_length("vector") == size), size // 4, threshold, recall)
        met = few if met is None else met.union(few)
    if met is None:
        met = spark.createDataFrame([], _MET)
    met = settled(met, "met")
    partners = met.where("kind = 0").groupBy(F.col("a").alias("key")).agg(F.sum("b").alias("partners"))
    roots = components(met.where("kind = 1").select("a", "b")).select(F.col("node").alias("key"), "root")
    named = classes.drop("vector").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").join(partners, "key", "left")
    named = named.select("key", "component_id", (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    found = keyed.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = own.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
