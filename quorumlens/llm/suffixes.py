"""Exact removal of repeated substrings through a prefix-free parse.

Texts are UTF-8 bytes.  A rolling hash over GRAM bytes triggers the parse: each start of a SIZE-byte string belongs to
the trigger with the least hash among the SPAN positions after it, and a phrase is a stretch of starts with one
trigger.  Equal strings have equal triggers inside them, so the parse cuts repeats alike wherever they stand.

A start is ordered, in the order of suffixes, by what it has of its phrase (dictionary side) and then by what the
parse goes on with.  Only the first SIZE bytes of that order matter here, so two starts are the same string if their
phrase suffix and the beginning of the parse suffix after their trigger are the same; ranks are never needed, and
equality is all that is computed:

1. The block of BLOCK bytes from a trigger on lies inside every string of its phrase.  Blocks are counted over the
   corpus.  A start is left out if any block inside its string occurs only once: nearly all text without repeats.
2. What is left of each phrase, with the bytes its strings cover, is an entry of the dictionary.  The first occurrence
   of an entry stays and all others go with all their starts.
3. Where a block has several entries, as at the ends of repeats, the starts of one occurrence of each are compared.

Counts and minima are Spark's, so a passage in a third of all documents is folded before it is shuffled; whether an
occurrence is the first is told by a bitmap of bounded size, and only rows that it cannot tell are joined.  A block's
distinct entries meet in one task: repeated text around the same bytes, in all ways in which it goes on.  Hashes have
64 bits.

Edge cases: matches lie within a document; null texts are empty; texts under SIZE bytes lose nothing; SIZE is at least 32; documents are
ordered by (id, content) with null ids first; rows that agree in id and text are one document given twice and are
cut alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import hash_bitmap, in_bitmap, mixed, same, settled, text_key, whole_runs

#: Bytes of a removed string at least.
SIZE = 100
#: Bytes of a trigger; SPAN and BLOCK follow from the size: SPAN + BLOCK = size and SPAN + GRAM - 1 <= size.
GRAM = 8

_BASE = 0x9E3779B97F4A7C15
_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
_CACHE: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _CACHE[name] = np.multiply.accumulate(steps)
    return _CACHE["up"][:n], _CACHE["down"][:n]


class Parse:
    """The phrases of one text: triggers and the starts (first, last) that belong to each."""

    def __init__(self, raw: bytes, size: int):
        self.raw, self.size = raw, size
        self.span = max(1, min(size * 64 // 100, size - GRAM + 1))
        n = len(raw)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[np.frombuffer(raw, np.uint8)] * up[:-1], out=self.sums[1:])
        starts = n - size + 1
        at = np.arange(n - GRAM + 1)
        gram = self.hashes(at, at + GRAM)
        # The hash in the upper half, the position in the lower: the last of equal hashes is the least.
        best = (gram & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
        reach = 1
        while reach < self.span:
            step = min(reach, self.span - reach)
            best = np.minimum(best[:-step], best[step:])
            reach += step
        trigger = (np.uint64(0xFFFFFFFF) - (best & np.uint64(0xFFFFFFFF))).astype(np.int64)
        # Blocks near the end, whose windows no start of a string follows, count as occurrences too.
        all_of = trigger[np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))]
        all_of = all_of[all_of + (size - self.span) <= n]
        self.blocks = self.hashes(all_of, all_of + (size - self.span))
        trigger = trigger[:starts]
        self.first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        self.last = np.concatenate([self.first[1:] - 1, [starts - 1]])
        self.trigger = trigger[self.first]
        self.block = self.hashes(self.trigger, self.trigger + (size - self.span))

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.down[a])

    def entries(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first start, last start) of what is left when starts with a single block inside are left out."""
        starts = int(self.last[-1]) + 1
        one = ~repeated
        # A trigger is fixed by the string if its window is inside; its block must be inside as well.
        inside = max(0, self.size - self.span - GRAM + 1)
        lo = np.maximum(np.maximum(self.first[one] - inside, self.trigger[one] - self.span), 0)
        change = np.zeros(starts + 1, np.int32)
        np.add.at(change, lo, 1)
        np.add.at(change, self.last[one] + 1, -1)
        left = np.cumsum(change[:-1]) == 0
        own = np.flatnonzero(left)
        if not len(own):
            return own, own, own
        phrase = np.searchsorted(self.first, own, "right") - 1
        head = np.flatnonzero(np.concatenate([[True], phrase[1:] != phrase[:-1]]))
        tail = np.concatenate([head[1:] - 1, [len(own) - 1]])
        return phrase[head], own[head], own[tail]


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def block_counts(texts: DataFrame, size: int) -> DataFrame:
    """(hash, n): occurrences of each block in the one text column of ``texts``."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                found = [
                    Parse(raw, size).blocks
                    for raw in map(_raw, whole.column(0).slice(at, 1024).to_pylist())
                    if len(raw) >= size
                ]
                if found:
                    h, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["hash", "n"])

    return texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _phrases(texts: DataFrame, size: int, repeated, rows, schema: str) -> DataFrame:
    """``rows(ids, contents, raws, parses, entries)`` for batches of ``texts`` (doc_id, content, text)."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                docs = []
                for i, c, text in zip(*(whole.column(k).slice(at, 256).to_pylist() for k in range(3))):
                    raw = _raw(text)
                    if len(raw) >= size:
                        parse = Parse(raw, size)
                        found = parse.entries(in_bitmap(repeated.value, parse.block.view(np.int64)))
                        if len(found[0]):
                            docs.append((i, c, parse, *found))
                if docs:
                    yield rows(docs)

    return texts.select("doc_id", "content", "text").mapInArrow(run, schema)


def _names(doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, entry, place) of each entry of a document: 64-bit names of its block, its content and this occurrence."""
    i, c, parse, phrase, lo, hi = doc
    shape = ((parse.trigger[phrase] - lo) << 16 | (hi - lo)).astype(np.uint64)
    entry = mixed(parse.hashes(lo, hi + parse.size) ^ mixed(shape + np.uint64(1)))
    own = mixed(np.array([i or 0, c, i is None], np.int64).view(np.uint64))
    place = mixed(own[0] ^ mixed(own[1] ^ mixed(own[2] ^ lo.astype(np.uint64))))
    return parse.block[phrase], entry, mixed(entry ^ place)


def _columns(docs, *extra) -> list[pa.Array]:
    n = [len(d[3]) for d in docs]
    names = [np.concatenate(x) for x in zip(*map(_names, docs))]
    return [
        *(pa.array(x.view(np.int64)) for x in names),
        pa.array([d[0] for d, k in zip(docs, n) for _ in range(k)], pa.int64()),
        pa.array(np.repeat(np.array([d[1] for d in docs], np.int64), n)),
        pa.array(np.concatenate([d[4] for d in docs]).astype(np.int32)),
        pa.array(np.concatenate([d[5] for d in docs]).astype(np.int32)),
    ]


_FIELDS = ["block", "entry", "place", "doc_id", "content", "lo", "hi"]
_ENTRY = "block long, entry long, place long, doc_id long, content long, lo int, hi int"
_RANGE = "doc_id long, content long, lo int, hi int"


def _merged(batches):
    """Ranges of starts of one document that follow each other, as one; batches of (doc_id, content, lo, hi)."""
    for batch in batches:
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        content, lo, hi = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        if len(lo):
            new = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1]) | (content[1:] != content[:-1])
            new |= lo[1:] != hi[:-1] + 1
            head = np.flatnonzero(np.concatenate([[True], new]))
            tail = np.concatenate([head[1:] - 1, [len(lo) - 1]])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(head)) for k in (0, 1, 2)), pa.array(hi[tail])],
                ["doc_id", "content", "lo", "hi"],
            )


def _later_starts(entries: DataFrame, size: int) -> DataFrame:
    """Ranges of starts in ``entries`` (with bytes) of which another entry of the block has an earlier one."""

    def run(batches):
        for block, place, content, lo, raws, ids, null in whole_runs(batches):
            # Copies of a row have the same places: one of them is compared.
            key = (block, place, null, ids, content, lo)
            keep = np.concatenate([[True], np.any([v[1:] != v[:-1] for v in key], axis=0)])
            block, content, lo, raws, ids, null = (v[keep] for v in (block, content, lo, raws, ids, null))
            run_of = np.unique(block, return_inverse=True)[1]
            size_of = np.fromiter(map(len, raws), np.int64, len(raws))
            ends = np.concatenate([[0], np.cumsum(size_of)])
            raw = b"".join(raws)
            up, down = _powers(len(raw) + 1)
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_CODES[np.frombuffer(raw, np.uint8)] * up[:-1], out=sums[1:])
            n = size_of - size + 1
            row = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            a = ends[:-1][row] + offset
            string = mixed((sums[a + size] - sums[a]) * down[a])
            start = lo[row] + offset
            # First of equal strings in the order (id, content, start); nulls are first.
            order = np.lexsort((start, content[row], ids[row], ~null[row], string, run_of[row]))
            same_as = (string[order][1:] == string[order][:-1]) & (run_of[row][order][1:] == run_of[row][order][:-1])
            later = np.sort(order[1:][same_as])
            kept = pa.array(np.where(null, 0, ids)[row[later]], pa.int64(), mask=null[row[later]])
            yield from _merged(
                [
                    pa.RecordBatch.from_arrays(
                        [
                            kept,
                            pa.array(content[row[later]]),
                            pa.array(start[later].astype(np.int32)),
                            pa.array(start[later].astype(np.int32)),
                        ],
                        ["doc_id", "content", "lo", "hi"],
                    )
                ]
            )

    dealt = entries.select(
        "block",
        "place",
        "content",
        "lo",
        "bytes",
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("null"),
    )
    dealt = dealt.repartition("block").sortWithinPartitions("block", "place", "null", "doc_id", "content", "lo")
    return dealt.mapInArrow(run, _RANGE)


def repeated_starts(texts: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, content, lo, hi): ranges of starts whose string of ``size`` bytes also starts earlier."""
    context = texts.sparkSession.sparkContext
    counts = settled(block_counts(texts.select("text"), size).where("n > 1").select("hash"), "blocks")
    repeated = context.broadcast(hash_bitmap(counts, counts.count()))

    def light(docs):
        return pa.RecordBatch.from_arrays(_columns(docs), _FIELDS)

    entries = settled(_phrases(texts, size, repeated, light, _ENTRY), "entries")
    first = F.min(F.struct("doc_id", "content", "lo", "place")).alias("first")
    dictionary = settled(
        entries.groupBy("block", "entry").agg(first, F.count("*").alias("n")).select("block", "entry", "first.place", "n"),
        "dictionary",
    )
    # Occurrences after the first of their entry go, with all their starts.  Most are told by the bitmap alone.
    repeats = dictionary.where("n > 1").select("block", "entry", F.col("place").alias("first"))
    firsts = context.broadcast(hash_bitmap(dictionary.select(F.col("place").alias("hash")), dictionary.count()))

    def certain(batches):
        for batch in batches:
            away = ~in_bitmap(firsts.value, batch.column(0).to_numpy(zero_copy_only=False))
            some = batch.filter(pa.array(away))
            yield pa.RecordBatch.from_arrays(some.columns[1:], ["doc_id", "content", "lo", "hi"])

    def unsure(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(firsts.value, batch.column(2).to_numpy(zero_copy_only=False))))

    sure = entries.select("place", "doc_id", "content", "lo", "hi").mapInArrow(
        lambda batches: _merged(certain(batches)), _RANGE
    )
    rest = entries.mapInArrow(unsure, _ENTRY).join(repeats, ["block", "entry"]).where("place != first")
    # Entries that share a block are compared start by start, each entry once.
    several = settled(dictionary.groupBy("block").count().where(F.col("count") > 1), "several")
    chosen = settled(dictionary.join(several, "block").select(F.col("place").alias("hash")), "chosen")
    wanted = context.broadcast(hash_bitmap(chosen, chosen.count()))

    def with_bytes(docs):
        columns = _columns(docs)
        keep = np.flatnonzero(in_bitmap(wanted.value, columns[2].to_numpy()))
        raws = [d[2].raw[a : b + size] for d in docs for a, b in zip(d[4].tolist(), d[5].tolist())]
        take = pa.array(keep)
        return pa.RecordBatch.from_arrays(
            [*(c.take(take) for c in columns), pa.array([raws[k] for k in keep], pa.binary())], [*_FIELDS, "bytes"]
        )

    compared = _phrases(texts, size, repeated, with_bytes, f"{_ENTRY}, bytes binary")
    later = _later_starts(compared, size)
    return sure.union(rest.select("doc_id", "content", "lo", "hi")).union(later)


def dedup_substrings(
    docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", out_col: str = "spans"
) -> DataFrame:
    """``docs`` with ``out_col``: array of (begin, end), the maximal byte ranges to remove, ascending."""
    names = [c for c in docs.columns if c != out_col]
    kind = "array<struct<begin:int,end:int>>"
    keyed = docs.select(*text_key(id_col, text_col), F.struct(*names).alias("row"))
    # Rows of one id are told apart by 64 bits of their content.
    keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = keyed.select("doc_id", "content", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    ranges = repeated_starts(texts, size).groupBy("doc_id", "content").agg(
        F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("ranges")
    )
    joined = keyed.join(ranges, same(keyed, ranges, "doc_id", "content"), "left")
    flat = joined.select(*(F.col(f"row.`{c}`").alias(c) for c in names), F.col("ranges").alias("__ranges"))
    schema = docs.select(*names, F.expr(f"cast(array() as {kind})").alias(out_col)).schema
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            out = []
            for own in batch.column(len(names)):
                spans: list[dict] = []
                if own.is_valid:
                    lo = own.values.field(0).to_numpy(zero_copy_only=False)
                    end = np.maximum.accumulate(own.values.field(1).to_numpy(zero_copy_only=False) + size)
                    gap = np.flatnonzero(np.concatenate([[True], lo[1:] > end[:-1]]))
                    last = np.concatenate([gap[1:] - 1, [len(lo) - 1]])
                    spans = [{"begin": a, "end": b} for a, b in zip(lo[gap].tolist(), end[last].tolist())]
                out.append(spans)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(out, span)], [*names, out_col]
            )

    return flat.mapInArrow(run, schema)


def kept_bytes(text: str | None, spans: list[dict]) -> bytes:
    """What is left of a text without its spans; may end within a character."""
    raw, at, out = _raw(text), 0, []
    for s in spans:
        out.append(raw[at : s["begin"]])
        at = s["end"]
    return b"".join([*out, raw[at:]])
