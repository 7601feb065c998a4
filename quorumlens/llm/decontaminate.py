"""Benchmark decontamination: containment search over a whole index of the items' shingles, verified on the strings.

Every distinct shingle of every test item is indexed by its hash, and every shingle of a text is looked up: a text's
hits are counted by item, and an item of which enough hashes are found is a candidate.  No shingle is sampled, so a
contained item is always a candidate, whatever its size and wherever its pieces stand.  Candidates are then held
against the text: the share of the item's distinct shingles that the text contains, compared as strings.

Items travel to the texts, never texts to items: blocks of items of bounded size are broadcast one after another
(most benchmarks are one block), and no text is shuffled.

Edge cases: null and empty items match nothing; a text or item shorter than a shingle is one shingle; null and empty
texts match nothing; repeated items each match; blanks are ASCII white space; letters are compared in lower case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import mixed

WORDS, THRESHOLD = 5, 0.8
#: Text bytes of the items that are broadcast at a time.
BLOCK_BYTES = 16 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def shingled(text: str | None, words: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Normalised text and the starts and ends of its shingles in it."""
    parts = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not parts:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    return b" ".join(parts), starts[:n], ends[min(words, len(parts)) - 1 :]


def shingle_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each shingle, from running sums over the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_CODES[np.frombuffer(joined, np.uint8)] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


class Items:
    """A block of test items as a task searches them."""

    def __init__(self, rows: list[tuple[int | None, str | None]], words: int):
        self.words, self.ids, self.shingles = words, [], []
        hashes = []
        for item, text in rows:
            joined, starts, ends = shingled(text, words)
            if not len(starts):
                continue
            self.shingles.append({joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())})
            hashes.append(np.unique(shingle_hashes(joined, starts, ends)))
            self.ids.append(item)
        size = np.array([len(h) for h in hashes], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(flat, kind="stable")
        # Items by hash: those of hash k are owner[begin[k] : begin[k + 1]].
        self.owner = np.repeat(np.arange(len(size)), size)[order]
        self.hash, begin = np.unique(flat[order], return_index=True)
        self.begin = np.append(begin, len(flat))
        self.total = np.array([len(s) for s in self.shingles], np.int64)
        self.twins = self.total - size  # shingles of an item with one hash
        bits = min(26, max(20, (16 * len(self.hash)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.bits = np.zeros(1 << bits, bool)
        self.bits[(self.hash >> self.shift).astype(np.int64)] = True

    def candidates(self, h: np.ndarray, threshold: float) -> np.ndarray:
        """The items of which a text with the hashes ``h`` may hold the share ``threshold``."""
        some = np.unique(h[self.bits[(h >> self.shift).astype(np.int64)]])
        at = np.searchsorted(self.hash, some)
        at = at[self.hash[np.minimum(at, len(self.hash) - 1)] == some] if len(some) else at
        if not len(at):
            return at
        n = self.begin[at + 1] - self.begin[at]
        rows = np.arange(n.sum()) + np.repeat(self.begin[at] - np.cumsum(n) + n, n)
        item, shared = np.unique(self.owner[rows], return_counts=True)
        return item[shared + self.twins[item] >= threshold * self.total[item] - 1e-9]

    def search(self, text: str | None, threshold: float) -> list[tuple[int | None, int, int]]:
        """(item, shingles shared, shingles of the item) of each item contained in ``text``."""
        joined, starts, ends = shingled(text, self.words)
        if not len(starts):
            return []
        found = self.candidates(shingle_hashes(joined, starts, ends), threshold)
        if not len(found):
            return []
        own = {joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())}
        out = []
        for k in found.tolist():
            shared = len(own & self.shingles[k])
            if shared >= threshold * len(self.shingles[k]) - 1e-9:
                out.append((self.ids[k], shared, len(self.shingles[k])))
        return out


def search(
    docs: DataFrame,
    items: DataFrame,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    out_col: str = "matches",
) -> DataFrame:
    """``docs`` with ``out_col``: array of (item_id, shared, of) for the items that the text contains."""
    rows = items.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    names = [c for c in docs.columns if c != out_col]
    where = names.index(text_col)
    kind = "array<struct<item_id:long,shared:int,of:int>>"
    found = docs.select(*names, F.expr(f"cast(array() as {kind})").alias(out_col))
    match = pa.list_(pa.struct([("item_id", pa.int64()), ("shared", pa.int32()), ("of", pa.int32())]))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = docs.sparkSession.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in own], words))

        def run(batches, block=block):
            for batch in batches:
                out = []
                for text, before in zip(batch.column(where).to_pylist(), batch.column(len(names)).to_pylist()):
                    new = [dict(zip(("item_id", "shared", "of"), m)) for m in block.value.search(text, threshold)]
                    out.append([*before, *new])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(out, match)], [*names, out_col]
                )

        found = found.mapInArrow(run, found.schema)
    return found


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text contains no item."""
    col = "__matches"
    return search(docs, items, out_col=col, **options).where(F.size(col) == 0).select(*docs.columns)
