"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks, so that a passage that documents share is cut
alike in all of them.  Chunk hashes are counted over the whole corpus; the chunks that save most work (a
bounded number, ``reused``) are encoded once and handed to all tasks.  A document is then put together from the
ids of reused chunks and of the text between them, and every join is repaired: text around it is encoded again,
in growing pieces, until a cut of the joined text agrees with a cut inside the next chunk.  From such a cut on
both encodings are the same, so ids are exactly those of the whole text.

Chunks outside that bound are encoded where they stand; only work is at stake, never a result.  No text is
shuffled: what moves are chunk hashes and the texts of the reused chunks.

Edge cases: a null text is empty and has no ids; a repeated row gives a repeated result; a null or repeated id
is carried along; special tokens inside a text are encoded as the library does and never lie in a chunk.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.tokens import BYTE_LEVEL, load

#: Bytes of a chunk: at least, about (a power of two more), at most.
CHUNK_LEAST, CHUNK_EXTRA_BITS, CHUNK_MOST = 128, 8, 2048
#: Chunks that are encoded once for all tasks; with CHUNK_MOST this bounds what is broadcast.
REUSED = 16_384
#: Characters that are encoded again at a join at first; doubled until the cuts agree.
REPAIR = 48

_GEAR = np.random.default_rng(20240131).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of ``data``, on character borders."""
    n = len(data)
    if n <= CHUNK_LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h = _GEAR[raw]
    for k in (1, 2, 4, 8, 16):  # sum of the last 32 gears, each shifted by its age
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    hits = np.flatnonzero(h >> np.uint32(32 - CHUNK_EXTRA_BITS) == 0) + 1
    ends, last, i = [], 0, 0
    hits = hits.tolist()
    while n - last > CHUNK_LEAST:
        i = bisect_left(hits, last + CHUNK_LEAST, i)
        end = min(hits[i] if i < len(hits) else n, last + CHUNK_MOST, n)
        while end < n and data[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        last = end
    if last < n:
        ends.append(n)
    return ends


def parts(text: str, special: dict[str, int]):
    """Stretches of ordinary text and special tokens, as the library separates them: (text, None) or (None, id)."""
    while text:
        found = min(((text.find(s), -len(s), s) for s in special if s in text), default=None)
        if found is None:
            yield text, None
            return
        at, _, s = found
        if at:
            yield text[:at], None
        yield None, special[s]
        text = text[at + len(s) :]


class Assembler:
    """Encodes texts of one task; ``known`` has the reused chunks: hash -> (text, piece starts, token starts, ids)."""

    def __init__(self, path: str, known: dict):
        self.pieces, self.known = load(path), known

    def encode(self, text: str) -> bytes:
        pieces = self.pieces
        if pieces.plain(text):
            return self.joined(text)
        if not any(s in text for s in pieces.special):
            return pieces.by_library(text)
        out = []
        for part, token in parts(text, pieces.special):
            if part is None:
                out.append(int(token).to_bytes(4, "little"))
            else:
                out.append(self.joined(part) if pieces.plain(part) else pieces.by_library(part))
        return b"".join(out)

    def joined(self, text: str) -> bytes:
        get, find = self.pieces.__getitem__, BYTE_LEVEL.findall
        if not self.known:
            return b"".join(map(get, find(text)))
        data = text.encode()
        out, carry, plain_from, at = [], "", 0, 0
        for end in cuts(data):
            chunk = self.known.get(xxhash.xxh64_intdigest(data[at:end]))
            if chunk is not None and chunk[0] == data[at:end]:
                if plain_from < at:
                    carry = self.run(carry + data[plain_from:at].decode(), out)
                carry = self.reuse(carry, chunk, out)
                plain_from = end
            at = end
        rest = carry + data[plain_from:].decode()
        out.extend(map(get, find(rest)))
        return b"".join(out)

    def run(self, text: str, out: list) -> str:
        """Encode all pieces but the last, which what follows may change; return that one."""
        found = BYTE_LEVEL.findall(text)
        out.extend(map(self.pieces.__getitem__, found[:-1]))
        return found[-1] if found else ""

    def reuse(self, carry: str, chunk: tuple, out: list) -> str:
        """Join a reused chunk to the text before it; return the last piece, which is open again."""
        raw, starts, tokens, ids = chunk
        text = raw.decode()
        k, size = 0, REPAIR
        if carry:
            while True:
                window = BYTE_LEVEL.findall(carry + text[:size])
                end, k = 0, None
                for n, piece in enumerate(window[:-1], 1):
                    end += len(piece)
                    at = end - len(carry)
                    if at >= 0:
                        i = bisect_left(starts, at)
                        if i < len(starts) and starts[i] == at:
                            out.extend(map(self.pieces.__getitem__, window[:n]))
                            k = i
                            break
                if k is not None:
                    break
                if size >= len(text):  # no cut agrees: the chunk is encoded again as a whole
                    return self.run(carry + text, out)
                size *= 2
        last = len(starts) - 1
        out.append(ids[4 * tokens[k] : 4 * tokens[last]])
        return text[starts[last] :]


def chunk_entry(path: str, raw: bytes) -> tuple:
    pieces = load(path)
    found = BYTE_LEVEL.findall(raw.decode())
    ids = [pieces[p] for p in found]
    starts = [0, *np.cumsum([len(p) for p in found])[:-1].tolist()]
    tokens = [0, *np.cumsum([len(x) // 4 for x in ids])[:-1].tolist()]
    return raw, starts, tokens, b"".join(ids)


def _chunks(text: str, path: str):
    pieces = load(path)
    for part, _ in parts(text, pieces.special):
        if part and pieces.plain(part):
            data, at = part.encode(), 0
            for end in cuts(data):
                yield data[at:end]
                at = end


def reused_chunks(docs: DataFrame, path: str, reused: int = REUSED) -> dict:
    """The chunks whose repeats hold most text, each encoded once on the executors."""
    spark = docs.sparkSession

    def hashes(batches):
        for batch in batches:
            seen: dict[int, list[int]] = {}
            for text in batch.column(0).to_pylist():
                for raw in _chunks(text, path):
                    seen.setdefault(xxhash.xxh64_intdigest(raw), [0, len(raw)])[0] += 1
            rows = np.array(list(seen), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array([x[0] for x in seen.values()], pa.int64()),
                    pa.array([x[1] for x in seen.values()], pa.int64()),
                ],
                ["hash", "n", "size"],
            )

    found = docs.mapInArrow(hashes, "hash long, n long, size long").groupBy("hash")
    repeats = found.agg(F.sum("n").alias("n"), F.max("size").alias("size")).where("n > 1")
    best = repeats.orderBy(F.desc(F.expr("(n - 1) * size")), "hash").select("hash").limit(reused).collect()
    if not best:
        return {}
    wanted = spark.sparkContext.broadcast({r["hash"] & 0xFFFFFFFFFFFFFFFF for r in best})

    def texts(batches):
        given: set[int] = set()
        for batch in batches:
            out: dict[int, bytes] = {}
            for text in batch.column(0).to_pylist():
                for raw in _chunks(text, path):
                    h = xxhash.xxh64_intdigest(raw)
                    if h in wanted.value and h not in given:
                        given.add(h)
                        out[h] = raw
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(list(out), np.uint64).view(np.int64)), pa.array(list(out.values()), pa.binary())],
                ["hash", "raw"],
            )

    def encode(batches):
        for batch in batches:
            rows = [chunk_entry(path, raw) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[1] for x in rows], pa.list_(pa.int32())),
                    pa.array([x[2] for x in rows], pa.list_(pa.int32())),
                    pa.array([x[3] for x in rows], pa.binary()),
                ],
                ["hash", "raw", "starts", "tokens", "ids"],
            )

    once = docs.mapInArrow(texts, "hash long, raw binary").groupBy("hash").agg(F.min("raw").alias("raw"))
    rows = once.mapInArrow(encode, "hash long, raw binary, starts array<int>, tokens array<int>, ids binary").collect()
    return {
        r["hash"] & 0xFFFFFFFFFFFFFFFF: (bytes(r["raw"]), array("i", r["starts"]), array("i", r["tokens"]), bytes(r["ids"]))
        for r in rows
    }


def encoder(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", reused: int = REUSED):
    """(function over Arrow batches, schema) that adds ``ids_col`` to ``docs``; steps can be chained in one worker."""
    text = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(reused_chunks(text, path, reused))
    rest = [c for c in docs.columns if c != ids_col]
    where = docs.columns.index(text_col)
    keep = [docs.columns.index(c) for c in rest]

    def run(batches):
        worker = Assembler(path, known.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):  # ids of few texts at a time are held
                batch = whole.slice(at, 128)
                found = [worker.encode(t or "") for t in batch.column(where).to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                flat = np.frombuffer(b"".join(found), "<i4")
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), ids], [*rest, ids_col])

    return run, docs.select(*rest, F.lit(None).cast("array<int>").alias(ids_col)).schema


def decoder(path: str, ids_col: str = "ids", out_col: str = "decoded"):
    """A function over Arrow batches that adds ``out_col``, the text that ``ids_col`` stands for."""

    def run(batches):
        get = load(path).byte_table().__getitem__
        for batch in batches:
            texts = []
            for ids in batch.column(batch.schema.names.index(ids_col)):
                flat = ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []
                texts.append(b"".join(map(get, flat)).decode("utf-8", "replace"))
            rest = [c for c in batch.schema.names if c != out_col]
            columns = [batch.column(batch.schema.names.index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*rest, out_col])

    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", reused: int = REUSED) -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>), the ids of ``text_col``; a column of that name is replaced."""
    return docs.mapInArrow(*encoder(docs, path, text_col, ids_col, reused))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the text that ``ids_col`` stands for, special tokens included; null ids give ''."""
    rest = [c for c in df.columns if c != out_col]
    return df.mapInArrow(decoder(path, ids_col, out_col), df.select(*rest, F.lit("").alias(out_col)).schema)
