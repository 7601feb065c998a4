"""Token ids as length-delimited binary records, with a separate offset index.

A data file is a sequence of records, one for each document, in ascending (id, content) order within and across
files; file names ascend with the ids they hold.  A record is

    length    unsigned 64 bit    bytes of the payload
    check     unsigned 32 bit    masked CRC-32 of the eight length bytes
    payload
    check     unsigned 32 bit    masked CRC-32 of the payload
    line end  one byte, 0x0A

and a payload is: flags (bit 0: the id is null), bytes of one token id (2 or 4), the document's id (signed 64 bit),
the number of tokens (unsigned 32 bit), the ids.  All integers are little-endian; a mask turns a checksum right
by 15 bits and adds a constant, so that checksums of data that hold checksums stay sound.

The index is a Parquet table: shard (file name), position and size of each record, its id and number of tokens,
and ``start``, the tokens of all documents before it.  Files are written by Spark's own committed writer, so a lost
executor leaves neither a half nor a second file, and the folder may lie in any store that Spark can write.

Edge cases: a null text is empty and has only the end token; null ids come first; repeated ids and rows are
records of their own, ordered by content; an empty table writes no record.  A wrong checksum or a cut file raises.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumlens.llm.common import BROADCAST_ROWS, settled
from quorumlens.llm.tokens import load

#: Text bytes that go to one data file, about.
SHARD_BYTES = 12 << 20
#: Fixed values of the frame.
HEAD, BODY, CHECK, END = struct.Struct("<Q"), struct.Struct("<BBqI"), struct.Struct("<I"), b"\n"
MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    body = BODY.pack(doc_id is None, width, doc_id or 0, len(ids)) + ids.astype(f"<u{width}").tobytes()
    head = HEAD.pack(len(body))
    return head + CHECK.pack(masked(head)) + body + CHECK.pack(masked(body)) + END


def unframe(data, at: int = 0):
    """(position, size, id, ids) of each record from ``at`` on; raises where a frame is wrong."""
    view = memoryview(data)
    while at < len(view):
        head = bytes(view[at : at + HEAD.size])
        if at + HEAD.size + CHECK.size > len(view) or CHECK.unpack_from(view, at + HEAD.size)[0] != masked(head):
            raise ValueError(f"wrong record length at byte {at}")
        size = HEAD.unpack(head)[0]
        body = at + HEAD.size + CHECK.size
        end = body + size + CHECK.size + len(END)
        if end > len(view) or CHECK.unpack_from(view, body + size)[0] != masked(view[body : body + size]):
            raise ValueError(f"wrong record at byte {at}")
        flags, width, doc_id, n = BODY.unpack_from(view, body)
        ids = np.frombuffer(view, f"<u{width}", n, body + BODY.size)
        yield at, end - at, None if flags & 1 else doc_id, ids
        at = end


def write_records(
    docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> str:
    """Encode ``text_col``, append ``end_id`` and write data files and index below ``folder``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    # A third of all rows may share an id: ties are spread by content, equal rows by where they were read.
    tie = [F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = rows.select("*", tie[0].alias("content"), tie[1].alias("read_at")).repartitionByRange(
        shards, "doc_id", "content", "read_at"
    )
    ordered = ordered.sortWithinPartitions("doc_id", "content", "read_at").select("doc_id", "text")

    def run(batches):
        pieces = load(path)
        width = 2 if max(pieces.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        tail = np.array([end_id], "<u4")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = pieces.encode_words(batch.column(1).to_pylist())
                out = [
                    frame(i, np.concatenate([np.frombuffer(x, "<u4"), tail]), width)
                    for i, x in zip(batch.column(0).to_pylist(), found)
                ]
                # Without the line end, which the writer puts after each row.
                yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in out], pa.binary())], ["record"])

    records = ordered.mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{folder}/data")
    index_of(docs.sparkSession, folder).write.parquet(f"{folder}/index")
    return folder


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content) of each data file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index, from the data files: one row per record."""

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(1)):
                rows = [(at, size, i, len(ids)) for at, size, i, ids in unframe(content.as_buffer())]
                at, size, ids, n = zip(*rows) if rows else ((), (), (), ())
                before = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[: len(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(n), pa.string()),
                        *(pa.array(x, pa.int64()) for x in (at, size, ids, n, before)),
                    ],
                    ["shard", "position", "size", "doc_id", "n_tokens", "before"],
                )

    rows = files_of(spark, folder).mapInArrow(
        run, "shard string, position long, size long, doc_id long, n_tokens long, before long"
    )
    rows = settled(rows, "record-places")  # read twice below, the data files once
    # One row per file: its tokens, and those of the files before it.
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    first = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("tokens").over(first), F.lit(0)).alias("base"))
    return rows.join(base, "shard").select(
        "shard", "position", "size", "doc_id", "n_tokens", (F.col("base") + F.col("before")).alias("start")
    )


_ROWS = "shard string, position long, size long, doc_id long, n_tokens long, ids array<int>"


def _rows(name: str, found: list) -> pa.RecordBatch:
    at, size, doc, ids = zip(*found)
    n = [len(x) for x in ids]
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(n), pa.string()),
            *(pa.array(x, pa.int64()) for x in (at, size, doc, n)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))),
        ],
        ["shard", "position", "size", "doc_id", "n_tokens", "ids"],
    )


def scanner(batches):
    """Records of the files in Arrow batches of (shard, content), each file read from start to end."""
    for batch in batches:
        for shard, content in zip(batch.column(0), batch.column(1)):
            found = []
            for record in unframe(content.as_buffer()):
                found.append(record)
                if len(found) == 512:
                    yield _rows(shard.as_py(), found)
                    found = []
            if found:
                yield _rows(shard.as_py(), found)


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the data files with its ids; no shuffle."""
    return files_of(spark, folder).mapInArrow(scanner, _ROWS)


def read_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records that ``wanted`` rows of the index name, for shuffled reads: each is cut out and checked.

    A file is opened once for all its wanted records.  Few wanted records travel to the files; many are joined.
    """
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    places = wanted.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("position", "size"))).alias("places"))

    def run(batches):
        for batch in batches:
            for shard, content, places in zip(*batch.columns):
                data, name, each = memoryview(content.as_buffer()), shard.as_py(), places.as_py()
                for at in range(0, len(each), 512):
                    found = []
                    for p in each[at : at + 512]:
                        _, size, doc_id, ids = next(unframe(data[p["position"] : p["position"] + p["size"]]))
                        found.append((p["position"], size, doc_id, ids))
                    yield _rows(name, found)

    joined = files_of(spark, folder).join(F.broadcast(places) if few else places, "shard")
    return joined.select("shard", "content", "places").mapInArrow(run, _ROWS)
