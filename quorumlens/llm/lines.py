"""Line dedup: an exact set-similarity join that removes lines similar to an earlier one.

A line is the set of its lower-cased words.  Words are counted over the whole corpus; in each line they are ordered
by rarity (a class of their count, then their hash).  Two lines with Jaccard similarity of at least the threshold
share one of their rarest words (the prefix), so those words are the join key; a word that occurs once is no key at
all.  Lines that meet are compared by their sizes and by parity maps: each word flips one bit, so two maps differ in no
more bits than the lines differ in words.  That leaves little but similar lines; the words of those are fetched and
compared.  A line needs one earlier partner, so a task names its NAMED likeliest ones; lines of which none was similar
and which had more are the exception: they report all their candidates in a second pass.

Texts are split in tasks whenever lines are needed, by operations on whole arrays of bytes, as that costs less than to
keep words.  Prefixes come from distinct lines only, as far as bitmaps tell, and travel as arrays, one row a bucket
of words.  Counts of words are kept as one byte a slot of their hash (SLOTS); words that share a slot count as more
frequent than they are, which changes the order of words alike in all lines and so no result.  Words and lines are
known by hashes of 64 bits.

Edge cases: lines without words stay; a null text stays null; the order of lines is (id, content, line number) with
null ids first; rows that agree in id and text are one document given twice and are cut alike; a document may lose
all its lines and is then an empty text.  A removed line still removes later ones that are similar to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import hash_bitmap, in_bitmap, mixed, same, settled, text_key

THRESHOLD = 0.8
#: Counts of words are kept for 2 ** SLOTS slots of their hashes, dealt to SLICES tasks.
SLOTS, SLICES = 24, 64
#: Lines with one word in their prefixes that one task compares at a time.
WORD_ROWS = 8192
#: Prefix rows a bucket holds on average, and rows that are packed at a time.
BUCKET_ROWS, PACKED = 250_000, 200_000
#: Bytes of text that are split at a time.
CHUNK = 1 << 19
#: Candidates a task names for a line in the first pass, and how many of them are compared first.
NAMED, LIKELY = 16, 2
#: Lines of more words than this have a second parity map, and a third and fourth.
LONG, LONGER = 56, 128

_BLOCK = 1 << 14
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.multiply.accumulate(np.full(_BLOCK, 0x9E3779B97F4A7C15, np.uint64))
_INVERSE = np.multiply.accumulate(np.full(_BLOCK, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True


def _plain(texts: pa.Array) -> pa.Array:
    """Texts in which only characters below U+0100 occur as they are; others lower-cased, single blanks between words."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    odd = np.flatnonzero(_data(texts, ends) > 0xC3)
    odd = np.unique(np.searchsorted(ends - ends[0], odd, "right") - 1)
    if not len(odd):
        return texts
    rows = texts.to_pylist()
    for k in odd:
        rows[k] = "\n".join(" ".join(x.lower().split()) for x in rows[k].split("\n"))
    return pa.array(rows, pa.large_string())


def _data(texts: pa.Array, ends: np.ndarray) -> np.ndarray:
    raw = texts.buffers()[2]
    return np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each word data[start:end]: a polynomial of its bytes, as a difference of running sums, mixed."""
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(end, base + _BLOCK, "right")))
        piece = _BYTES[data[base : end[to - 1]]]
        powers, inverse = _POWERS, _INVERSE
        if len(piece) > _BLOCK:  # one word as long as that
            powers = np.multiply.accumulate(np.full(len(piece), _POWERS[0]))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * powers[: len(piece)], out=sums[1:])
        s = start[at:to] - base
        out[at:to] = (sums[end[at:to] - base] - sums[s]) * inverse[s]
        at = to
    return mixed(out ^ (end - start).astype(np.uint64))


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, words of each line, document of each line, number of each line in its document)."""
    texts = _plain(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[_data(texts, ends)]
    ends = ends - ends[0]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = data[at]
    data[at] = second + 32 * ((second < 0x9F) & (second != 0x97)).astype(np.uint8)
    blank = _BLANK[data]
    at = np.flatnonzero(data[:-1] == 0xC2)
    at = at[(data[at + 1] == 0x85) | (data[at + 1] == 0xA0)]
    blank[at] = blank[at + 1] = True
    # A word begins or ends at a blank or where a text does.
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = blank[:-1]
    cut[ends] = True
    start = np.flatnonzero(cut[:-1] & ~blank)
    cut[:-1] = blank
    cut[ends] = True
    end = np.flatnonzero(cut[1:] & ~blank) + 1
    new = np.flatnonzero(data == 10)
    stops = np.concatenate([ends[1:], new])
    order = np.argsort(stops, kind="stable")  # the end of a text comes before a line feed that begins the next
    doc = np.concatenate([np.arange(len(texts)), np.searchsorted(ends[1:], new, "right")])[order]
    counts = np.diff(np.searchsorted(start, stops[order]), prepend=0)
    first = np.searchsorted(doc, np.arange(len(texts)))
    return _hashes(data, start, end), counts, doc, np.arange(len(doc)) - first[doc]


def spots(ids: np.ndarray, contents: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """64 bits that stand for a place (id, content, number)."""
    h = mixed(ids.astype(np.int64).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    h = mixed(h + contents.astype(np.int64).view(np.uint64))
    return mixed(h ^ mixed(numbers.astype(np.uint64) + np.uint64(1)))


class Lines:
    """The distinct lines of one batch of documents: each with the first place that has it there.

    ``mark`` is the content where several contents have the document's id, and otherwise 0, and ``number`` the line
    number and (lowest bit) whether there is an id; (number's bit, id, mark, number) orders lines as their places do.
    """

    def __init__(self, batch: pa.RecordBatch, rarity: np.ndarray, shared: np.ndarray, wanted: np.ndarray | None = None):
        here = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        contents, id_hash = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        order = np.lexsort((contents, ids, here))
        h, counts, doc, number = split(batch.column(3).take(pa.array(order)))
        filled = np.flatnonzero(counts)
        rows = order[doc]
        mark = np.where(in_bitmap(shared, id_hash)[rows], contents[rows], 0)
        if wanted is not None:  # only words of the lines whose places may be in the bitmap
            at = spots(ids[rows[filled]], mark[filled], number[filled] * 2 + here[rows[filled]])
            some = np.zeros(len(counts), bool)
            some[filled[in_bitmap(wanted, at.view(np.int64))]] = True
            h, filled = h[np.repeat(some, counts)], np.flatnonzero(some)
        line = np.repeat(np.arange(len(filled)), counts[filled])
        rare = rarity[(h >> np.uint64(64 - SLOTS)).astype(np.int64)]
        # Words by line and rarity; the sort key holds most bits of the hash, ties of it are sorted in full.
        key = line.astype(np.uint64) << np.uint64(42) | rare.astype(np.uint64) << np.uint64(36) | h >> np.uint64(28)
        at = np.argsort(key)
        tied = key[at[1:]] == key[at[:-1]]
        if len(filled) >= 1 << 22 or (tied & (h[at[1:]] != h[at[:-1]])).any():
            at = np.lexsort((h, rare, line))
        h, line, rare = h[at], line[at], rare[at]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
        self.hash, line, self.rare = h[new], line[new], rare[new]
        begin = np.flatnonzero(np.diff(line, prepend=-1))
        n = np.diff(begin, append=len(line))
        some = len(begin) > 0
        total = np.add.reduceat(self.hash, begin) if some else np.zeros(0, np.uint64)
        name = mixed(total ^ n.astype(np.uint64))
        _, first = np.unique(name, return_index=True)
        self.begin, self.n, self.name = begin[first], n[first], name[first]
        where = filled[first]
        self.line, self.mark, rows = number[where], mark[where], rows[where]
        self.here, self.ids, self.contents = here[rows], ids[rows], contents[rows]
        self.number = self.line * 2 + self.here
        self.spot = spots(self.ids, self.mark, self.number)

    def at(self, rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, index of the word) of the first ``n`` words of each of ``rows``."""
        line = np.repeat(rows, n)
        return line, self.begin[line] + np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)

    def maps(self, rows: np.ndarray) -> np.ndarray:
        """Four parity maps of ``rows``: 64 bits that all words flip, and those of the words that have a further bit,
        another, and both; the last two are 0 for lines of up to LONGER words."""
        maps = np.zeros((4, len(rows)), np.uint64)
        for k, some in ((2, np.arange(len(rows))), (4, np.flatnonzero(self.n[rows] > LONGER))):
            if not len(some):
                continue
            n = self.n[rows[some]]
            _, word = self.at(rows[some], n)
            h, begin = self.hash[word], np.cumsum(n) - n
            bit = np.uint64(1) << (h & np.uint64(63))
            for m in range(k - 2, k):
                own = np.uint64(m << 6)
                maps[m, some] = np.bitwise_xor.reduceat(np.where(h & own == own, bit, np.uint64(0)), begin)
        return maps

    def prefixes(self, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(line, index of the word) of the prefix words that occur elsewhere too."""
        row, word = self.at(rows, prefix(self.n[rows], threshold))
        again = self.rare[word] > 0
        return row[again], word[again]


def prefix(n: np.ndarray, threshold: float) -> np.ndarray:
    """Words of which two similar lines share at least one."""
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def _chunks(batch: pa.RecordBatch):
    """Slices of about CHUNK bytes of text."""
    size = pc.binary_length(batch.column(3)).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _scan(docs: DataFrame, rows, schema: str, rarity, shared, wanted=None) -> DataFrame:
    """``rows(lines)`` for an iterator over the lines of the batches of ``docs`` (doc_id, content, id_hash, text)."""

    def run(batches):
        known = [x and x.value for x in (rarity, shared, wanted)]
        yield from rows(Lines(chunk, *known) for batch in batches for chunk in _chunks(batch))

    return docs.select("doc_id", "content", "id_hash", "text").mapInArrow(run, schema)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    values = pa.array(values.view(np.int64) if values.dtype == np.uint64 else values)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)


def rarity_of(texts: DataFrame) -> np.ndarray:
    """A byte for each slot of word hashes: twice the binary logarithm of its words' occurrences; 0: at most one."""
    width = (1 << SLOTS) // SLICES

    def count(batches):
        seen = np.zeros(1 << SLOTS, np.uint32)
        for batch in batches:
            for chunk in _chunks(batch):
                np.add.at(seen, (split(chunk.column(3))[0] >> np.uint64(64 - SLOTS)).astype(np.int64), np.uint32(1))
        slot = np.flatnonzero(seen)
        ends = np.searchsorted(slot, np.arange(1, SLICES + 1) * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SLICES, dtype=np.int32)), _lists((slot % width).astype(np.int32), ends),
             _lists(seen[slot].astype(np.int64), ends)],
            ["slice", "slots", "counts"],
        )

    def fold(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in enumerate(batch.column(0).to_pylist()):
                own = sums.setdefault(part, np.zeros(width, np.int64))
                slots, counts = (batch.column(c).slice(k, 1).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
                own[slots] += counts
        if sums:
            levels = [np.minimum(2 * np.log2(np.maximum(x, 1)), 63).astype(np.uint8).tobytes() for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels)], ["slice", "levels"])

    parts = texts.select("doc_id", "content", "id_hash", "text").mapInArrow(
        count, "slice int, slots array<int>, counts array<long>"
    )
    whole = np.zeros(1 << SLOTS, np.uint8)
    for row in parts.repartition(SLICES, "slice").mapInArrow(fold, "slice int, levels binary").collect():
        whole[row["slice"] * width :][:width] = np.frombuffer(row["levels"], np.uint8)
    return whole


class Meeting:
    """The rows of one bucket, by word: which of its lines may be similar to an earlier one."""

    def __init__(self, word, ids, marks, number, n, bits, more, third, fourth, threshold):
        order = np.lexsort((n, word))
        place = np.lexsort((number >> 1, marks, ids, number & 1))
        new = np.ones(len(place), bool)
        new[1:] = np.logical_or.reduce([v[place[1:]] != v[place[:-1]] for v in (ids, marks, number)])
        rank = np.empty(len(place), np.int64)
        rank[place] = np.cumsum(new)
        full = np.zeros((3, len(n)), np.uint64)
        full[0, n > LONG] = more.view(np.uint64)
        full[1, n > LONGER], full[2, n > LONGER] = third.view(np.uint64), fourth.view(np.uint64)
        self.word, self.n, self.bits = word[order], n[order], bits[order].view(np.uint64)
        self.more, self.third, self.fourth = full[:, order]
        self.rank, self.spot = rank[order], spots(ids, marks, number)[order]
        self.threshold = threshold

    def near(self, a: np.ndarray, b) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of rows pass all bounds, and in how many bits their maps differ."""
        t = self.threshold
        na, nb = self.n[a], self.n[b]
        # Similar lines share (na + nb) * t / (1 + t) words or more.
        most = (na + nb) * ((1 - t) / (1 + t)) + 2e-9
        differ = self.bits[a] ^ self.bits[b]
        far = np.bitwise_count(differ)
        ok = np.flatnonzero(far <= most)
        if len(ok):
            i, j = a[ok], b[ok] if isinstance(b, np.ndarray) else b
            na, nb, more = na[ok], nb[ok] if isinstance(b, np.ndarray) else nb, self.more[i] ^ self.more[j]
            both = (na > LONG) & (nb > LONG)
            two = np.where(both, np.bitwise_count(more) + np.bitwise_count(differ[ok] ^ more), far[ok]).astype(np.int64)
            four = np.flatnonzero((na > LONGER) & (nb > LONGER) & (two <= most[ok]))
            if len(four):
                i4, j4 = i[four], j[four] if isinstance(j, np.ndarray) else j
                third, fourth = self.third[i4] ^ self.third[j4], self.fourth[i4] ^ self.fourth[j4]
                parts = (fourth, more[four] ^ fourth, third ^ fourth, differ[ok[four]] ^ more[four] ^ third ^ fourth)
                two[four] = sum(np.bitwise_count(v).astype(np.int64) for v in parts)
            fine = np.minimum(na, nb) >= np.maximum(na, nb) * t - 1e-9
            fine &= (two <= most[ok]) & (self.rank[i] != self.rank[j])
            return ok[fine], two[fine]
        return ok, far[:0]

    def pairs(self, asked: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(x, y, how far apart, whether x has more): rows ``x`` and earlier rows ``y``; NAMED or a few more for an x,
        or, if ``asked`` says which x matter, all of them for those."""
        rows = len(self.word)
        begin = np.flatnonzero(np.concatenate([[True], self.word[1:] != self.word[:-1]])) if rows else np.zeros(0, int)
        end = np.append(begin[1:], rows)
        found = np.zeros(rows, np.int64)
        xs, ys, fars = [], [], []

        def note(x, y, far):
            some = found[x] <= NAMED if asked is None else asked[x]
            x, y, far = x[some], y[some], far[some]
            np.add.at(found, x, 1)
            xs.append(x)
            ys.append(y)
            fars.append(far / (self.n[x] + self.n[y]))

        small = end - begin <= 256
        stop = np.repeat(np.where(small, end, begin), end - begin)
        at, d = np.flatnonzero(stop - np.arange(rows) > 1), 1
        least = self.n * 1.0
        while len(at):  # rows and their d-th neighbour in size, for all small runs at once
            hit, far = self.near(at, at + d)
            if len(hit):
                a, b = at[hit], at[hit] + d
                late = self.rank[a] > self.rank[b]
                note(np.where(late, a, b), np.where(late, b, a), far)
            at = at[least[at] >= least[at + d] * self.threshold - 1e-9]
            d += 1
            at = at[stop[at] - at > d]
        for a, b in zip(begin[~small], end[~small]):
            run = a + np.argsort(self.rank[a:b], kind="stable")
            left = np.arange(b - a) if asked is None else np.flatnonzero(asked[run])
            for k in range(b - a):
                left = left[np.searchsorted(left, k, "right") :]
                if not len(left):
                    break
                x = run[left]
                hit, far = self.near(x, run[k])
                if len(hit):
                    note(x[hit], np.full(len(hit), run[k]), far)
                    if asked is None:
                        left = left[found[x] <= NAMED]
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
        far = np.concatenate(fars) if fars else np.zeros(0)
        return x, y, far, found[x] > NAMED


def candidates(keys: DataFrame, threshold: float, wanted=None) -> DataFrame:
    """(x, y, far, more): for lines ``x`` the earlier lines ``y`` of a bucket that pass the bounds, and whether there
    may be others; if ``wanted`` (the broadcast bitmap of lines) is given, all of them for those lines."""

    def buckets(batches):
        """The flat columns of each bucket, which may come in several rows and batches."""
        held, last = [], None
        for batch in batches:
            bucket = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)) if len(bucket) else []
            for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
                if held and bucket[a] != last:
                    yield [np.concatenate(v) for v in zip(*held)]
                    held = []
                last = bucket[a]
                part = batch.slice(a, b - a)
                held.append([c.flatten().to_numpy(zero_copy_only=False) for c in part.columns[1:]])
        if held:
            yield [np.concatenate(v) for v in zip(*held)]

    def run(batches):
        for columns in buckets(batches):
            rows = Meeting(*columns, threshold)
            asked = None if wanted is None else in_bitmap(wanted.value, rows.spot.view(np.int64))
            x, y, far, more = rows.pairs(asked)
            yield pa.RecordBatch.from_arrays(
                [_longs(rows.spot[x]), _longs(rows.spot[y]), pa.array(far), pa.array(more)], ["x", "y", "far", "more"]
            )

    return keys.sortWithinPartitions("bucket").mapInArrow(run, "x long, y long, far double, more boolean")


class Join:
    """What all scans of one table share: the order of words, and which lines stand for their copies."""

    def __init__(self, docs: DataFrame, threshold: float):
        self.docs, self.threshold = docs, threshold
        self.context = docs.sparkSession.sparkContext
        several = docs.groupBy("doc_id", "id_hash").agg(F.min("content").alias("a"), F.max("content").alias("b"))
        several = settled(several.where("a <> b").select(F.col("id_hash").alias("hash")), "shared-ids")
        self.shared = self.context.broadcast(hash_bitmap(several, several.count()))
        self.rarity = self.context.broadcast(rarity_of(docs))

        level = int(np.floor(2 * np.log2(max(2, WORD_ROWS))))

        def places(lines):
            """Lines by name, and (word) prefix rows of words that may be hot, of all (null) beside them."""
            for x in lines:
                _, word = x.prefixes(np.arange(len(x.n)), threshold)
                own, n = np.unique(x.hash[word[x.rare[word] >= level]], return_counts=True)
                more = len(own) + 1
                name = pa.concat_arrays([_longs(x.name), _longs(own), pa.nulls(1, pa.int64())])
                ids = pa.array(np.append(x.ids, np.zeros(more, np.int64)), pa.int64(), mask=np.append(~x.here, [True] * more))
                content, spot = (np.append(v, np.zeros(more, v.dtype)) for v in (x.contents, x.spot))
                number = np.append(x.line, np.zeros(more, np.int64)).astype(np.int32)
                n = np.concatenate([np.zeros(len(x.n), np.int64), n, [len(word)]])
                is_word = pa.array(np.arange(len(n)) >= len(x.n))
                yield pa.RecordBatch.from_arrays(
                    [is_word, name, ids, _longs(content), pa.array(number), _longs(spot), pa.array(n)],
                    ["is_word", "name", "doc_id", "content", "line", "spot", "n"],
                )

        scanned = self.scan(
            places, "is_word boolean, name long, doc_id long, content long, line int, spot long, n long"
        )
        place = F.struct("doc_id", "content", "line", "spot")
        classes = scanned.groupBy("is_word", "name").agg(
            F.min(place).alias("place"), (F.count("*") > 1).alias("again"), F.sum("n").alias("n")
        )
        seen = settled(classes, "line-classes")
        self.classes = seen.where("not is_word").select("name", "place", "again")
        copied = self.classes.where("again")
        self.copied = self.context.broadcast(hash_bitmap(copied.select(F.col("name").alias("hash")), copied.count()))
        first = self._may_be_copied()
        self.first = self.context.broadcast(hash_bitmap(first, first.count()))
        self.total, self.hot = self._hot(seen.where("is_word").select(F.col("name").alias("word"), "n"))

    def scan(self, rows, schema: str, wanted=None) -> DataFrame:
        return _scan(self.docs, rows, schema, self.rarity, self.shared, wanted)

    def _may_be_copied(self) -> DataFrame:
        """(hash) of the first places of all lines that the bitmap ``copied`` lets through, copied or not."""
        copied = self.copied

        def run(batches):
            for batch in batches:
                name, spot = batch.columns
                some = in_bitmap(copied.value, name.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([spot.filter(pa.array(some))], ["hash"])

        return settled(self.classes.select("name", "place.spot").mapInArrow(run, "hash long"), "first-places")

    def chosen(self):
        """A function that tells the rows of lines that stand for their copies; some others may pass."""
        copied, first = self.copied, self.first

        def rows(x: Lines) -> np.ndarray:
            again = in_bitmap(copied.value, x.name.view(np.int64))
            return np.flatnonzero(~again | in_bitmap(first.value, x.spot.view(np.int64)))

        return rows

    def _hot(self, n: DataFrame) -> tuple[int, object]:
        """The number of prefix rows, and (word, blocks) of words with more rows than one task compares; ``n`` counts
        copies of lines too, so there may be more blocks than needed."""
        limit = WORD_ROWS
        total = n.where("word is null").select("n").first()
        # At most total / limit rows.
        hot = sorted((r["word"] & 0xFFFFFFFFFFFFFFFF, r["n"]) for r in n.where(F.col("n") > limit).dropna().collect())
        words = np.array([h for h, _ in hot], np.uint64)
        blocks = -(-np.array([k for _, k in hot], np.int64) // max(1, limit // 2))
        return (total["n"] if total else 0), self.context.broadcast((words, blocks))

    def keys(self, of=None) -> DataFrame:
        """The prefix rows by buckets of words: all rows of a word meet in one of them, or, of a hot word, every two
        blocks.  ``of``: a broadcast bitmap of words, if only some are needed."""
        threshold, hot, chosen = self.threshold, self.hot, self.chosen()
        count = max(1, self.total // BUCKET_ROWS)

        def tasks(word, spot):
            """(row, task) of each row: one, or for hot words as many as there are blocks."""
            task, rows = mixed(word), np.arange(len(word))
            words, blocks = hot.value
            if not len(words):
                return rows, task
            at = np.minimum(np.searchsorted(words, word), len(words) - 1)
            n = np.where(words[at] == word, blocks[at], 1)
            row = np.repeat(rows, n)
            other = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            own = (mixed(spot) % n.astype(np.uint64)).astype(np.int64)[row]
            pair = np.minimum(own, other) * (1 << 32) + np.maximum(own, other)
            return row, np.where(n[row] > 1, mixed(task[row] ^ mixed(pair.astype(np.uint64) + np.uint64(1))), task[row])

        def packed(parts):
            task, *columns = (np.concatenate(v) for v in zip(*parts))
            bucket = (task % np.uint64(count)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            own, first = np.unique(bucket[order], return_index=True)
            ends = np.append(first[1:], len(order))
            ids, marks, number, n, bits, more, third, fourth = (c[order] for c in columns)
            long, longer = n > LONG, n > LONGER
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(own.astype(np.int32)),
                    _lists((task[order] >> np.uint64(32)).astype(np.uint32).view(np.int32), ends),
                    *(_lists(v, ends) for v in (ids, marks, number, n, bits)),
                    _lists(more[long], np.cumsum(long)[ends - 1]),
                    *(_lists(v[longer], np.cumsum(longer)[ends - 1]) for v in (third, fourth)),
                ],
                ["bucket", *kinds],
            )

        def rows(lines):
            parts, held = [], 0
            for x in lines:
                chose = chosen(x)
                maps = np.zeros((4, len(x.n)), np.uint64)
                maps[:, chose] = x.maps(chose)
                line, word = x.prefixes(chose, threshold)
                if of is not None:
                    some = in_bitmap(of.value, x.hash[word].view(np.int64))
                    line, word = line[some], word[some]
                at, task = tasks(x.hash[word], x.spot[line])
                line = line[at]
                small = (v[line].astype(np.int32) for v in (x.number, x.n))
                parts.append([task, x.ids[line], x.mark[line], *small, *maps[:, line]])
                held += len(line)
                if held >= PACKED:
                    yield packed(parts)
                    parts, held = [], 0
            if held:
                yield packed(parts)

        kinds = {"word": "int", "ids": "long", "marks": "long", "number": "int", "n": "int", "bits": "long"}
        kinds |= dict.fromkeys(("more", "third", "fourth"), "long")
        schema = "bucket int, " + ", ".join(f"{k} array<{v}>" for k, v in kinds.items())
        return self.scan(rows, schema).repartition(count, "bucket")

    def words(self, pairs: DataFrame) -> DataFrame:
        """(spot, name, tokens) of the lines of ``pairs`` (x, y)."""
        spots_ = settled(pairs.select("x").union(pairs.select("y")).distinct().toDF("hash"), "lines-to-compare")
        wanted = self.context.broadcast(hash_bitmap(spots_, spots_.count()))

        def tokens(lines):
            for x in lines:
                rows = np.arange(len(x.n))
                _, word = x.at(rows, x.n)
                yield pa.RecordBatch.from_arrays(
                    [_longs(x.spot[rows]), _longs(x.name[rows]), _lists(x.hash[word], np.cumsum(x.n[rows]))],
                    ["spot", "name", "tokens"],
                )

        # A place may come twice, as a document may.
        own = self.scan(tokens, "spot long, name long, tokens array<long>", wanted)
        own = own.join(spots_.select(F.col("hash").alias("spot")), "spot", "left_semi").dropDuplicates(["spot"])
        return settled(own, "line-words")

    def compared(self, pairs: DataFrame, own: DataFrame) -> DataFrame:
        """Of ``pairs`` (x, y), whose words ``own`` has: x, its name, and whether a y is similar."""
        threshold = self.threshold
        # Bitmaps let some later copies pass: they are partners like any line, but only first places speak for a class.
        first = self.classes.select(F.col("place.spot").alias("spot"))
        x = own.join(first, "spot", "left_semi").select(F.col("spot").alias("x"), "name", F.col("tokens").alias("tx"))
        y = own.select(F.col("spot").alias("y"), F.col("tokens").alias("ty"))
        shared = F.size(F.array_intersect("tx", "ty"))
        enough = shared * (1 + threshold) >= (F.size("tx") + F.size("ty")) * threshold - 1e-9
        judged = pairs.join(y, "y").join(x, "x").select("x", "name", enough.alias("similar"))
        return settled(judged.groupBy("x", "name").agg(F.max("similar").alias("similar")), "lines-compared")

    def words_of(self, asked) -> DataFrame:
        """(hash) of the prefix words of the lines in the broadcast bitmap ``asked``."""
        threshold = self.threshold

        def words(lines):
            for x in lines:
                _, word = x.prefixes(np.arange(len(x.n)), threshold)
                yield pa.RecordBatch.from_arrays([_longs(np.unique(x.hash[word]))], ["hash"])

        return settled(self.scan(words, "hash long", asked).distinct(), "asked-words")


def first_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, content, line) of the lines that stay, of ``docs`` (doc_id, content, text)."""
    join = Join(docs.withColumn("id_hash", F.xxhash64("doc_id")), threshold)
    found = candidates(join.keys(), threshold)
    each = F.array_sort(F.collect_set(F.struct("far", "y")))
    found = found.groupBy("x").agg(each.alias("ys"), F.max("more").alias("more"))
    found = found.select("x", F.slice("ys", 1, NAMED).alias("ys"), (F.col("more") | (F.size("ys") > NAMED)).alias("more"))
    found = settled(found, "line-pairs")
    words = join.words(found.select("x", F.explode("ys.y").alias("y")))
    likely = join.compared(found.select("x", F.explode(F.slice("ys.y", 1, LIKELY)).alias("y")), words)
    rest = found.join(likely.where("not similar"), "x", "left_semi")
    others = rest.select("x", F.explode(F.slice("ys.y", LIKELY + 1, NAMED)).alias("y"))
    others = join.compared(others, words)
    gone = likely.union(others).where("similar").select("name")
    left = rest.where("more").join(others.where("similar"), "x", "left_anti").select("x")
    left = settled(left, "lines-asked")
    several = left.count()
    if several:
        asked = join.context.broadcast(hash_bitmap(left.select(F.col("x").alias("hash")), several))
        words = join.words_of(asked)
        of = join.context.broadcast(hash_bitmap(words, words.count()))
        more = settled(candidates(join.keys(of), threshold, asked).select("x", "y").distinct(), "line-pairs")
        gone = gone.union(join.compared(more, join.words(more)).where("similar").select("name"))
    return join.classes.join(gone.distinct(), "name", "left_anti").select("place.doc_id", "place.content", "place.line")


def dedup_lines(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str = "n_lines",
    removed_col: str = "n_removed",
) -> DataFrame:
    """``docs`` with later similar lines cut from ``text_col``, and the number of lines before and of those cut."""
    names = [c for c in docs.columns if c not in (lines_col, removed_col)]
    keyed = docs.select(*text_key(id_col, text_col), F.struct(*names).alias("row"))
    texts = keyed.select(
        F.col("doc_id").cast("long").alias("doc_id"), "content", F.col(f"row.`{text_col}`").alias("text")
    )
    kept = first_lines(texts, threshold).groupBy("doc_id", "content").agg(F.collect_list("line").alias("kept"))
    joined = keyed.join(kept, same(keyed, kept, "doc_id", "content"), "left").select("row", "kept")
    flat = joined.select(*(F.col(f"row.`{c}`").alias(c) for c in names), F.col("kept").alias("__kept"))
    where = names.index(text_col)
    schema = docs.select(*names, F.lit(0).alias(lines_col), F.lit(0).alias(removed_col)).schema

    def run(batches):
        for batch in batches:
            texts, before, cut = [], [], []
            for text, stay in zip(batch.column(where).to_pylist(), batch.column(len(names)).to_pylist()):
                lines, stay = (text or "").split("\n"), set(stay or ())
                left = [x for k, x in enumerate(lines) if k in stay or not x.split()]
                texts.append(None if text is None else "\n".join(left))
                before.append(0 if text is None else len(lines))
                cut.append(len(lines) - len(left))
            columns = [*batch.columns[: len(names)], pa.array(before, pa.int32()), pa.array(cut, pa.int32())]
            columns[where] = pa.array(texts, batch.column(where).type)
            yield pa.RecordBatch.from_arrays(columns, [*names, lines_col, removed_col])

    return flat.mapInArrow(run, schema)
