"""Language-model scores of whole texts: the probability of a text over all its segmentations into subwords.

The vocabulary is a public tokenizer's and stays as it is.  A word (A-Z lower-cased, cut at ASCII white space) is
spelled with the vocabulary's word mark before it and is the end of many paths through a lattice: an arc for each
piece of the vocabulary that stands in it, and an arc for each character as its UTF-8 bytes, so every text has a
probability.  A forward recursion in log space adds the weights of all paths; words are independent, for no piece
crosses a blank, and a last "end" piece closes the text.  The log probability of a text is the sum over its words.

Weights: the file's scores are ranks, so the prior of a piece is 1 / (rank + SHIFT), normalised (a Zipf-Mandelbrot law);
pieces without a rank (bytes) stand last.  With this prior all segmentations of the training words are weighed, the
expected counts of the pieces (forward and backward recursion) are added to prior pseudo-counts, and again for ROUNDS.

On Spark: one pass over the texts counts words by task, summed by word.  Lattices are walked once per distinct word,
in tasks.  Only sums by piece (the vocabulary) reach the driver.  A second pass over the texts sums the scores of
the FREQUENT most frequent words, which are broadcast (bounded rows, and keys of at most KEY_BYTES), and writes one
row a document with its other words; those meet their scores in a join by word, in which no word can be hot.

Edge cases: a null text is empty and has only the end; null ids and repeated rows are rows of their own; a document for
which ``learns`` is null learns nothing; without training documents counts are 0 and the prior alone scores; an
empty table gives an empty result.  Very long words are walked in segments of SEGMENT characters.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.llm.common import settled

#: Rounds of expected counts, shift of the rank law, pseudo-counts of the prior (times the vocabulary's size).
ROUNDS, SHIFT, PRIOR = 2, 2.7, 1.0
#: Words whose scores are broadcast, and bytes up to which a word is its own key.
FREQUENT, KEY_BYTES = 1 << 17, 48
#: Characters of words walked at a time.
SEGMENT = 1 << 16
#: Words whose lattices a task walks.
TASK_WORDS = 50_000
#: Arcs a level from which on they are added up as arrays.
FEW = 24
#: Distinct words and bytes of them that a task counts before it passes them on.
HELD, HELD_BYTES = 400_000, 32 << 20
#: Fixed values of the vocabulary file: its word mark, and its piece that ends a text.
MARK, END = "▁", "</s>"


class Vocabulary:
    """Pieces of a SentencePiece file: an automaton over their texts, lengths, byte pieces and prior log weights."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = file.get_piece_size()
        self.end = file.piece_to_id(END)
        self.lengths = np.zeros(self.size, np.int64)
        self.bytes = np.zeros(256, np.int64)
        self.automaton = ahocorasick.Automaton()
        rank = np.full(self.size, np.nan)
        for i in range(self.size):
            piece = file.id_to_piece(i)
            if file.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)) and file.get_score(i) > -1e8:
                self.automaton.add_word(piece, i)
                self.lengths[i] = len(piece)
                rank[i] = -file.get_score(i)
        self.automaton.make_automaton()
        self.longest = int(self.lengths.max())
        used = ~np.isnan(rank)
        used[self.bytes] = used[self.end] = True
        rank[self.end] = 0
        rank = np.where(np.isnan(rank), np.nanmax(rank) + 1, rank)
        weight = np.where(used, 1 / (rank + SHIFT), 0)
        self.prior = weight / weight.sum()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """The arcs of a run of words, written one after another with a line end behind each."""

    def __init__(self, words: list[str], vocab: Vocabulary, logs: np.ndarray):
        self.vocab, self.logs = vocab, logs
        self.text = "".join(f"{MARK}{w}\n" for w in words)
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        self.last = np.cumsum(sizes) - 1  # a word's final node is the place of its line end
        self.first = self.last - sizes + 1
        self.codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.byte_logs = np.array([self._by_bytes(c) for c in range(128)])
        self.held: tuple | None = None

    def _by_bytes(self, code: int) -> float:
        return float(self.logs[self.vocab.bytes[list(chr(code).encode("utf-8", "surrogatepass"))]].sum())

    def arcs(self, low: int, high: int):
        """(from, to, piece or -1 for a character by its bytes, log weight) of arcs that end in (low, high]."""
        if self.held is None or self.held[0] != (low, high):
            self.held = (low, high), self._arcs(low, high)
        return self.held[1]

    def _arcs(self, low: int, high: int):
        at = max(0, low - self.vocab.longest + 1)
        found = chain.from_iterable(self.vocab.automaton.iter(self.text, at, high))
        pair = np.fromiter(found, np.int64).reshape(-1, 2)
        to, piece = pair[:, 0] + 1, pair[:, 1]
        piece = piece[to > low]
        to = to[to > low]
        codes = self.codes[low:high]
        chars = low + np.flatnonzero(codes != 10)
        own = self.codes[chars]
        logs = self.byte_logs[np.minimum(own, 127)]
        for c in np.unique(own[own >= 128]):
            logs[own == c] = self._by_bytes(int(c))
        start = np.concatenate([to - self.vocab.lengths[piece], chars])
        return (
            start,
            np.concatenate([to, chars + 1]),
            np.concatenate([piece, np.full(len(chars), -1)]),
            np.concatenate([self.logs[piece], logs]),
        )

    def segments(self) -> list[tuple[int, int]]:
        cuts = [*range(0, len(self.text), SEGMENT), len(self.text)]
        return list(zip(cuts, cuts[1:]))

    def _add(self, into: np.ndarray, level: np.ndarray, node: np.ndarray, other: np.ndarray, logs: np.ndarray):
        """into[node] = log of the summed weights of its arcs, level after level."""
        order = np.argsort(level * (len(self.text) + 1) + node)
        level, node, other, logs = level[order], node[order], other[order], logs[order]
        bounds = np.flatnonzero(np.diff(level, prepend=-1))
        if len(bounds) * FEW > len(level):  # a long word: few arcs meet at a level
            self._add_each(into, node.tolist(), other.tolist(), logs.tolist())
            return
        for a, b in zip(bounds, [*bounds[1:], len(level)]):
            value, own = into[other[a:b]] + logs[a:b], node[a:b]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            top = np.maximum.reduceat(value, heads)
            size = np.diff([*heads, b - a])
            total = np.add.reduceat(np.exp(value - np.repeat(top, size)), heads)
            into[own[heads]] = top + np.log(total)

    @staticmethod
    def _add_each(into: np.ndarray, nodes: list[int], others: list[int], logs: list[float]):
        known: dict[int, float] = {}
        for node, arcs in groupby(zip(nodes, others, logs), key=itemgetter(0)):
            values = [(known[o] if o in known else float(into[o])) + w for _, o, w in arcs]
            top = max(values)
            known[node] = into[node] = top + math.log(sum([math.exp(v - top) for v in values]))

    def forward(self) -> np.ndarray:
        """Log weight of all paths from a word's start to each node of it."""
        alpha = np.zeros(len(self.text) + 1)
        for low, high in self.segments():
            start, to, _, logs = self.arcs(low, high)
            word = np.searchsorted(self.last, start)
            self._add(alpha, to - self.first[word], to, start, logs)
        return alpha

    def expected(self, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations, each word taken ``times``."""
        alpha, total = self.forward(), np.zeros(self.vocab.size)
        beta = np.zeros(len(self.text) + 1)
        for low, high in reversed(self.segments()):
            # Arcs that start in (low, high]; they end up to the longest piece later.
            start, to, piece, logs = self.arcs(max(0, low - 1), min(len(self.text), high + self.vocab.longest))
            own = (start >= low) & (start < high)
            start, to, piece, logs = start[own], to[own], piece[own], logs[own]
            word = np.searchsorted(self.last, start)
            self._add(beta, self.last[word] - start, start, to, logs)
            part = times[word] * np.exp(alpha[start] + logs + beta[to] - alpha[self.last[word]])
            known = piece >= 0
            total += np.bincount(piece[known], part[known], len(total))
            codes, whole = self.codes[start[~known]], part[~known]
            for c, n in zip(*_summed(codes, whole)):
                for b in chr(int(c)).encode("utf-8", "surrogatepass"):
                    total[self.vocab.bytes[b]] += n
        return total


def _summed(keys: np.ndarray, values: np.ndarray):
    own, at = np.unique(keys, return_inverse=True)
    return own, np.bincount(at, values, len(own))


def _runs(words: list[bytes]):
    """(from, to) runs of words of about SEGMENT characters; a longer word is a run of its own."""
    low, size = 0, 0
    for k, w in enumerate(words):
        if size and size + len(w) + 2 > SEGMENT:
            yield low, k
            low, size = k, 0
        size += len(w) + 2
    if low < len(words):
        yield low, len(words)


def words_of(text: str | None) -> list[bytes]:
    """Words as the contract cuts them: bytes methods lower A-Z and split at ASCII white space alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(docs: DataFrame, learns: Column, text_col: str = "text") -> DataFrame:
    """(word, n, seen): uses of each word in documents that teach and in all; the empty word is the end of a text."""

    def run(batches):
        # Words of documents that teach, and of the others.
        counts: list[Counter[bytes]] = [Counter(), Counter()]
        held = 0

        def emit():
            for teaches, count in enumerate(counts):
                words, uses = list(count), list(count.values())
                for at in range(0, len(words), 20_000):
                    n = pa.array(uses[at : at + 20_000], pa.int64())
                    taught = n if teaches else pa.array([0] * len(n), pa.int64())
                    word = pa.array(words[at : at + 20_000], pa.binary())
                    yield pa.RecordBatch.from_arrays([word, taught, n], ["word", "n", "seen"])
                count.clear()

        for batch in batches:
            for text, teaches in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                words.append(b"")
                counts[teaches].update(words)
                held += sum(map(len, words))
                full = sum(map(len, counts)) > HELD
                if held > HELD_BYTES:
                    full, held = full or sum(len(w) for c in counts for w in c) > HELD_BYTES // 2, 0
                if full:
                    yield from emit()
        yield from emit()

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(learns, F.lit(False)).alias("teaches"))
    parts = rows.mapInArrow(run, "word binary, n long, seen long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log weight of each piece: the file's scores, and expected counts over the words that teach."""
    vocab = vocabulary(path)
    taught = words.where("n > 0")
    inner = _dealt(taught.where(F.octet_length("word") > 0).select("word", "n"))
    weights = vocab.prior
    for _ in range(rounds):
        logs = _logs(weights)

        def run(batches):
            own = vocabulary(path)
            total = np.zeros(own.size)
            for batch in batches:
                found = [w.decode("utf-8", "surrogatepass") for w in batch.column(0).to_pylist()]
                times = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                for a, b in _runs(found):
                    total += Lattice(found[a:b], own, logs).expected(times[a:b])
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(total[some])], ["piece", "uses"]
            )

        uses = inner.mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        counts = PRIOR * vocab.size * vocab.prior
        for row in uses.collect():  # at most one row a piece
            counts[row["piece"]] += row["uses"]
        ends = taught.where(F.octet_length("word") == 0).agg(F.sum("n")).first()[0]
        counts[vocab.end] += ends or 0
        weights = counts / counts.sum()
    return _logs(weights)


def _dealt(words: DataFrame) -> DataFrame:
    """Words dealt to tasks by their number: a lattice is much work for few bytes."""
    return words.repartition(max(1, -(-words.count() // TASK_WORDS)), "word")


def _logs(weights: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(weights)


def log_weights(words: list[bytes], path: str, logs: np.ndarray) -> np.ndarray:
    """Log probability of each word over all its segmentations; the empty word is the end of a text."""
    vocab = vocabulary(path)
    out = np.full(len(words), logs[vocab.end])
    some = [k for k, w in enumerate(words) if w]
    found = [words[k].decode("utf-8", "surrogatepass") for k in some]
    for a, b in _runs(found):
        walk = Lattice(found[a:b], vocab, logs)
        out[some[a:b]] = walk.forward()[walk.last]
    return out


def key_of(word: bytes) -> bytes:
    """A word as the join's key: itself, or its digest where it is long."""
    return word if len(word) <= KEY_BYTES else b"\0" + hashlib.sha256(word).digest()


def score(
    docs: DataFrame, words: DataFrame, path: str, logs: np.ndarray, keep: list[str], text_col: str = "text"
) -> DataFrame:
    """Columns ``keep`` of every document with n_tokens, n_known, train_tokens, base_score and score (log10).

    ``words`` is a written table of ``count_words`` that covers these documents.
    """
    spark = docs.sparkSession
    stats = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    tokens, kinds = stats["n"] or 0, stats["v"] or 0
    floor = math.log10(tokens + kinds + 1)

    def lattice(batches):
        for batch in batches:
            found = batch.column(0).to_pylist()
            values = log_weights(found, path, logs) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(key_of, found)), pa.binary()), batch.column(1), batch.column(2), pa.array(values)],
                ["key", "n", "seen", "weight"],
            )

    scored = settled(
        _dealt(words.select("word", "n", "seen")).mapInArrow(lattice, "key binary, n long, seen long, weight double"),
        "word-scores",
    )
    least = _least_uses(scored)
    common = scored.where(F.col("seen") >= least).select("key", "n", "weight").toArrow()
    base = np.log10(common.column("n").to_numpy() + 1.0) - floor
    table = spark.sparkContext.broadcast(
        (common.column("key").to_pylist(), base, common.column("weight").to_numpy(), common.column("n").to_numpy() > 0)
    )
    fields = ["n_tokens long", "known long", "base double", "own double", "others array<struct<key:binary,uses:int>>"]
    own = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)]
    rows = docs.select(F.col(text_col).cast("string").alias("text"), *own)
    kinds_of = [f"`_{k}` {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep)]

    def run(batches):
        keys, base, weight, known = table.value
        at = {k: i for i, k in enumerate(keys)}
        for batch in batches:
            totals, rest, uses, ends = [], [], [], [0]
            for text in batch.column(0):
                words = words_of(text.as_py())
                words.append(b"")
                counted = Counter(words)
                if max(map(len, counted)) > KEY_BYTES:
                    counted = {key_of(w): n for w, n in counted.items()}
                k = np.array([at.get(w, -1) for w in counted])
                n = np.fromiter(counted.values(), np.int64, len(counted))
                own = list(counted)
                for other in np.flatnonzero(k < 0).tolist():
                    rest.append(own[other])
                    uses.append(n[other])
                ends.append(len(rest))
                p, n = k[k >= 0], n[k >= 0]
                totals.append((len(words), int(n[known[p]].sum()), float(n @ base[p]), float(n @ weight[p])))
            pairs = pa.StructArray.from_arrays(
                [pa.array(rest, pa.binary()), pa.array(np.array(uses, np.int32))], ["key", "uses"]
            )
            columns = list(zip(*totals)) or [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    *(pa.array(v, kind) for v, kind in zip(columns, kinds)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                ],
                [*batch.schema.names[1:], "n_tokens", "known", "base", "own", "others"],
            )

    parts = rows.mapInArrow(run, ", ".join([*kinds_of, *fields]))
    # The row numbers are written, so every later job sees the same ones.
    parts = settled(parts.select("*", F.monotonically_increasing_id().alias("row")), "document-scores")
    few = scored.where(F.col("seen") < least).select("key", "n", "weight")
    each = parts.select("row", F.inline("others")).join(few, "key")
    sums = each.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("uses")).otherwise(0)).alias("more_known"),
        F.sum(F.col("uses") * (F.log10(F.col("n") + 1) - F.lit(floor))).alias("more_base"),
        F.sum(F.col("uses") * F.col("weight")).alias("more_own"),
    )
    zero = lambda c, kind="double": F.coalesce(F.col(c), F.lit(0).cast(kind))
    return parts.drop("others").join(sums, "row", "left").select(
        *[F.col(f"_{k}").alias(c) for k, c in enumerate(keep)],
        "n_tokens",
        (F.col("known") + zero("more_known", "long")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base")).alias("base_score"),
        (F.col("own") + zero("more_own")).alias("score"),
    )


def _least_uses(scored: DataFrame) -> int:
    """The least use count from which on there are at most FREQUENT words."""
    # Uses in steps of an eighth of a doubling: some hundred rows, whatever the size of the corpus.
    step = F.floor(F.log2("seen") * 8).cast("int")
    total, least = 0, 1 << 62
    for row in scored.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("seen").alias("least")).orderBy(
        F.desc("step")
    ).collect():
        total += row["rows"]
        if total > FREQUENT:
            break
        least = row["least"]
    return least


def score_corpus(
    docs: DataFrame, path: str, learns: Column, keep: list[str], text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """Every document of ``docs`` scored by the model that those with ``learns`` teach."""
    words = settled(count_words(docs, learns, text_col), "words")
    return score(docs, words, path, fit(words, path, rounds), keep, text_col)
