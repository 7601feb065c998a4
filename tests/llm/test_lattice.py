"""Language-model scores against a plain model, and its behaviour on texts that are and are not like the corpus."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from quorumlens.llm import lattice

PATH = P.path("piece_bpe_32k.model")
CUT = re.compile("[^\x20\x09-\x0d]+")


def paths(word: str, logs, vocab) -> list[tuple[float, list[int]]]:
    """Every segmentation of a word with its log weight and pieces, one by one."""
    index = {vocab_piece(i): i for i in np.flatnonzero(vocab.lengths)}

    def walk(rest):
        if not rest:
            return [(0.0, [])]
        spelled = [int(vocab.bytes[b]) for b in rest[0].encode()]
        found = [(w + sum(logs[b] for b in spelled), spelled + p) for w, p in walk(rest[1:])]
        for k in range(1, min(len(rest), vocab.longest) + 1):
            if rest[:k] in index:
                i = index[rest[:k]]
                found += [(w + logs[i], [i, *p]) for w, p in walk(rest[k:])]
        return found

    return walk(lattice.MARK + word)


def vocab_piece(i):
    import sentencepiece

    if not hasattr(vocab_piece, "file"):
        vocab_piece.file = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return vocab_piece.file.id_to_piece(int(i))


@pytest.mark.parametrize("segment", [1 << 16, 5])
def test_all_segmentations_are_weighed(monkeypatch, segment):
    monkeypatch.setattr(lattice, "SEGMENT", segment)
    vocab = lattice.vocabulary(PATH)
    logs = lattice._logs(vocab.prior)
    words = ["the", "naïve", "日本", "xq", "<unk>", "▁a", "😀", "aaaa", "lower"]
    got = lattice.log_weights([w.encode() for w in [*words, ""]], PATH, logs)
    uses = np.zeros(vocab.size)
    for word, value in zip(words, got):
        every = paths(word, logs, vocab)
        total = math.log(sum(math.exp(w) for w, _ in every))
        assert abs(value - total) < 1e-9, word
        for w, pieces in every:
            np.add.at(uses, pieces, 2 * math.exp(w - total))
    assert abs(got[-1] - logs[vocab.end]) < 1e-12
    total = sum(
        lattice.Lattice(words[a:b], vocab, logs).expected(np.full(b - a, 2.0)) for a, b in lattice._runs(words)
    )
    assert np.abs(total - uses).max() < 1e-9


def model(docs):
    """(n_tokens, n_known, train_tokens, base) of each text, from plain counts."""
    tokens = {k: [*CUT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for k, (_, t) in enumerate(docs)}
    out = {k: zlib.crc32(str(i).encode()) % 7 == 2 for k, (i, _) in enumerate(docs)}
    counts = Counter(w for k, own in tokens.items() if not out[k] for w in own)
    n, v = sum(counts.values()), len(counts)
    return {
        k: (out[k], len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        for k, own in tokens.items()
    }


def scored(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, base int").repartition(3)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return lattice.score_corpus(df.withColumn("held_out", held), PATH, ~F.col("held_out"), ["doc_id", "held_out", "base"])


def test_counts_and_scores_match_a_plain_model(spark, monkeypatch):
    # Few common words, so that most take the way through the join; long words go by their digest.
    monkeypatch.setattr(lattice, "FREQUENT", 8)
    rng = np.random.default_rng(5)
    vocab = ["the", "The", "of", "naïve", "日本語", "x" * 70, "Straße", "a b", "İx", *(f"w{k}" for k in range(60))]
    docs = [(int(k), " \t\n\x0b\x0c\r "[k % 7].join(rng.choice(vocab, rng.integers(0, 40)))) for k in range(120)]
    docs += [(200, None), (201, ""), (202, "   "), (203, "the " * 20_000), (204, "q" * 30_000)]
    got = {(r.doc_id): r for r in scored(spark, [(i, t, "x", 7) for i, t in docs]).collect()}
    assert len(got) == len(docs)
    want = model(docs)
    words = lattice.count_words(spark.createDataFrame(docs, "doc_id long, text string"), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    logs = lattice.fit(words, PATH)
    assert abs(np.exp(logs).sum() - 1) < 1e-9
    for k, (i, text) in enumerate(docs):
        r = got[i]
        held, n, known, train, base = want[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base) == (held, n, known, train, 7), i
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base)), i
        own = Counter([*lattice.words_of(text), b""])
        value = sum(lattice.log_weights(list(own), PATH, logs) * np.array(list(own.values()))) / math.log(10)
        assert abs(r.score - value) < 1e-6 * max(1, abs(value)), i


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(4, "one two", "x", 1), (4, "one two", "x", 1), (None, "one", "x", 1), (None, None, "x", 1)]
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in scored(spark, rows).collect())
    assert got == [("4", 3, 3, 9), ("4", 3, 3, 9), ("None", 1, 1, 9), ("None", 2, 2, 9)]
    assert scored(spark, []).count() == 0
    # Nobody teaches: the vocabulary's own weights score.
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    r = lattice.score_corpus(df, PATH, F.lit(None).cast("boolean"), ["doc_id"]).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score < -3


def test_the_model_learns_the_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    words = lattice.count_words(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    held = [r.text or "" for r in docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()]
    own = [w for t in held for w in lattice.words_of(t)]
    rng = np.random.default_rng(1)
    mixed = [bytes(rng.permutation(bytearray(w))) for w in own if w.isascii()]
    value = lambda logs, ws: lattice.log_weights(ws, PATH, logs).sum() / sum(map(len, ws))
    prior, learnt = lattice._logs(lattice.vocabulary(PATH).prior), lattice.fit(words, PATH)
    assert value(learnt, own) > value(prior, own)
    assert value(learnt, [w for w in own if w.isascii()]) > value(learnt, mixed) + 0.3
