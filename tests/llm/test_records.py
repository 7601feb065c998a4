"""Token records: words of a batch numbered once, and one pass over the data files for the index."""

from __future__ import annotations

import random

from quorumlens.llm import records, tokens
from quorumlens.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")
ALPHABET = "ab Zé_.,,'’!-\t\n\r\x0b\x1c\x85\xa0  12½ßŸĲŉ日"


def test_each_distinct_word_is_looked_up_once():
    class Counted(tokens.Pieces):
        asked = 0

        def __getitem__(self, piece):
            Counted.asked += 1
            return super().__getitem__(piece)

    rng = random.Random(5)
    texts = ["", " \n", "one two. one, two", "one " * 500]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    pieces = Counted(PATH)
    assert pieces.encode_words(texts) == [pieces.by_library(t) for t in texts]
    assert pieces.encode_words([]) == []
    Counted.asked = 0
    pieces.encode_words([("one two " * 500).strip()] * 3)
    assert Counted.asked <= 2


def test_index_reads_the_data_files_once(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(records, "settled", lambda df, kind, do=records.settled: kept.append(do(df, kind)) or kept[-1])
    rows = [(3, "b"), (None, "a a"), (1, None), (1, ""), (2, "word " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = records.write_records(docs, str(tmp_path / "out"), PATH, end_id=1)
    found = {(r.shard, r.position): r for r in spark.read.parquet(f"{folder}/index").collect()}
    start = 0
    for r in sorted(records.scan_records(spark, folder).collect(), key=lambda r: (r.shard, r.position)):
        own = found.pop((r.shard, r.position))
        assert (own.start, own.n_tokens, own.doc_id) == (start, len(r.ids), r.doc_id)
        start += own.n_tokens
    assert not found and len(kept) == 1
