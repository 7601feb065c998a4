"""What line dedup keeps on disk, and its words, against Python's."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from quorumlens.llm import lines
from quorumlens.session import checkpoint_dir
from tests.llm import brute


def test_words_are_those_of_python():
    texts = ["", None, "A b\nCÀ×Þß x y\x85z\n\n q\x1cw\xa0Ã\u0083", "İXΣ  b　Σ\nĄ ǅ", " \n", "x" * 300_000 + " Y\ny"]
    texts += ["a" + chr(c) + "B" + chr(c) for c in range(0x3000) if chr(c) != "\n"]
    for own in (pa.array(texts), pa.array(texts).slice(2, 3)):
        hashes, counts, doc, number = lines.split(own)
        want = [(k, i, x.lower().split()) for k, t in enumerate(own.to_pylist()) for i, x in enumerate((t or "").split("\n"))]
        assert counts.tolist() == [len(w) for _, _, w in want]
        assert list(zip(doc.tolist(), number.tolist())) == [(k, i) for k, i, _ in want]
        pairs = set(zip((x for *_, w in want for x in w), hashes.tolist()))
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def test_tables_hold_no_row_for_each_prefix_word(spark):
    rng = np.random.default_rng(3)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(3000)])
    rows = [(i, "\n".join(" ".join(rng.choice(words, 40)) for _ in range(8))) for i in range(600)]
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    written = lambda: sum(pq.read_metadata(f).num_rows for f in folder.rglob("*.parquet"))
    before = written()
    df = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in df.collect()) == rows
    assert written() - before < 2 * 8 * len(rows)


def test_lines_with_more_candidates_than_are_named(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    base = [[str(x) for x in rng.choice(words, 20, replace=False)] for _ in range(3)]
    rows = []
    for i in range(150):
        line = list(base[i % 3])
        for _ in range(rng.integers(0, 4)):
            line[rng.integers(20)] = str(rng.choice(words))
        rows.append((i, " ".join(line)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lines, "NAMED", 1)
    monkeypatch.setattr(lines, "LIKELY", 1)
    got = [(r.doc_id, r.text) for r in lines.dedup_lines(df).collect()]
    assert sorted(got) == sorted(brute.line_rows(rows))


def test_similar_lines_beside_many_copied_ones(spark):
    """The bitmap of copied lines lets others through; those are first places too."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 9))
    copied = [f"{word()} {word()}" for _ in range(4000)]
    base = [[word() for _ in range(12)] for _ in range(300)]
    near = [" ".join([*x[:11], word()]) for x in base]
    rows = [(k, "\n".join(copied)) for k in (1, 2)] + [(3, "\n".join(map(" ".join, base))), (4, "\n".join(near))]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in got.collect()} == {1: 0, 2: 4000, 3: 0, 4: 300}


def test_maps_of_long_lines_tell_them_apart_and_lose_none():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for k in range(40):
        line = list(rng.choice(words, 100 + 8 * k, replace=False))
        rows.append(" ".join(line))
        for j in rng.choice(len(line), len(line) // 12, replace=False):
            line[j] = f"x{rng.integers(9999)}"
        rows.append(" ".join(line))
    ids = pa.array(range(len(rows)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(rows)], ["doc_id", "content", "id_hash", "text"])
    x = lines.Lines(batch, np.full(1 << lines.SLOTS, 2, np.uint8), np.zeros(8192, np.uint8))
    maps = x.maps(np.arange(len(x.n))).view(np.int64)
    long, longer = x.n > lines.LONG, x.n > lines.LONGER
    kept = (maps[0], maps[1][long], maps[2][longer], maps[3][longer])
    meeting = lines.Meeting(np.zeros(len(x.n), np.int32), x.ids, x.mark, x.number, x.n, *kept, 0.8)
    doc = dict(zip(x.spot.tolist(), x.ids.tolist()))
    late, early, _, _ = meeting.pairs(None)
    got = {(doc[int(meeting.spot[a])], doc[int(meeting.spot[b])]) for a, b in zip(late, early)}
    sets = [set(r.split()) for r in rows]
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    want = {(i, j) for i in range(len(rows)) for j in range(i) if similar(sets[i], sets[j])}
    assert want and got == want
