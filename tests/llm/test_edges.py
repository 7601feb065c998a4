"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from quorumlens.llm import bpe, decontaminate, lines, records, secrets, simhash, suffixes, toxicity, urls, vectors
from tests.llm import brute

SCHEMA = (
    "doc_id long, text string, lang string, content string, row int, kept int, score string, ids string, spans string, "
    "fingerprint int, matches int, n_lines int, secrets int"
)
PROSE = "the quick brown fox jumps over the lazy dog while seven grey geese look on from the far bank of the river"
LONG = " ".join(f"word{k % 977} turn{k % 13}" for k in range(12_000))


def frame(spark, rows):
    filled = [(i, t, "en", "c", 1, 2, "s", "i", "p", 3, 4, 5, 6) for i, t in rows]
    return spark.createDataFrame(filled, SCHEMA)


ROWS = [
    (1, PROSE + "\n" + PROSE + "!\nshort"),
    (2, None),
    (3, ""),
    (4, "   \n\n \t"),
    (5, PROSE + "\n" + PROSE + "!\nshort"),
    (5, PROSE + "\n" + PROSE + "!\nshort"),
    (6, LONG),
    (7, LONG + " tail"),
    (None, "nobody " + PROSE),
    (8, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3).cache()


def pairs(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_bpe(spark, docs):
    path = P.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(docs, path, reused=50), path)
    assert sorted(coded.columns) == sorted([*docs.columns, "decoded"])
    got = sorted(((r.doc_id, r.text, len(r.ids), r.decoded) for r in coded.collect()), key=str)
    want = {brute.bpe_rows([(0, t)], path)[0][1]: t for _, t in ROWS}
    assert all(d == (t or "") for _, t, _, d in got)
    assert {n for _, _, n, _ in got} == set(want)
    assert bpe.encode(docs.limit(0), path).count() == 0


def test_bpe_joins_repair_at_any_cut(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    for name, value in (("CHUNK_LEAST", 5), ("CHUNK_EXTRA_BITS", 2), ("CHUNK_MOST", 20), ("REPAIR", 4)):
        monkeypatch.setattr(bpe, name, value)
    rng = np.random.default_rng(3)
    parts = ["the", " the", "'s", "'", "  ", " ", "\n", ".", " 12", "a", "\t", "é", "<|endoftext|>", "ü日"]
    for _ in range(300):
        text = "".join(rng.choice(parts, rng.integers(1, 120)))
        data, at, known = text.encode(), 0, {}
        for end in bpe.cuts(data):
            raw = data[at:end]
            if rng.random() < 0.7 and bpe.load(path).plain(raw.decode()):
                known[bpe.xxhash.xxh64_intdigest(raw)] = bpe.chunk_entry(path, raw)
            at = end
        worker = bpe.Assembler(path, known)
        assert worker.encode(text) == worker.pieces.by_library(text)


def test_records(spark, docs, tmp_path):
    path = P.path("word_bpe_49k.json")
    few = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    folder = records.write_records(few, str(tmp_path / "r"), path, end_id=1)
    got = records.scan_records(spark, folder).orderBy("shard", "position").collect()
    own = sorted({i: t for i, t in ROWS if i is not None}.items())
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, n) for i, _, n, _ in brute.record_rows(own, path)]
    index = spark.read.parquet(f"{folder}/index").orderBy("doc_id")
    assert [r.start for r in index.collect()] == [s for _, s, _, _ in brute.record_rows(own, path)]
    some = records.read_records(spark, folder, index.where("doc_id in (3, 7)"))
    assert {(r.doc_id, r.n_tokens) for r in some.collect()} == {(r.doc_id, r.n_tokens) for r in got if r.doc_id in (3, 7)}
    whole = records.write_records(docs, str(tmp_path / "all"), path, end_id=1)
    assert records.scan_records(spark, whole).count() == len(ROWS)
    none = records.write_records(docs.limit(0), str(tmp_path / "none"), path, end_id=1)
    assert records.scan_records(spark, none).count() == 0


def test_a_changed_record_is_found():
    raw = bytearray(records.frame(7, np.arange(5), 2) + records.frame(None, np.arange(3), 4))
    assert [(i, list(x)) for _, _, i, x in records.unframe(bytes(raw))] == [(7, [0, 1, 2, 3, 4]), (None, [0, 1, 2])]
    raw[20] ^= 1
    with pytest.raises(ValueError):
        list(records.unframe(bytes(raw)))
    with pytest.raises(ValueError):
        list(records.unframe(bytes(raw[:10])))


def test_simhash(spark, docs):
    got = pairs(simhash.near_duplicates(docs.where("doc_id is not null")), "doc_id", "fingerprint", "component_id")
    want = brute.simhash_rows([r for r in ROWS if r[0] is not None], 4, 4)
    assert [(i, f"{f & 0xFFFFFFFFFFFFFFFF:016x}", c) for i, f, c in got] == sorted(want, key=str)
    kept = simhash.keep_one(docs, radius=4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 0 and 1 in ids and (6 in ids) and 7 not in ids and len({2, 3, 4} & set(ids)) == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_simhash_full_cells_are_cut(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(150):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            fps.add(int(b) ^ sum(1 << int(k) for k in flips))
    rows = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps], "fp long")
    arr = np.array(sorted(fps), np.uint64)
    close = [(int(a), int(b)) for k, a in enumerate(arr) for b in arr[k + 1 :][np.bitwise_count(arr[k + 1 :] ^ a) <= 4]]
    want = brute.union([int(x) for x in arr], close)
    for limit in (8192, 16):
        edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(rows, 4, limit).collect()]
        assert brute.union([int(x) for x in arr], edges) == want, limit


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    rows = [(k, base[k % 40] + 0.02 * rng.standard_normal(16)) for k in range(400)]
    rows = [(k, [float(x) for x in v]) for k, v in rows] + [(1000 + k, rows[0][1].tolist()) for k in range(30)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0] + [None] * 15)]
    rows += [(2005, [float("inf")] + [1.0] * 15), (2006, [1e-30] * 16), (2007, [1e30] * 16), (2008, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit("x"))
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    keep = {2006, 2007}
    got = pairs(vectors.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
    want = brute.vector_rows([r for r in stored if r[0] != 2008])
    assert [g for g in got if g[0] not in keep | {2008}] == sorted((w for w in want if w[0] not in keep), key=str)
    links = {g[0]: g for g in got}
    assert links[2006][2] == links[2007][2] == 2006 and links[2008] == (2008, 0, 2008, True)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_slots_are_cut(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SLOT_ROWS", 16)
    monkeypatch.setattr(vectors, "VISITORS", 8)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((6, 8))
    rows = [(k, (base[k % 6] + 0.05 * rng.standard_normal(8)).astype(np.float32).tolist()) for k in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pairs(vectors.near_duplicates(df, recall=1.0), "vec_id", "n_links", "component_id", "kept")
    assert got == sorted(brute.vector_rows(rows), key=str)


def test_decontamination(spark, docs):
    items = spark.createDataFrame(
        [(1, PROSE), (2, None), (3, ""), (4, "x"), (5, LONG[4000:4400]), (6, "nothing of that kind is here at all")],
        "item_id long, text string",
    )
    got = decontaminate.search(docs, items)
    assert got.columns == [c for c in docs.columns if c != "matches"] + ["matches"]
    found = {(r.doc_id, m.item_id) for r in got.collect() for m in r.matches}
    rows = [(r.item_id, r.text) for r in items.collect()]
    assert found == brute.leaks(ROWS, rows)
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {2, 3, 4}
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.search(docs.limit(0), items).count() == 0


def test_lines(spark, docs):
    got = lines.dedup_lines(docs)
    assert sorted(got.columns) == sorted([*docs.columns, "n_removed"])
    texts = {r.doc_id: r.text for r in got.collect()}
    own = dict((i, t) for i, t in ROWS if i is not None)
    want = dict(brute.line_rows([(-1, ROWS[8][1]), *own.items()]))
    assert texts[None] == want[-1] and texts[2] is None
    assert {i: t for i, t in texts.items() if i not in (None, 2)} == {i: t for i, t in want.items() if i not in (-1, 2)}
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_lines_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)]
    base = [[str(x) for x in rng.choice(words, rng.integers(1, 25))] for _ in range(40)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(5):
            line = list(base[rng.integers(40)])
            for _ in range(rng.integers(0, 3)):
                line[rng.integers(len(line))] = str(rng.choice(words))
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    want = brute.line_rows(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (8192, 12):
        monkeypatch.setattr(lines, "WORD_ROWS", limit)
        assert pairs(lines.dedup_lines(df), "doc_id", "text") == sorted(want, key=str), limit


def test_substrings(spark, docs):
    got = suffixes.dedup_substrings(docs)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = {r.doc_id: r for r in got.collect()}
    own = sorted({i: t for i, t in ROWS if i is not None}.items())
    for i, n, gone, spans, _ in brute.repeats([(-1, ROWS[8][1]), *own]):
        r = rows[None if i == -1 else i]
        assert (sum(s.end - s.begin for s in r.spans), len(r.spans)) == (gone, spans), i
    assert suffixes.dedup_substrings(docs.limit(0)).count() == 0


def test_substrings_against_brute_force(spark):
    rng = np.random.default_rng(8)
    alphabet = list("abcdé \n")
    pool = ["".join(rng.choice(alphabet, rng.integers(60, 400))) for _ in range(12)] + ["z" * 300, "ab" * 200]
    rows = []
    for i in range(60):
        own = "".join(rng.choice(alphabet, rng.integers(0, 120)))
        rows.append((i, own + "".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 4)))))
    got = suffixes.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    import hashlib

    found = sorted(
        (
            r.doc_id,
            len(r.text.encode()),
            sum(s.end - s.begin for s in r.spans),
            len(r.spans),
            hashlib.sha256(suffixes.kept_bytes(r.text, [s.asDict() for s in r.spans])).hexdigest(),
        )
        for r in got
    )
    assert found == brute.repeats(rows)


def test_secrets(spark, docs):
    odd = [
        (1, None), (2, ""), (3, "Token:secret=abcdefghijkl é password = 'aaaa' api_key:\"Zm9vYmFyYmF6cXV4MTIzNDU2Nzg5MGFi\""),
        (4, "é" * 50 + "AKIA" + "Q" * 14 + " AKIAAKIA12 deadbeefdeadbeef DEADBEEF"), (5, "0f" * 500),
        (6, "x=" + "aB3dE6gH9jK2mN5pQ8rS" * 200), (7, "token=token=abc passwd : 0123456789ab"),
        (8, "A1b2C3d4E5f6G7h8I9j0K1l2" + "-" * 60 + "Z9y8X7w6V5u4T3s2R1q0P9o8"),
    ]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    found = secrets.scan(df).select("doc_id", secrets.written(F.col("secrets")).alias("s")).collect()
    assert sorted((r.doc_id, r.s) for r in found) == [(i, s) for i, *_, s in brute.secret_rows(odd)]
    both = secrets.scan(docs)
    assert sorted(both.columns) == sorted(docs.columns) and both.count() == len(ROWS)
    assert secrets.scan(docs.limit(0)).count() == 0


def test_urls(spark):
    rules = [("allow", "org", "/"), ("block", "bad.org", "/a"), ("block", "com", "/x/")]
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.ORG"), (6, "http://Bad.Org/a?x#y"),
            (7, "http://sub.bad.org/b"), (8, "http://notbad.org/a"), (9, "x://k.com/x/1"), (9, "x://k.com/x/1"),
            (None, "http://é.net/ü#z"), (10, "http://u@h.com:80?/x/"), (11, "http://" + "long" * 5000 + ".org/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {(r.page_id, r.host, r.path, r.rule) for r in urls.judge(df, rules).collect()}
    assert {g for g in got if g[0] != 11} == {
        (1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "", "", None), (5, "a.org", "", None),
        (6, "bad.org", "/a", "bad.org/a"), (7, "sub.bad.org", "/b", "org/"), (8, "notbad.org", "/a", "org/"),
        (9, "k.com", "/x/1", "com/x/"), (None, "é.net", "/ü", None), (10, "u@h.com:80", "", None),
    }
    out = urls.judge(df, rules)
    assert out.count() == len(rows)
    assert {r.verdict for r in out.where("page_id = 9").collect()} == {"block"}
    assert {r.verdict for r in urls.judge(df, []).collect()} == {"allow"}
    assert urls.judge(df.limit(0), rules).count() == 0


def test_toxicity(spark, docs):
    rng = np.random.default_rng(9)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ala", "eno", "iru", "osi")]
    bad = ["vilebrute", "rottenfool", "nastycreep"]
    rows, marks = [], []
    for i in range(600):
        text = [str(w) for w in rng.choice(words, rng.integers(20, 80))]
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            text.insert(int(rng.integers(len(text))), str(rng.choice(bad)))
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    found = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    truth = dict(marks)
    held = [i for i in found if toxicity_fold(i) == 0]
    assert np.mean([(found[i] >= 0.5) == truth[i] for i in held]) > 0.95
    odd = toxicity.score(docs, model)
    assert sorted(odd.columns) == sorted(docs.columns) and odd.count() == len(ROWS)
    assert all(0 <= r.score <= 1 for r in odd.collect())
    none = toxicity.fit(df, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    one = toxicity.fit(df, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.score(docs, one).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def toxicity_fold(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5


def test_pipeline_on_odd_rows(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame([(1, LONG[4000:4400])], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            folder = str(tmp_path / f"{name}-{rows is docs}")
            stage(spark, now, str(tmp_path)).write.parquet(folder)
            now = spark.read.parquet(folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns, name
    assert now.count() == 0


