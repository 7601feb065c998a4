"""The Merkle manifest against a plain one, on groups of every shape."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quorumlens.llm import manifest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, text string, size string, digest int, path string, tree string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, k):
    found = []
    for nodes in levels[:-1]:
        run = nodes[k // 16 * 16 : k // 16 * 16 + 16]
        found += run[: k % 16] + run[k % 16 + 1 :]
        k //= 16
    return found


def fold(digest, levels, k):
    for nodes in levels[:-1]:
        run = nodes[k // 16 * 16 : k // 16 * 16 + 16]
        digest = sha("".join(run[: k % 16] + [digest] + run[k % 16 + 1 :]))
        k //= 16
    return digest


def model(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    groups = {}
    for i, s, t in rows:
        groups.setdefault(s, []).append((i, leaf(i, s, t), t))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = levels_of([r[1] for r in groups[s]])
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for k, (i, own, text) in enumerate(groups[s]):
            other = own
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                other = leaf(i, s, text if text is None else text.translate(LOW))
            folded = fold(fold(other, trees[s], k), top, n)
            proof = sha("".join(siblings(trees[s], k) + siblings(top, n)))
            out.append((i, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def proved(spark, rows, parts=5):
    df = spark.createDataFrame([(i, s, t, "x", 1, "p", "t") for i, s, t in rows], SCHEMA).repartition(parts)
    fields = [F.col("doc_id"), F.col("source")]
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keep = {"tampered": F.when(hit, manifest.leaf_digest(*fields, low))}
    made = manifest.build(df, manifest.leaf_digest(*fields, F.col("text")), "source", "doc_id", keep)

    def same(batches):
        yield from batches

    kinds = "tree long, idx long, size long, digest string, group string, id long, k_tampered string, path string, note string"
    out = []
    for r in manifest.prove(made, same, kinds).collect():
        shape = manifest.shape_of(r.idx, r.size) + manifest.shape_of(r.tree, made.groups)
        assert manifest.fold(r.digest, r.path, shape) == made.root
        folded = manifest.fold(r.k_tampered or r.digest, r.path, shape)
        out.append((r.id, r.digest, r.note, made.root, sha(r.path), folded, folded == made.root))
    return made, out


@pytest.fixture
def many_parts(spark):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_every_shape_of_group(spark, many_parts):
    rng = random.Random(3)
    sizes = {"one": 1, "two": 2, "run": 16, "over": 17, "block": 256, "beyond": 257, "hot": 4_200, "": 33, "é": 5, "Z": 7, None: 20}
    rows = [(k if n != 7 else -k, s, f"Text {k} {rng.random()}") for s, n in sizes.items() for k in range(n)]
    rows += [(None, "two", "a"), (None, "two", None), (5, "hot", "Twin"), (5, "hot", "Twin"), (5, "hot", ""), (6, None, "ÄÖ A")]
    rng.shuffle(rows)
    made, got = proved(spark, rows)
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(model(rows), key=key)
    # Level 1 and 3 of the hot group are not kept.
    assert len(made.levels) == 3 and made.levels[1].where("size = 4203").count() == 17


def test_many_groups_make_a_deep_last_tree(spark, many_parts):
    rows = [(k % 3, f"s{k % 300:03d}", str(k)) for k in range(700)]
    made, got = proved(spark, rows)
    key = lambda r: tuple(map(str, r))
    assert made.groups == 300 and sorted(got, key=key) == sorted(model(rows), key=key)


def test_one_row_and_none(spark):
    made, got = proved(spark, [(1, "s", "Only")], 1)
    assert got == model([(1, "s", "Only")]) and made.root == got[0][1]
    made, got = proved(spark, [], 1)
    assert (made.root, made.groups, got) == (None, 0, [])


def test_fields_cannot_run_together():
    assert len({leaf("a", "bc"), leaf("ab", "c"), leaf(None, "abc"), leaf("", "abc"), leaf("-", "abc")}) == 5
