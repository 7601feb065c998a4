"""The conversation trie against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quorumlens.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, pos int, size string, key int"


def model(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(own)] for c, own in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = turns.get(c - c % 100 if c >= 0 else -(-c - -c % 100), [])
        whole[c] = tuple(donor[:h] + own[h:])
    members = {}
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members.setdefault(own[:d], []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    def below(path):
        leaves, saved = int(path not in kids), (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        for kid in kids.get(path, []):
            n, s = below(kid)
            leaves, saved = leaves + n, saved + s
        return leaves, saved

    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(whole[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), up, len(own), len(kids.get(path, [])), *below(path), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=4, **shards):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA).repartition(parts)
    turns = tries.settled(tries.ordered_turns(df), "turns")
    conv = F.col("conv_id")
    out = tries.trie(tries.rebuilt(turns, conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5), **shards)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture(params=[{}, {"shard_rows": 7}, {"shard_turns": 9}])
def shards(spark, request):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_matches_a_plain_one(spark, shards):
    rng = random.Random(11)
    says = ["hi", "Hi", "", None, "naïve 日本", "x" * 200]
    rows = []
    for c in [*range(0, 260, 3), 300, 700, 701, 702, 955, -7, -105, -100]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            # A common first turn, and many common second ones.
            text = "hi" if t == 0 and rng.random() < 0.7 else rng.choice(says)
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    copies = [(c, t, r, x) for c in (801, 802, 803) for _, t, r, x in rows if _ == 6]
    rows += copies
    rows += [(950, t, "user", f"turn {t}") for t in range(400)]  # a long one
    rows += [(20, None, "user", "first"), (20, None, None, None), (20, 0, "user", "tie"), (20, 0, "user", "tie")]
    rows += [(None, 0, "user", "nobody's"), (None, 1, "user", "hi")]
    rng.shuffle(rows)
    assert found(spark, rows, **shards) == model(rows)


def test_conversations_that_lose_all_turns_are_members_of_the_root(spark):
    # Their donor is absent and they have fewer turns than are taken.
    rows = [(c, 0, "user", "a") for c in range(101, 140)]
    got = found(spark, rows)
    assert got == model(rows)
    root = next(r for r in got if r[1] == 0)
    assert root[2] is None and root[3] == 39 and root[7] != hashlib.sha256(b"").hexdigest()


def test_no_conversations(spark):
    assert found(spark, [], 1) == [] and found(spark, [(None, 1, "user", "x")], 1) == []


def test_a_hot_first_turn_meets_in_no_task(spark):
    rows = [(c * 100, t, "user", "same" if t == 0 else f"{c}") for c in range(1_000) for t in range(2)]
    turns = tries.ordered_turns(spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA))
    start = turns.where("pos = 1").select("conv_id", F.lit(0).alias("pos"))
    hot = tries.local_nodes(turns.unionByName(start, allowMissingColumns=True), shard_rows=50).where("depth = 1").select("n").collect()
    assert len(hot) >= 20 and max(r.n for r in hot) <= 50 and sum(r.n for r in hot) == 1_000
