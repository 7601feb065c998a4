"""Walks over range partitions against plain models, with every partition boundary in use."""

from __future__ import annotations

import bisect
import ipaddress
import random

import pytest

from quorumlens.functions import addresses as A
from quorumlens.operators import intervals, ordered


@pytest.fixture
def many_parts(spark):
    """Small tables keep all their partitions."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def model(starts, ranges, at):
    k = bisect.bisect_right(starts, at) - 1 if at is not None else -1
    return ranges[k][2] if k >= 0 and at <= ranges[k][1] else None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_of_takes_the_greatest_start(spark, many_parts, seed):
    rng = random.Random(seed)
    lows = rng.sample(range(0, 20_000), 60)
    # Nested and overlapping ranges; one spans nearly everything.
    ranges = sorted((lo, lo + rng.choice([0, 5, 300, 4_000]), f"r{lo}") for lo in lows) if seed != 3 else [(7, 10**6, "one")]
    if seed == 2:
        ranges[0] = (ranges[0][0], 10**6, "wide")
    # A third of the probes ask for one address; some have none.
    probes = [(k, rng.choice([None, 9_999, 9_999, rng.randint(0, 25_000)]), rng.random()) for k in range(3_000)]
    df = spark.createDataFrame(probes, "k int, lo long, x double").repartition(5)
    table = spark.createDataFrame(ranges, "lo long, hi long, name string")
    got = {r.k: (r.lo, r.x, r.match and r.match.name) for r in ordered.as_of(df, table, ["name"]).collect()}
    starts = [r[0] for r in ranges]
    assert got == {k: (lo, x, model(starts, ranges, lo)) for k, lo, x in probes}


def test_as_of_without_ranges_or_probes(spark, many_parts):
    probes = spark.createDataFrame([(1, 5)], "k int, lo long")
    none = spark.createDataFrame([], "lo long, hi long, name string")
    assert [(r.k, r.match) for r in ordered.as_of(probes, none, ["name"]).collect()] == [(1, None)]
    assert ordered.as_of(probes.limit(0), none, ["name"]).count() == 0


def collapse_model(texts):
    nets = [ipaddress.ip_network(t) for t in texts]
    out = set()
    for parent in ipaddress.collapse_addresses(nets):
        members = [str(n) for n in nets if n.subnet_of(parent)]
        if len(members) > 1:
            out |= {(str(parent), m, len(members)) for m in members}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_runs_of_any_width_and_depth(spark, many_parts, seed):
    rng = random.Random(seed)
    texts = set()
    for _ in range(60):
        base = rng.choice([0x2A00 << 112, 0x2001 << 112, rng.getrandbits(128)])
        prefix = rng.choice([16, 24, 44, 60, 64, 100, 120, 126, 128])
        size = 1 << (128 - prefix)
        first = base // size * size
        for k in range(rng.choice([1, 2, 3, 8])):
            if first + (k + 1) * size <= 1 << 128:
                texts.add(f"{ipaddress.IPv6Address(first + k * size)}/{prefix}")
    # A block filled by one network a level, down to single addresses: 128 levels deep.
    if seed == 1:
        texts |= {f"{ipaddress.IPv6Address((1 << 127) >> k)}/{k + 1}" for k in range(128)} | {"::/128"}
    if seed == 2:  # one network around nearly all others, over many partitions
        texts.add("2000::/3")
    if seed == 3:  # a long run over many partitions
        texts |= {f"2a00:{k:x}::/32" for k in range(600)}
    rows = A.with_address(spark.createDataFrame([(t,) for t in sorted(texts)] * 2, "t string"), "t", "network").drop("t")
    runs = intervals.aggregated_runs(rows)
    got = {
        (f"{ipaddress.IPv6Address(bytes(r.block))}/{r.block_prefix}", r.member, r.members) for r in runs.collect()
    }
    assert got == collapse_model(texts)


def test_no_networks_no_runs(spark, many_parts):
    rows = A.with_address(spark.createDataFrame([], "t string"), "t", "network").drop("t")
    assert intervals.aggregated_runs(rows).count() == 0


def test_places_in_groups_over_partitions(spark, many_parts):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    # One group has half of the rows, one a single row; a null is a group too.
    rows = [(rng.choice(["big"] * 6 + ["a", "b", "c", None, "zz"]), k) for k in range(3_000)] + [("one", 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int")
    got = {(r.g, r.k): r.place for r in ordered.ranked(df, "g", [F.col("k").desc()], "place").collect()}
    for g in {g for g, _ in rows}:
        own = sorted((k for x, k in rows if x == g), reverse=True)
        assert [got[g, k] for k in own] == list(range(1, len(own) + 1)), g
    assert ordered.ranked(df.limit(0), "g", [F.col("k")], "place").count() == 0
