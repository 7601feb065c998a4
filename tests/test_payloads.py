"""Range lines of both families against the standard library, and files that are read by their own readers."""

from __future__ import annotations

import gzip
import ipaddress
import random

from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.sources import ingest
from quorumlens.sources.registry import REGISTRY_SCHEMA
from tests.test_scoring import NOW, source


def test_ranges_are_cut_as_the_standard_library_cuts_them(spark):
    rng = random.Random(9)
    pairs = []
    for width, make in ((32, ipaddress.IPv4Address), (128, ipaddress.IPv6Address)):
        top = (1 << width) - 1
        for _ in range(150):
            a = rng.getrandbits(width) >> rng.choice([0, 0, width // 2, width - 6])
            b = min(top, a + rng.getrandbits(rng.randint(1, width)))
            if rng.random() < 0.3:  # aligned ends
                k = rng.randint(0, width)
                a, b = a >> k << k, (b >> k << k) | ((1 << k) - 1)
            pairs.append((str(make(a)), str(make(max(a, b)))))
        pairs += [(str(make(x)), str(make(y))) for x, y in ((0, top), (0, 0), (top, top), (0, top - 1), (1, top), (5, 5))]
    bad = [("1.2.3.4", "1.2.3.3"), ("::2", "::1"), ("1.2.3.4", "::5"), ("x", "1.2.3.4"), (None, None), ("::1", "")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs + bad)], "k int, a string, b string")
    got: dict[int, list] = {}
    for r in A.with_range_networks(df, "a", "b").collect():
        got.setdefault(r.k, []).append(r)
    for k, (a, b) in enumerate(pairs):
        nets = list(ipaddress.summarize_address_range(ipaddress.ip_address(a), ipaddress.ip_address(b)))
        assert sorted(r.indicator for r in got[k]) == sorted(map(str, nets)), (a, b)
        by_text = {str(n): n for n in nets}
        for r in got[k]:
            n = by_text[r.indicator]
            low, high = (r.lo, r.hi) if r.family == 4 else (int.from_bytes(r.lo6), int.from_bytes(r.hi6))
            assert (low, high, r.prefix, r.is_net) == (int(n[0]), int(n[-1]), n.prefixlen, True)
    for k in range(len(pairs), len(pairs) + len(bad)):
        assert [r.indicator for r in got[k]] == [None]


def test_range_lines_stay_in_the_jvm(spark):
    sources = spark.createDataFrame([source("s", "one")], REGISTRY_SCHEMA)
    raw = spark.createDataFrame([("s", "1.0.0.0 1.0.0.9 24"), ("s", "2a00:: 2a00::5 x"), ("s", "1.0.0.0 1.0.0.9")], "source string, line string")
    parsed = ingest.range_list(raw, sources, NOW)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = parsed.groupBy("status").agg(F.count("*").alias("n")).collect()
    assert {r.status: r.n for r in rows} == {"ok": 4, "malformed": 1}


def test_ranges_are_cut_by_generated_code_in_all_tasks(spark):
    sources = spark.createDataFrame([source("s", "one")], REGISTRY_SCHEMA)
    raw = spark.range(400).coalesce(1).selectExpr("'s' as source", "concat('2a00::1 2a00::', hex(id + 1), ' 24') as line")
    parsed = ingest.range_list(raw, sources, NOW)
    assert parsed.select(F.spark_partition_id().alias("task")).distinct().count() > 1
    nets = A.with_range_networks(raw.selectExpr("split(line, ' ')[0] as a", "split(line, ' ')[1] as b"), "a", "b")
    plan = nets._jdf.queryExecution().optimizedPlan().toString().splitlines()
    cut = next(k for k, line in enumerate(plan) if "Generate explode" in line)
    assert not [line for line in plan[: cut + 1] if "lambda" in line]  # lambdas are interpreted: only the two ends are parsed by them


def test_ranges_across_the_halves_of_an_address(spark):
    edges = [0, 1, 2**32, 2**63 - 1, 2**63, 2**64 - 1, 2**64, 2**64 + 1, 2**65 - 1, 2**127 - 1, 2**127, 2**127 + 2**64, 2**128 - 2, 2**128 - 1]
    pairs = [(a, b) for a in edges for b in edges if a <= b]
    pairs += pairs[:3]
    rows = [(k, str(ipaddress.IPv6Address(a)), str(ipaddress.IPv6Address(b))) for k, (a, b) in enumerate(pairs)]
    got: dict[int, list] = {}
    for r in A.with_range_networks(spark.createDataFrame(rows, "k int, a string, b string"), "a", "b").collect():
        got.setdefault(r.k, []).append((int.from_bytes(r.lo6), int.from_bytes(r.hi6), r.prefix, r.indicator, r.lo, r.hi))
    for k, (a, b) in enumerate(pairs):
        nets = ipaddress.summarize_address_range(ipaddress.IPv6Address(a), ipaddress.IPv6Address(b))
        assert sorted(got[k]) == sorted((int(n[0]), int(n[-1]), n.prefixlen, str(n), None, None) for n in nets), (a, b)


def test_a_broken_gzip_file_is_its_own_failure(spark, tmp_path):
    lines = [f"9.0.{k // 250}.{k % 250}" for k in range(30_000)]
    whole = gzip.compress("\n".join(lines).encode())
    for name, data in {
        "good": whole + gzip.compress(b"9.1.1.1\n9.1.1.2\n"),
        "cut": whole[: len(whole) // 2],
        "flipped": whole[:200] + bytes([whole[200] ^ 255]) + whole[201:],
        "plain": b"9.0.0.1\n",
        "empty": gzip.compress(b""),
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.gz").write_bytes(data)
    (tmp_path / "cut" / "y.gz").write_bytes(whole)
    names = ["good", "cut", "flipped", "plain", "empty"]
    read, failed = ingest.read_gzipped(spark, {n: str(tmp_path / n) for n in names})
    assert {r.source for r in failed.collect()} == {"cut", "flipped", "plain"}
    counts = {r.source: r["count"] for r in read.groupBy("source").count().collect()}
    # The first member has no last line end, so its last line goes on in the second.
    assert counts == {"good": len(lines) + 1}
    assert read.filter("line = '9.1.1.2'").count() == 1


def test_levels_are_told_by_path(spark, tmp_path):
    rows = [source("lv", "one", url="lists/{level}.txt", levels=[1, 2], parser="ipsum_levels"), source("pl", "two", url="pl dir/all")]
    registry = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    folder = tmp_path / "in put"
    (folder / "lists").mkdir(parents=True)
    (folder / "pl dir/all").mkdir(parents=True)
    (folder / "lists/1.txt").write_text("9.0.0.1\n")
    (folder / "lists/2.txt").write_text("9.0.0.2\n9.0.0.1\n")
    (folder / "pl dir/all/part-0.txt").write_text("9.0.0.3\n")
    got = sorted((r.source, r.level or 0, r.line) for r in ingest.read_registered(spark, registry, str(folder)).collect())
    assert got == [("lv", 1, "9.0.0.1"), ("lv", 2, "9.0.0.1"), ("lv", 2, "9.0.0.2"), ("pl", 0, "9.0.0.3")]


def test_tag_cells_keep_their_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Address,Tags\n9.0.0.1,"ssh,\ntelnet"\n# note\n9.0.0.2,"say ""x"""\n9.0.0.3\n')
    sources = spark.createDataFrame([source("s", "one")], REGISTRY_SCHEMA)
    raw = ingest.read_tag_tables(spark, {"s": str(tmp_path / "t.csv")})
    got = {r.indicator: r.tags for r in ingest.accepted(ingest.tagged_csv(raw, sources, NOW)).collect()}
    assert got["9.0.0.1"] == ["turris-ssh", "turris-telnet"] and set(got) == {"9.0.0.1", "9.0.0.2", "9.0.0.3"}
