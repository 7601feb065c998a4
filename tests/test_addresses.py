"""Address functions against the standard library."""

from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.operators import intervals

ODD = """1.2.3.4/255.255.255.0 1.2.3.4/0.0.0.255 1.2.3.4/0.0.0.0 1.2.3.4/024 01.2.3.4 1.2.3 1.2.3.4.5
256.1.1.1 :: ::1 1::2::3 ::: 1:2:3:4:5:6:7:8:9 1:2:3:4:5:6:7:: ::2:3:4:5:6:7:8 1:2:3:4:5:6:7:8:: :1::2 1::2:
g::1 12345::  64:ff9b::1.2.3.4 64:ff9b::1.2.3.400 x 1.2.3.4/33 1.2.3.4/ ::/129 ::/ FE80::ABCD 224.0.0.0/3
0.0.0.0/0 ::/0 4000::/2 1.2.3.4/-1 1.2.3.4/255.0.255.0 100.64.0.1""".split()


def samples() -> list[str]:
    rng = random.Random(1)
    out = list(ODD)
    for _ in range(60):
        v6 = rng.getrandbits(128)
        for g in range(8):
            if rng.random() < 0.5:
                v6 &= ~(0xFFFF << (16 * g))
        out += [
            str(ipaddress.IPv4Address(rng.getrandbits(32))),
            f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.randint(0, 32)}",
            str(ipaddress.IPv6Address(v6)),
            f"{ipaddress.IPv6Address(v6).exploded}/{rng.randint(0, 128)}",
        ]
    special = K.V4_PRIVATE + K.V4_PRIVATE_EXCEPT + K.V6_PRIVATE + K.V6_PRIVATE_EXCEPT + K.V6_RESERVED
    for cidr in special:
        net = ipaddress.ip_network(cidr)
        out += [cidr, str(net.network_address), str(net.broadcast_address), str(net.supernet())]
        for end, step in ((net.network_address, -1), (net.broadcast_address, 1)):
            try:
                out.append(str(end + step))
            except ipaddress.AddressValueError:
                pass
    return out


def expected(text: str):
    try:
        item = ipaddress.ip_address(text)
    except ValueError:
        try:
            item = ipaddress.ip_network(text, strict=False)
        except ValueError:
            return None
    net = hasattr(item, "prefixlen")
    low = int(item.network_address if net else item)
    high = int(item.broadcast_address if net else item)
    special = (
        item.is_private or item.is_loopback or item.is_link_local or item.is_reserved or item.is_multicast
    )
    count = item.num_addresses if net else 1
    scope = count if item.version == 4 else max(count >> 64, 1)
    return (
        str(item), item.version, net, item.prefixlen if net else None, low, high,
        not special, min(count, 1 << 24), scope,
    )


def test_entries_match_standard_library(spark):
    texts = samples()
    df = A.with_address(spark.createDataFrame([(t,) for t in texts], "t string"), "t").select(
        "*",
        A.is_global().alias("ok"),
        A.entry_weight().alias("w"),
        A.subnets_64().alias("scope"),
        A.v6_decimal_text(F.col("lo6")).alias("dec"),
    )
    for row in df.collect():
        want = expected(row.t)
        if want is None:
            assert row.indicator is None, row.t
            continue
        if "::ffff:" in want[0]:
            continue
        low = row.lo if row.family == 4 else int.from_bytes(row.lo6, "big")
        high = row.hi if row.family == 4 else int.from_bytes(row.hi6, "big")
        got = (
            row.indicator, row.family, row.is_net, row.prefix, low, high, row.ok, row.w, int(row.scope),
        )
        assert got == want, row.t
        if row.family == 6:
            assert row.dec == str(low)


@pytest.mark.parametrize("accept,kept", [("address", {"9.9.9.9"}), ("network", {"9.9.9.9/32", "8.8.8.0/24"})])
def test_accept_modes(spark, accept, kept):
    df = spark.createDataFrame([("9.9.9.9",), ("8.8.8.8/24",), ("no",)], "t string")
    rows = A.with_address(df, "t", accept).filter("indicator is not null").collect()
    assert {r.indicator for r in rows} == kept


def test_range_cover_is_minimal(spark):
    rng = random.Random(2)
    ranges = [(0, 2**32 - 1), (5, 5)]
    for _ in range(80):
        a = rng.getrandbits(32)
        ranges.append((a, min(2**32 - 1, a + rng.getrandbits(rng.randint(0, 32)))))
    df = spark.createDataFrame(ranges, "a bigint, b bigint")
    got: dict = {}
    for r in A.cover_v4_range(df, "a", "b").collect():
        got.setdefault((r.a, r.b), []).append((r.block_lo, r.block_prefix))
    for a, b in ranges:
        nets = ipaddress.summarize_address_range(ipaddress.IPv4Address(a), ipaddress.IPv4Address(b))
        assert sorted(got[(a, b)]) == [(int(n.network_address), n.prefixlen) for n in nets]


def entry_frame(spark, texts, accept="entry"):
    return A.with_address(spark.createDataFrame([(t,) for t in texts], "t string"), "t", accept).drop("t")


def test_overlap_both_directions_and_families(spark):
    rng = random.Random(3)
    allowed = ["10.0.0.0/8", "9.9.9.0/24", "9.9.0.0/16", "1.2.3.4/32", "2a00:1::/32", "2a00:2:3::/48"]
    texts = ["9.9.9.9", "9.8.0.0/15", "1.2.3.0/24", "1.2.3.5", "2a00:1:5::/40", "2a00:2::/24", "2a00:2:4::1", "2a00:2:3::1"]
    for _ in range(100):
        texts.append(f"{rng.choice([1, 9, 10, 11])}.{rng.choice([2, 9])}.{rng.choice([3, 9])}.{rng.randint(0, 9)}")
        texts.append(f"9.{rng.randint(0, 12)}.0.0/{rng.randint(6, 24)}")
        texts.append(f"2a00:{rng.randint(1, 3)}:{rng.randint(1, 4)}::/{rng.randint(16, 64)}")
    entries = entry_frame(spark, texts).distinct()
    nets = [ipaddress.ip_network(a) for a in allowed]
    for row in intervals.flag_overlap(entries, entry_frame(spark, allowed, "network")).collect():
        item = ipaddress.ip_network(row.indicator)
        want = any(n.version == item.version and n.overlaps(item) for n in nets)
        assert row.allowlisted == want, row.indicator


def test_lookup_prefers_text_then_first_containing(spark):
    published = entry_frame(spark, ["9.9.0.0/16", "9.9.9.0/24", "9.9.9.9", "2a00:1::/32", "2a00:1:2::/48"])
    targets = ["9.9.9.9", "9.9.9.10", "9.8.0.1", "2a00:1:2::5", "2a00:2::1", "junk"]
    df = A.with_address(spark.createDataFrame([(t,) for t in targets], "target string"), "target", "address")
    got = {r.target: (r.matched, r.match_kind) for r in intervals.explain_targets(df, published).collect()}
    assert got == {
        "9.9.9.9": ("9.9.9.9", "exact"),
        "9.9.9.10": ("9.9.0.0/16", "inside"),
        "9.8.0.1": (None, "absent"),
        "2a00:1:2::5": ("2a00:1::/32", "inside"),
        "2a00:2::1": (None, "absent"),
        "junk": (None, "invalid"),
    }


def test_contiguous_runs_match_collapse(spark):
    rng = random.Random(4)
    texts = {f"2a00:{rng.randint(1, 3):x}:{rng.randint(0, 31):x}::/{rng.choice([46, 47, 48, 48, 48])}" for _ in range(90)}
    texts |= {"2a00:9::/33", "2a00:9:8000::/33", "2a00:9:1::/48"}
    nets = {ipaddress.ip_network(t, strict=False) for t in texts}
    want = set()
    for parent in ipaddress.collapse_addresses(nets):
        members = [n for n in nets if n.subnet_of(parent)]
        if len(members) > 1:
            want |= {(str(parent), str(m)) for m in members}
    runs = intervals.aggregated_runs(entry_frame(spark, sorted(texts), "network"))
    rows = runs.select(F.concat(A.v6_text("block"), F.lit("/"), "block_prefix").alias("p"), "member").collect()
    assert {(r.p, r.member) for r in rows} == want and len(rows) == len(want)
