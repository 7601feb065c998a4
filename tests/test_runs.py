"""Several runs in one folder: publishing, histories, documents, and the order of what is written."""

from __future__ import annotations

import glob
import ipaddress
import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.operators import safety
from quorumlens.plans import run as plan
from quorumlens.session import written
from quorumlens.sinks import publish, writers
from quorumlens.sources.registry import REGISTRY_SCHEMA
from tests.test_scoring import NOW, OBS, REGISTRY, allow_frame, configured, obs


def key(text):
    net = ipaddress.ip_network(text)
    return net.version, int(net.network_address), net.prefixlen if "/" in text else 128


def test_every_list_is_in_address_order_over_its_parts(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for k in range(6_000):
        octets = ".".join(str(rng.randint(1, 220)) for _ in range(4))
        text = f"2a00:{rng.getrandbits(16):x}::{rng.getrandbits(16):x}" if k % 3 == 0 else octets
        rows.append((text, rng.choice(["primary", "noncommercial", "permissive"]), rng.choice(["high", "medium"])))
    df = A.with_address(spark.createDataFrame(rows, "t string, tier string, band string"), "t").drop("t").distinct()
    day, one = F.lit("2024-01-01").cast("timestamp"), lambda x: F.array(F.lit(x))
    df = df.withColumns(
        {
            "score": F.lit(90.0), "independence_classes": one("a"), "sources": one("s"), "categories": one("c"),
            "tags": one("t"), "first_seen": day, "last_seen": day, "promoted_by": F.lit(None).cast("string"),
            "restricted_corroboration": F.lit(0), "source_reference": F.lit(None).cast("string"),
            "source_registry": F.lit(None).cast("string"),
        }
    ).repartition(5)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    # Sorts spill after a few hundred rows.
    spill, env = "spark.shuffle.spill.numElementsForceSpillThreshold", spark._jvm.org.apache.spark.SparkEnv.get().conf()
    try:
        env.set(spill, "300")
        for k, v in conf.items():
            spark.conf.set(k, v)
        writers.write_all(df, str(tmp_path / "out"))
    finally:
        env.remove(spill)
        for k, v in before.items():
            spark.conf.set(k, v)
    several = 0

    def parts(folder):
        return sorted(glob.glob(f"{folder}/part-*"))

    for folder in glob.glob(str(tmp_path / "out/lists/*/*/*")):
        got = [key(line.strip()) for part in parts(folder) for line in open(part)]
        assert got == sorted(got) and got, folder
        several += len(parts(folder)) > 1
    for folder in glob.glob(str(tmp_path / "out/records/tier=*")):
        got = [key(json.loads(line)["ip_or_cidr"]) for part in parts(folder) for line in open(part)]
        assert got == sorted(got) and got, folder
        several += len(parts(folder)) > 1
    for folder in glob.glob(str(tmp_path / "out/ipset/*/*")):
        got = [key(line.split()[-1]) for part in parts(folder) for line in open(part)]
        assert got == sorted(got) and got, folder
    assert several > 6
    # One sort for all forms: a write scans the sorted rows and adds neither a sort nor a shuffle.
    with writers.in_address_order(df) as rows:
        plan_of = writers.list_rows(rows)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan_of.split("InMemoryRelation")[0]


def frame(spark, rows):
    # Stored, as observations are: parsing is not part of a run.
    return written(A.with_address(spark.createDataFrame(rows, OBS), "t").drop("t"), "observations")


def test_runs_repeated_and_failed_in_one_folder(spark, tmp_path):
    folder = str(tmp_path / "runs")
    sources = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    allowed = written(allow_frame(spark, "8.8.8.0/24"), "allowed")
    names = [r[0] for r in REGISTRY]
    status = spark.createDataFrame([(n, "ok" if n != "c2" else "failed", 3) for n in names], "source string, status string, records long")
    ranges = spark.createDataFrame([(9 << 24, (9 << 24) + 99, 64500, "XX", "net")], "lo long, hi long, asn long, country string, name string")

    def tables(rows, state=None):
        return plan.RunTables(
            frame(spark, rows), sources, allowed, configured(spark, "one"), state,
            ranges=ranges, status=status,
        )

    days = [NOW - timedelta(days=3), NOW]
    old = [obs(ip, n, age=3) for ip in ("9.0.0.1", "9.0.0.2", "2a00::1") for n in "abc"]
    assert publish.published_run(spark, folder) is None and plan.latest_state(spark, folder) is None
    one = plan.run(tables(old), days[0], folder)
    assert one.watched == {"collected": 9, "carried": 0}
    assert publish.published_run(spark, folder) == one.name
    state = plan.latest_state(spark, folder)

    # The guard stops the second run: the first one stays published, with its forms.
    new = [obs("9.0.0.1", "a"), obs("9.0.0.1", "b"), obs("9.0.0.3", "a"), obs("9.0.0.3", "b"), obs("9.0.0.3", "c")]
    with pytest.raises(safety.ChurnExceeded):
        plan.run(tables(new, state), NOW, folder)
    assert publish.published_run(spark, folder) == one.name
    lists = spark.read.text(f"{folder}/forms/run={one.name}/lists").filter("tier = 'primary' and list = 'all'")
    assert {r.value for r in lists.collect()} == {"9.0.0.1", "9.0.0.2", "2a00::1"}

    two = plan.run(tables(new, state), NOW, folder, force=True)
    doc = two.manifest.filter("tier = 'primary'").first()
    assert (doc.deltas.added, doc.deltas.removed) == (1, 2)
    assert doc.deltas.added_examples == ["9.0.0.3"] and doc.deltas.removed_examples == ["2a00::1", "9.0.0.2"]
    assert doc.counts.published == 2 and doc.corroboration_histogram == {"3": 2}
    assert doc.sources["c2"].status == "failed" and doc.sources["a"].independence_class == "one"
    assert two.watched == {"collected": 5, "carried": 1}  # c's vote for the first address
    assert {r.tier for r in two.manifest.collect()} == {"primary", "noncommercial", "permissive"}

    # The same run again: its line and its day are replaced, not doubled.
    again = plan.run(tables(new, state), NOW, folder, force=True)
    assert publish.published_run(spark, folder) == again.name != two.name
    history = publish.run_history(spark, folder).collect()
    assert [r.generated_at for r in history] == [str(NOW), str(days[0])]
    assert [(r.published, r.sources_ok, r.not_ok) for r in history] == [(2, 9, ["c2"]), (3, 9, ["c2"])]
    networks = sorted((str(r.day), r.asn, r.addresses) for r in publish.network_history(spark, folder).collect())
    assert networks == [(str(d.date()), 64500, 2) for d in days]
    schema = spark.read.text(f"{folder}/forms/run={again.name}/schema").first()[0]
    assert [f["name"] for f in json.loads(schema)["fields"]][:2] == ["tier", "ip_or_cidr"]
    found = json.loads(spark.read.text(f"{folder}/forms/run={again.name}/insights").first()[0])
    assert found["corpus"]["addresses_observed"] == 2 and "9.0.0" not in json.dumps(found)
