"""Payload formats: malformed input, compressed files, gates."""

from __future__ import annotations

import gzip

import pytest

from quorumlens.catalog import adapters as D
from quorumlens.sources import ingest as I
from quorumlens.sources import reference_tables as T
from quorumlens.streaming.arrivals import ingest_new_files

DAY = "2024-01-31"


def raw(spark, source, lines):
    return spark.createDataFrame([(source, x) for x in lines], "source string, line string")


def statuses(parsed):
    return {(r.source, r.status): r["rows"] for r in I.reject_counts(parsed).collect()}


def test_plain_list_counts_every_kind(spark):
    lines = ["# c", "; c", "", "  9.9.9.9  x", "9.9.9.0/24#c", "10.0.0.1", "nope", "2a00::1", "9.9.9.8;z"]
    parsed = I.plain_list(raw(spark, "view", lines), D.sources(spark), DAY)
    assert statuses(parsed) == {("view", "ok"): 4, ("view", "non_global"): 1, ("view", "malformed"): 1}


def test_range_list_both_families(spark):
    lines = ["9.0.0.0\t9.0.0.255\t24", "9.0.1.3 9.0.1.8 x", "2a00:: 2a00::3 126", "9.0.0.9 9.0.0.1 x", "9.0.0.1 9.0.0.2", "2a00::5 2a00::1 x"]
    parsed = I.range_list(raw(spark, "view", lines), D.sources(spark), DAY)
    assert {r.indicator for r in I.accepted(parsed).collect()} == {
        "9.0.0.0/24", "9.0.1.3/32", "9.0.1.4/30", "9.0.1.8/32", "2a00::/126",
    }
    assert statuses(parsed)[("view", "malformed")] == 3


def test_documents_that_are_not_data_yield_nothing(spark):
    for job, texts in (
        (I.ioc_json, ["not json", "[]", '{"query_status": "no"}', '{"query_status": "ok", "data": "x"}']),
        (I.confidence_json, ["<html>", "[]", '{"errors": [{"d": 1}], "data": [{"ipAddress": "9.9.9.9"}]}', '{"data": {}}']),
    ):
        frame = spark.createDataFrame([("error", t) for t in texts], "source string, payload string")
        assert job(frame, D.sources(spark), DAY).count() == 0


def test_confidence_tags(spark):
    doc = '{"data": [{"ipAddress": "9.9.9.9", "abuseConfidenceScore": 99, "countryCode": "de"}, {"ipAddress": "9.9.9.8", "abuseConfidenceScore": "99", "countryCode": "x1"}]}'
    frame = spark.createDataFrame([("error", doc)], "source string, payload string")
    got = {r.indicator: r.tags for r in I.confidence_json(frame, D.sources(spark), DAY).collect()}
    assert got == {"9.9.9.9": ["abuseipdb-confidence-75", "cc:DE"], "9.9.9.8": []}


def test_gzip_by_extension(spark, tmp_path):
    path = tmp_path / "list.txt.gz"
    path.write_bytes(gzip.compress(b"9.9.9.9\n9.9.9.8\n"))
    parsed = I.plain_list(I.read_lines(spark, {"view": str(path)}), D.sources(spark), DAY)
    assert parsed.count() == 2
    bad = tmp_path / "bad.txt.gz"
    bad.write_bytes(b"not gzip")
    with pytest.raises(Exception):
        I.read_lines(spark, {"view": str(bad)}).count()


def test_incomplete_allowlist_is_refused(spark):
    lines = spark.createDataFrame([("x", "9.0.0.0/8 # why"), ("y", "# nothing")], "allow_source string, line string")
    networks = T.allow_text(lines)
    wanted = spark.createDataFrame([("x",), ("y",)], "allow_source string")
    with pytest.raises(T.AllowlistIncomplete, match="y"):
        T.require_complete_allowlist(wanted, networks)
    assert T.require_complete_allowlist(wanted.filter("allow_source = 'x'"), networks).count() == 1


def test_new_files_only_once(spark, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("9.9.9.9\nbad\n")
    args = (spark, "view", inbox, "plain_text", D.sources(spark), DAY, table, progress)
    ingest_new_files(*args)
    ingest_new_files(*args)
    assert spark.read.parquet(table).count() == 1
    (tmp_path / "in/b.txt").write_text("9.9.9.8\n")
    ingest_new_files(*args)
    assert spark.read.parquet(table).count() == 2
