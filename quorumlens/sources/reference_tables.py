"""Allowlist, range table, fetch status: the tables observations are judged against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.functions import scoring as S
from quorumlens.sources.ingest import stripped
from quorumlens.sources.registry import dimension

ALLOW_COLUMNS = ("allow_source", *A.ADDRESS_COLUMNS)


class AllowlistIncomplete(RuntimeError):
    """An allowlist source is missing or empty; publishing without it is not safe."""


def _networks(values: DataFrame) -> DataFrame:
    """(allow_source, value) to networks; unreadable values are left out."""
    return (
        A.with_address(values, "value", "network")
        .filter("indicator is not null")
        .select(*ALLOW_COLUMNS)
    )


def allow_text(raw: DataFrame) -> DataFrame:
    """One network or address per line, ``#`` starts a comment."""
    value = stripped(F.substring_index("line", "#", 1))
    return _networks(raw.select("allow_source", value.alias("value")).filter("value <> ''"))


def allow_cidr_lists(raw: DataFrame) -> DataFrame:
    """``{result: {ipv4_cidrs: [...], ipv6_cidrs: [...]}}``."""
    doc = F.from_json(
        "payload", "result struct<ipv4_cidrs array<string>, ipv6_cidrs array<string>>"
    )
    none = F.array().cast("array<string>")
    rows = raw.select("allow_source", doc.alias("_j"))
    both = F.concat(F.coalesce("_j.result.ipv4_cidrs", none), F.coalesce("_j.result.ipv6_cidrs", none))
    return _networks(rows.select("allow_source", F.explode(both).alias("value")))


def allow_prefix_objects(raw: DataFrame) -> DataFrame:
    """``{prefixes: [{ipv4Prefix | ipv6Prefix}]}``."""
    doc = F.from_json("payload", "prefixes array<struct<ipv4Prefix string, ipv6Prefix string>>")
    rows = raw.select("allow_source", F.explode(doc.getField("prefixes")).alias("_p"))
    each = F.array_compact(F.array("_p.ipv4Prefix", "_p.ipv6Prefix"))
    return _networks(rows.select("allow_source", F.explode(each).alias("value")))


def allow_service_map(raw: DataFrame) -> DataFrame:
    """``{service: [cidr, ...], ...}``: every list except the key material, items with a slash."""
    doc = F.from_json("payload", "map<string,string>")
    rows = raw.select("allow_source", F.explode(doc).alias("key", "items"))
    lists = rows.filter(
        F.startswith("items", F.lit("[")) & ~F.col("key").isin("ssh_keys", "ssh_key_fingerprints")
    )
    value = F.explode(F.from_json("items", "array<string>"))
    return _networks(
        lists.select("allow_source", value.alias("value")).filter(F.col("value").contains("/"))
    )


# Allowlist format names.
ALLOW_FORMATS = {
    "cloudflare_json": allow_cidr_lists,
    "google_json": allow_prefix_objects,
    "github_meta": allow_service_map,
    "text": allow_text,
}


def missing_allow_sources(configured: DataFrame, networks: DataFrame) -> DataFrame:
    """Configured allowlist sources that yielded no network."""
    return configured.join(networks.select("allow_source").distinct(), "allow_source", "left_anti")


def require_complete_allowlist(configured: DataFrame, networks: DataFrame) -> DataFrame:
    """The networks, or an error naming up to twenty sources that are missing."""
    missing = missing_allow_sources(configured, networks).orderBy("allow_source").take(20)
    if missing:
        raise AllowlistIncomplete(", ".join(r.allow_source for r in missing))
    return networks


def range_table(raw: DataFrame) -> DataFrame:
    """``start end asn country name`` by tabs; short and unreadable rows are left out."""
    p = F.split(F.regexp_replace("line", "\n$", ""), "\t")
    rows = raw.select(p.alias("_p")).filter(F.size("_p") >= 5)
    number = [stripped(F.get("_p", F.lit(i))).try_cast("bigint") for i in range(3)]
    return rows.select(
        number[0].alias("lo"),
        number[1].alias("hi"),
        number[2].alias("asn"),
        F.coalesce(F.nullif(F.get("_p", F.lit(3)), F.lit("")), F.lit("??")).alias("country"),
        F.get("_p", F.lit(4)).alias("name"),
    ).filter("lo is not null and hi is not null and asn is not null")


def stale_sources(fetches: DataFrame, sources: DataFrame, as_of) -> DataFrame:
    """Per fetched source: age of its content, and whether that exceeds min(30, ttl) days.

    ``fetches`` holds (source, last_modified, error); dormant sources are stale without a warning.
    """
    dim = sources.select(F.col("name").alias("source"), "ttl_days", "dormant")
    age = S.age_days(F.col("last_modified"), S.moment(as_of))
    stale = F.coalesce(age > F.least(F.lit(K.STALENESS_DAYS), F.col("ttl_days")), F.lit(False))
    return fetches.join(dim, "source").select(
        "source",
        F.floor(age).cast("int").alias("age_days"),
        stale.alias("stale"),
        (stale & ~F.col("dormant")).alias("warn"),
    )


def mark_stale(observations: DataFrame, staleness: DataFrame, sources: DataFrame) -> DataFrame:
    """Set evidence_stale on every row of a stale source; ``staleness`` has at most one row a source of ``sources``."""
    flags = dimension(staleness, "source", F.col("stale").alias("_stale"), within=sources)
    return (
        observations.join(flags, "source", "left")
        .withColumn("evidence_stale", F.coalesce("_stale", F.lit(False)))
        .drop("_stale")
    )


def source_status(
    sources: DataFrame, fetches: DataFrame, staleness: DataFrame, observations: DataFrame
) -> DataFrame:
    """Status and record count of every enabled source."""
    counts = observations.groupBy("source").agg(F.count("*").alias("_n"))
    base = sources.filter("enabled").select(F.col("name").alias("source"))
    joined = (
        base.join(fetches.select("source", "error", "skipped"), "source", "left")
        .join(staleness.select("source", "stale"), "source", "left")
        .join(counts, "source", "left")
    )
    n = F.coalesce("_n", F.lit(0))
    status = (
        F.when(F.col("skipped"), "skipped")
        .when(F.col("error").isNotNull(), "failed")
        .when(F.col("stale"), "stale")
        .when(n == 0, "empty")
        .otherwise("ok")
    )
    return joined.select("source", status.alias("status"), n.alias("records"))
