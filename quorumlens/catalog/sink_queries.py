"""Published forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorumlens.catalog.registry import query
from quorumlens.catalog.safety_queries import psql, published
from quorumlens.sinks import writers as W

_T = "strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00')"
FIRST, LAST = _T.format(c="first_seen"), _T.format(c="last_seen")
LISTS = (
    "array_to_string(classes, '|') AS independence_classes, array_to_string(sources, '|') AS sources, "
    "array_to_string(categories, '|') AS categories, array_to_string(tags, '|') AS tags"
)
REF = "nullif(source_reference, '')"


@query(
    "sk01_full_records",
    psql(
        f"SELECT tier, indicator AS ip_or_cidr, concat('v', family) AS address_family, score, band, {LISTS}, {FIRST} AS first_seen, {LAST} AS last_seen, promoted_by, restricted AS restricted_corroboration, {REF} AS source_reference, nullif(source_registry, '') AS source_registry FROM pub"
    ),
)
def sk01(spark, sf):
    """Full record table."""
    return W.full_rows(published(spark, sf))


@query(
    "sk02_csv_table",
    psql(
        f"SELECT tier, indicator, concat('v', family) AS address_family, CAST(CAST(score AS DECIMAL(5,2)) AS VARCHAR) AS score, band, {LISTS}, {FIRST} AS first_seen, {LAST} AS last_seen, coalesce({REF}, '') AS source_reference FROM pub"
    ),
)
def sk02(spark, sf):
    """Flat table with joined lists, all tiers."""
    return W.csv_rows(published(spark, sf), "tier")


@query(
    "sk03_text_lists",
    psql(
        "SELECT tier, band, list, indicator FROM pub, (VALUES ('all', 0), ('v4', 4), ('v6', 6)) l(list, f) WHERE f = 0 OR f = family"
    ),
)
def sk03(spark, sf):
    """Text lists per band, combined and per family."""
    return W.list_rows(published(spark, sf))


@query("so02_high_and_medium", psql("SELECT band, count(*) AS n FROM pub WHERE tier = 'primary' AND band IN ('high', 'medium') GROUP BY 1"))
def so02(spark, sf):
    """The combined list is high and medium together."""
    lists = W.list_rows(published(spark, sf, ("primary",))).filter("list = 'all'")
    return lists.groupBy("band").agg(F.count("*").alias("n"))


@query(
    "sk04_ipset_lines",
    psql("SELECT tier, family::BIGINT AS family, concat('add quorum', CASE WHEN family = 6 THEN '6' ELSE '' END, ' ', indicator) AS line FROM pub WHERE band = 'high'"),
)
def sk04(spark, sf):
    """Set lines, one set per family."""
    return W.ipset_rows(published(spark, sf))


@query(
    "sk04_nft_elements",
    psql("SELECT tier, family::BIGINT AS family, concat('add element inet quorum blocklist', family, ' { ', indicator, ' }') AS line FROM pub WHERE band = 'high'"),
)
def sk04n(spark, sf):
    """Set element lines."""
    return W.nft_rows(published(spark, sf))


@query(
    "sk04_excluded_counts",
    psql(
        "SELECT tier, f::BIGINT AS family, count(*) FILTER (family = f) AS included, count(*) FILTER (family <> f) AS excluded FROM pub, (VALUES (4), (6)) v(f) WHERE band = 'high' GROUP BY ALL"
    ),
)
def sk04x(spark, sf):
    """Records a family's set leaves out."""
    return W.excluded_counts(published(spark, sf))


_Z = "strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"


@query(
    "sk05_stix_objects",
    psql(
        "SELECT tier, concat('indicator--', h[1:8], '-', h[9:12], '-', h[13:16], '-', h[17:20], '-', h[21:32]) AS id, concat('[ipv', family, '-addr:value = ''', indicator, ''']') AS pattern, "
        f"CAST(floor(score) AS BIGINT) AS confidence, {_Z.format(c='first_seen')} AS created, {_Z.format(c='last_seen')} AS modified, CASE WHEN len(categories) > 0 THEN array_to_string(categories, '|') ELSE 'malicious-activity' END AS labels, "
        "array_to_string(sources, '|') AS reported_by FROM (SELECT *, sha256(indicator) AS h FROM pub WHERE band = 'high')"
    ),
)
def sk05(spark, sf):
    """STIX indicator objects."""
    return W.stix_rows(published(spark, sf)).select(
        "tier",
        "id",
        "pattern",
        "confidence",
        "created",
        "modified",
        "labels",
        F.col("external_references.description").alias("reported_by"),
    )


@query(
    "sk06_misp_attributes",
    psql(
        "SELECT tier, 'ip-dst' AS type, 'Network activity' AS category, true AS to_ids, indicator AS value, concat('score=', CAST(round_even(score, 0) AS BIGINT), ' classes=', array_to_string(classes, ',')) AS comment FROM pub WHERE band = 'high'"
    ),
)
def sk06(spark, sf):
    """MISP attributes."""
    return W.misp_rows(published(spark, sf))


@query(
    "sk07_lookup_table",
    psql(
        f"SELECT tier, family::BIGINT AS family, CAST(lo AS VARCHAR) AS low, CAST(hi AS VARCHAR) AS high, CAST(round_even(score, 0) AS BIGINT) AS score, band, len(classes) AS classes, indicator, array_to_string(sources, ', ') AS sources, restricted AS restricted_corroboration, coalesce({REF}, '') AS source_reference FROM pub"
    ),
)
def sk07(spark, sf):
    """Range table with exact 128-bit bounds."""
    return W.lookup_rows(published(spark, sf))


@query(
    "tk05_address_order",
    psql(
        "SELECT tier, indicator, row_number() OVER (PARTITION BY tier ORDER BY family, lo, coalesce(prefix, 128)) AS position FROM pub"
    ),
)
def tk05(spark, sf):
    """Place of every entry in the address order of its tier's list."""
    return W.positions(published(spark, sf))


@query(
    "sk08_manifest_counts",
    psql(
        "SELECT tier, band, len(classes) AS classes, count(*) AS records, count(*) FILTER (promoted_by IS NOT NULL) AS promoted FROM pub GROUP BY ALL"
    ),
)
def sk08(spark, sf):
    """Cells of the run manifest."""
    return (
        published(spark, sf)
        .groupBy("tier", "band", F.size("independence_classes").alias("classes"))
        .agg(F.count("*").alias("records"), F.count("promoted_by").alias("promoted"))
    )
