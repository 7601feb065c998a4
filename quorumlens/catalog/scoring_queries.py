"""Scoring, tiers and provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorumlens.catalog import adapters as D
from quorumlens.catalog.registry import query
from quorumlens.functions import measures as M
from quorumlens.functions import scoring as S
from quorumlens.operators import corroborate as C
from quorumlens.operators import reports

LISTS = ("independence_classes", "sources", "categories", "tags")


def scored(spark, sf, tiers=("primary",), keys=()):
    return C.corroborate(
        D.observations(spark, sf), D.sources(spark), D.AS_OF, tiers, D.RULES, keys
    )


def sql(select: str, *more: str) -> str:
    return D.with_sql(D.SRC, D.OBS, D.scored_sql(), *more, select=select)


@query(
    "ag01_corroboration_score",
    sql(
        "SELECT indicator, score, band, array_to_string(classes, '|') AS independence_classes, "
        "restricted AS restricted_corroboration FROM scored WHERE tier = 'primary'"
    ),
)
def ag01(spark, sf):
    """Best contribution per class, summed, saturated and banded."""
    return scored(spark, sf).select(
        "indicator", "score", "band", "independence_classes", "restricted_corroboration"
    )


@query(
    "ag02_open_restricted_classes",
    sql(
        "SELECT tier, len(classes) AS open_classes, restricted AS restricted_classes, count(*) AS indicators "
        "FROM scored GROUP BY ALL"
    ),
)
def ag02(spark, sf):
    """Open against restricted-only classes, all tiers."""
    return (
        scored(spark, sf, C.TIERS)
        .groupBy(
            "tier",
            F.size("independence_classes").alias("open_classes"),
            F.col("restricted_corroboration").alias("restricted_classes"),
        )
        .agg(F.count("*").alias("indicators"))
    )


@query(
    "ag03_distinct_labels",
    sql(
        "SELECT tier, indicator, array_to_string(sources, '|') AS sources, array_to_string(categories, '|') AS categories, "
        "array_to_string(tags, '|') AS tags FROM scored"
    ),
)
def ag03(spark, sf):
    """Sorted distinct sources, categories and tags of the tier's own rows."""
    return scored(spark, sf, C.TIERS).select("tier", "indicator", "sources", "categories", "tags")


@query(
    "ag04_tier_dates",
    sql(
        "SELECT tier, indicator, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, "
        "strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen FROM scored"
    ),
)
def ag04(spark, sf):
    """Dates from the tier's rows, from all rows where it has none."""
    return scored(spark, sf, C.TIERS).select("tier", "indicator", "first_seen", "last_seen")


@query(
    "ag05_prior_level",
    sql(
        "SELECT indicator, CAST(max(lvl) AS BIGINT) AS level FROM scored_j GROUP BY indicator"
    ),
)
def ag05(spark, sf):
    """Highest upstream level over all rows of an indicator."""
    p = C.profiles(D.observations(spark, sf), D.sources(spark), D.AS_OF, D.RULES)
    return p.select("indicator", F.col("prior_level").alias("level"))


@query(
    "ag06_promotion",
    sql(
        "SELECT indicator, promoted_by, score, band FROM scored WHERE tier = 'primary' AND promoted_by IS NOT NULL"
    ),
)
def ag06(spark, sf):
    """Indicators one precise source may publish alone."""
    return (
        scored(spark, sf).filter("promoted_by is not null").select("indicator", "promoted_by", "score", "band")
    )


@query(
    "ag07_reference",
    sql(
        "SELECT tier, indicator, nullif(source_reference, '') AS source_reference, nullif(source_registry, '') AS source_registry "
        "FROM scored WHERE source_reference <> ''"
    ),
)
def ag07(spark, sf):
    """Citation of the smallest (source, value) pair the tier may name."""
    return (
        scored(spark, sf, C.TIERS)
        .filter("source_reference is not null")
        .select("tier", "indicator", "source_reference", "source_registry")
    )


_FULL = (
    "SELECT tier, indicator, score, band, array_to_string(classes, '|') AS independence_classes, array_to_string(sources, '|') AS sources, "
    "promoted_by, restricted AS restricted_corroboration FROM scored"
)


@query("ag38_all_tiers_in_one_pass", sql(_FULL))
def ag38(spark, sf):
    """All licence tiers from one aggregation."""
    return scored(spark, sf, C.TIERS).select(
        "tier",
        "indicator",
        "score",
        "band",
        "independence_classes",
        "sources",
        "promoted_by",
        "restricted_corroboration",
    )


_SCENARIOS = {
    "all": "true",
    "without_purchase": "source <> 'purchase'",
    "without_error": "source <> 'error'",
    "floor_20": "source <> 'purchase' or value >= 20",
    "floor_60": "source <> 'purchase' or value >= 60",
}
_SCENARIO_CTE = (
    "cases AS ("
    + " UNION ALL ".join(f"SELECT *, '{n}' AS scenario FROM obs WHERE {c}" for n, c in _SCENARIOS.items())
    + ")"
)


@query(
    "ag39_ablation_and_floor_sweep",
    D.with_sql(
        D.SRC,
        D.OBS,
        _SCENARIO_CTE,
        D.scored_sql("cases", keys="scenario"),
        select="SELECT scenario, tier, count(*) FILTER (band <> 'withheld') AS published, count(*) FILTER (band = 'high') AS high, "
        "count(*) FILTER (band = 'medium') AS medium, count(*) FILTER (band = 'withheld') AS withheld FROM scored GROUP BY ALL",
    ),
)
def ag39(spark, sf):
    """Published, high and medium with and without a source, and per score floor."""
    out = C.corroborate_scenarios(D.observations(spark, sf), D.sources(spark), D.AS_OF, _SCENARIOS, C.TIERS, D.RULES)
    return reports.band_counts(out, "scenario")


@query(
    "jn01_registry_join",
    D.with_sql(
        D.SRC,
        D.OBS,
        select="SELECT source, independence_class, weight, count(*) AS observations FROM obs JOIN src ON source = name GROUP BY ALL",
    ),
)
def jn01(spark, sf):
    """Observations with the class and weight of their source."""
    dim = D.source_dimension(spark, "independence_class", "weight")
    counted = D.observations(spark, sf).groupBy("source").agg(F.count("*").alias("observations"))
    return counted.join(dim, "source")


_ROWS = (
    "SELECT event_id, round(contribution, 6) AS contribution FROM scored_j"
)


@query("fn19_vote_contribution", sql(_ROWS))
def fn19(spark, sf):
    """Weight x recency x severity per observation, a fifth for unvouched evidence."""
    dim = D.source_dimension(spark, "weight", "ttl_days", "dormant")
    ok = S.vouched(F.col("evidence_stale"), F.col("dormant"))
    value = (
        F.col("weight")
        * S.freshness(F.col("last_seen"), S.moment(D.AS_OF), F.col("ttl_days"), ok)
        * S.severity(F.col("categories"))
    )
    return (
        D.observations(spark, sf).join(dim, "source").select("event_id", F.round(value, 6).alias("contribution"))
    )


@query(
    "fn17_recency_factor",
    D.with_sql(
        D.SRC,
        D.OBS,
        select="SELECT source, strftime(last_seen, '%Y-%m-%d') AS day, "
        f"round(max(greatest(0.2, 1.0 - (DATE '{D.AS_OF}' - CAST(last_seen AS DATE)) * 1.0 / ttl_days)), 6) AS recency, count(*) AS n "
        "FROM obs JOIN src ON source = name GROUP BY ALL",
    ),
)
def fn17(spark, sf):
    """Linear decay to 0.2 over the source's time to live."""
    dim = D.source_dimension(spark, "ttl_days")
    value = S.recency_factor(F.col("last_seen"), S.moment(D.AS_OF), F.col("ttl_days"))
    return (
        D.observations(spark, sf)
        .join(dim, "source")
        .groupBy("source", F.date_format("last_seen", "yyyy-MM-dd").alias("day"))
        .agg(F.round(F.max(value), 6).alias("recency"), F.count("*").alias("n"))
    )


@query(
    "fn18_severity",
    D.with_sql(
        D.OBS,
        select="SELECT source, array_to_string(categories, '|') AS categories, CASE "
        "WHEN list_has_any(categories, ['hijacked-netblock', 'criminal-hosting']) THEN 1.0 WHEN list_has_any(categories, ['web-attack']) THEN 0.8 "
        "WHEN list_has_any(categories, ['brute-force', 'reported-abuse']) THEN 0.7 "
        "WHEN list_has_any(categories, ['scanning', 'odd', 'tor-exit']) THEN 0.6 ELSE 0.5 END::DOUBLE AS severity, count(*) AS n FROM obs GROUP BY ALL",
    ),
)
def fn18(spark, sf):
    """Highest severity among the categories."""
    return (
        D.observations(spark, sf)
        .groupBy("source", "categories")
        .agg(F.count("*").alias("n"))
        .withColumn("severity", S.severity(F.col("categories")))
    )


@query(
    "fn20_saturating_score",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(100 * (1 - exp(-(l_discount + l_tax) * l_quantity / 10)), 2) AS score FROM lineitem",
)
def fn20(spark, sf):
    """100 * (1 - exp(-raw)), two decimals, over every line item."""
    raw = (F.col("l_discount") + F.col("l_tax")) * F.col("l_quantity") / 10
    return D.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(S.saturate(raw), 2).alias("score")
    )


@query(
    "fn21_band",
    "SELECT l_linenumber % 5 AS open_classes, CAST(l_quantity AS BIGINT) % 4 AS restricted_classes, CASE WHEN l_linenumber % 5 >= 3 THEN 'high' "
    "WHEN l_linenumber % 5 = 2 THEN CASE WHEN CAST(l_quantity AS BIGINT) % 4 >= 1 THEN 'high' ELSE 'medium' END ELSE 'withheld' END AS band, "
    "count(*) AS n FROM (SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem) GROUP BY ALL",
)
def fn21(spark, sf):
    """Restricted classes upgrade, never admit."""
    line = D.table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 5).alias("open_classes"),
        (F.col("l_quantity").cast("bigint") % 4).alias("restricted_classes"),
    )
    return (
        line.withColumn("band", S.band(F.col("open_classes"), F.col("restricted_classes")))
        .groupBy("open_classes", "restricted_classes", "band")
        .agg(F.count("*").alias("n"))
    )


@query(
    "fn22_vouched",
    D.with_sql(
        D.SRC,
        D.OBS,
        select="SELECT source, NOT evidence_stale AND NOT dormant AS vouched, count(*) AS n FROM obs JOIN src ON source = name GROUP BY ALL",
    ),
)
def fn22(spark, sf):
    """Neither stale nor dormant."""
    dim = D.source_dimension(spark, "dormant")
    return (
        D.observations(spark, sf)
        .join(dim, "source")
        .groupBy("source", S.vouched(F.col("evidence_stale"), F.col("dormant")).alias("vouched"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "fn23_score_bucket",
    "SELECT event_id, least(100, CAST(floor(value / 25) AS BIGINT) * 25) AS bucket FROM events",
)
def fn23(spark, sf):
    """Upstream score floored to quarters of a hundred."""
    return D.table(spark, sf, "events").select("event_id", S.score_bucket(F.col("value")).alias("bucket"))


@query(
    "fn26_level_from_tag",
    D.with_sql(
        D.OBS,
        select="SELECT CASE WHEN source = 'click' THEN event_id % 8 ELSE 0 END AS level, count(*) AS n FROM obs GROUP BY ALL",
    ),
)
def fn26(spark, sf):
    """Level named in a tag."""
    return (
        D.observations(spark, sf).groupBy(S.prior_level(F.col("tags")).alias("level")).agg(F.count("*").alias("n"))
    )


@query(
    "fn34_tier_membership",
    D.with_sql(
        D.SRC,
        D.OBS,
        select="SELECT tier, source, count(*) AS observations FROM obs JOIN (SELECT 'primary' AS tier, name FROM src WHERE redistribute "
        "UNION ALL SELECT 'noncommercial', name FROM src WHERE (redistribute OR redistribute_noncommercial) AND noncommercial_compatible "
        "UNION ALL SELECT 'permissive', name FROM src WHERE redistribute AND explicit_grant) ON source = name GROUP BY ALL",
    ),
)
def fn34(spark, sf):
    """Observations each licence tier may publish."""
    from quorumlens.sources.registry import tier_sources

    per = D.observations(spark, sf).groupBy("source").agg(F.count("*").alias("observations"))
    return per.join(tier_sources(D.sources(spark)), "source")


@query(
    "fl06_voting_rows",
    D.with_sql(
        D.SRC,
        D.OBS,
        select="SELECT independence_class, count(*) FILTER (vote) AS voting, count(*) FILTER (NOT vote) AS annotating FROM obs JOIN src ON source = name GROUP BY ALL",
    ),
)
def fl06(spark, sf):
    """Rows that vote against rows that only annotate."""
    dim = D.source_dimension(spark, "independence_class", "vote")
    return (
        D.observations(spark, sf)
        .join(dim, "source")
        .groupBy("independence_class")
        .agg(F.count_if("vote").alias("voting"), F.count_if(~F.col("vote")).alias("annotating"))
    )


@query(
    "fl07_masked_sources",
    sql(
        "SELECT tier, array_to_string(sources, '|') AS sources, count(*) AS indicators FROM scored GROUP BY ALL"
    ),
)
def fl07(spark, sf):
    """Source sets as each tier may show them."""
    return scored(spark, sf, C.TIERS).groupBy("tier", "sources").agg(F.count("*").alias("indicators"))


@query(
    "fl08_exit_cap",
    sql(
        "SELECT tier, band, count(*) AS indicators, max(score) AS top_score FROM scored WHERE list_contains(tags, 'tor-exit') GROUP BY ALL"
    ),
)
def fl08(spark, sf):
    """Exit nodes never reach the high band."""
    return (
        scored(spark, sf, C.TIERS)
        .filter(F.array_contains("tags", "tor-exit"))
        .groupBy("tier", "band")
        .agg(F.count("*").alias("indicators"), F.max("score").alias("top_score"))
    )


@query(
    "fl05_publishable",
    sql("SELECT tier, indicator, band FROM scored WHERE band <> 'withheld'"),
)
def fl05(spark, sf):
    """Everything not withheld."""
    from quorumlens.operators.safety import publishable

    return publishable(scored(spark, sf, C.TIERS)).select("tier", "indicator", "band")


@query(
    "so04_set_algebra",
    sql(
        "SELECT tier, CAST(len(classes) AS BIGINT) AS open_classes, CAST(len(list_intersect(sources, ['view', 'click', 'error'])) AS BIGINT) AS shared, "
        "count(*) AS n FROM scored GROUP BY ALL"
    ),
)
def so04(spark, sf):
    """Source sets intersected with a given set."""
    return (
        scored(spark, sf, C.TIERS)
        .groupBy(
            "tier",
            F.size("independence_classes").alias("open_classes"),
            F.size(
                F.array_intersect("sources", F.array(F.lit("view"), F.lit("click"), F.lit("error")))
            ).alias("shared"),
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "fn31_log_shade",
    "SELECT l_suppkey, count(*) AS lines, round(0.2 + 0.8 * ln(1 + count(*)) / ln(1 + max(count(*)) OVER ()), 6) AS shade FROM lineitem GROUP BY l_suppkey",
)
def fn31(spark, sf):
    """Logarithmic shade of a count against the peak."""
    per = D.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("lines"))
    peak = per.agg(F.max("lines").alias("p")).scalar()
    return per.withColumn("_p", peak).select(
        "l_suppkey", "lines", F.round(M.log_shade(F.col("lines"), F.col("_p")), 6).alias("shade")
    )


@query(
    "fn30_per_million",
    "SELECT p_partkey, qty, round(qty / ((p_size * 10) / 1000000.0), 1) AS rate FROM (SELECT l_partkey AS p_partkey, CAST(sum(l_quantity) AS BIGINT) AS qty "
    "FROM lineitem GROUP BY 1) JOIN (SELECT p_partkey, p_size FROM part WHERE p_size * 10 >= 256) USING (p_partkey) "
    "UNION ALL SELECT p_partkey, qty, NULL FROM (SELECT l_partkey AS p_partkey, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY 1) "
    "JOIN (SELECT p_partkey, p_size FROM part WHERE p_size * 10 < 256) USING (p_partkey)",
)
def fn30(spark, sf):
    """Rate per million, absent below the smallest routable network."""
    qty = (
        D.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    )
    part = D.table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 10).alias("_a"))
    return qty.join(part, "p_partkey").select(
        "p_partkey", "qty", M.per_million(F.col("qty"), F.col("_a")).alias("rate")
    )


@query(
    "fn29_jaccard",
    "WITH c AS (SELECT l_suppkey % 10 AS s, l_partkey FROM lineitem GROUP BY ALL), n AS (SELECT s, count(*) AS n FROM c GROUP BY s), "
    "p AS (SELECT a.s AS a, b.s AS b, count(*) AS shared FROM c a JOIN c b USING (l_partkey) WHERE a.s < b.s GROUP BY ALL) "
    "SELECT a, b, shared, round(shared / (x.n + y.n - shared), 4) AS jaccard FROM p JOIN n x ON a = x.s JOIN n y ON b = y.s",
)
def fn29(spark, sf):
    """Jaccard of part sets between ten supplier groups, from membership patterns."""
    from quorumlens.operators import membership as P

    line = D.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("indicator"), (F.col("l_suppkey") % 10).alias("m")
    )
    return P.overlap(P.patterns(line, F.col("m")))
