"""What a run leaves besides its lists: documents, counters, health."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from quorumlens.catalog import adapters as D
from quorumlens.catalog.ingest_queries import _FETCH, _STATUS, _status
from quorumlens.catalog.registry import query
from quorumlens.catalog.safety_queries import (
    _ALLOBS,
    CAPPED,
    CARRIED,
    JUDGED,
    STATE,
    all_observations,
    judged,
    prior_state,
    psql,
    published,
    ssql,
)
from quorumlens.catalog.statistics_queries import _RUNS, CLS, ENR, FINALN, PAIRS, SPECTRUM, _history, osql
from quorumlens.functions import constants as K
from quorumlens.operators import documents, families, reports
from quorumlens.plans import run as plan
from quorumlens.session import written
from quorumlens.sinks import writers


def _text(entries: Column, value) -> Column:
    return F.array_join(F.transform(entries, value), ",")


def _named(map_col: str, value=lambda v: v.cast("string")) -> Column:
    """A map as ``key=value`` texts in order of keys."""
    entries = F.array_sort(F.map_entries(map_col))
    return _text(entries, lambda e: F.concat(e["key"], F.lit("="), value(e["value"])))


_CHANGES = """chg AS (
  SELECT tier, indicator, 'added' AS change FROM pub WHERE tier <> 'primary' OR indicator NOT IN (SELECT indicator FROM state WHERE band <> 'withheld')
  UNION ALL SELECT 'primary', indicator, 'removed' FROM state WHERE band <> 'withheld' AND indicator NOT IN (SELECT indicator FROM pub WHERE tier = 'primary')),
chr AS (SELECT *, row_number() OVER (PARTITION BY tier, change ORDER BY indicator) AS r FROM chg),
drops AS (SELECT tier, drop_reason, indicator, row_number() OVER (PARTITION BY tier, drop_reason ORDER BY family, lo, coalesce(prefix, 128)) AS r FROM judged WHERE drop_reason IS NOT NULL)"""


@query(
    "sk08_manifest_document",
    D.with_sql(
        D.SRC,
        D.OBS,
        D.scored_sql(),
        D.ALLOW,
        JUDGED,
        CAPPED,
        STATE,
        _FETCH,
        _STATUS,
        _CHANGES,
        select=f"""SELECT f.tier, published, high, medium, withheld, promoted, benign_capped,
  (SELECT string_agg(concat(k, '=', n), ',' ORDER BY k) FROM (SELECT len(classes)::VARCHAR AS k, count(*) AS n FROM pub p WHERE p.tier = f.tier GROUP BY 1)) AS histogram,
  (SELECT count(*) FROM chg c WHERE c.tier = f.tier AND change = 'added') AS added, (SELECT count(*) FROM chg c WHERE c.tier = f.tier AND change = 'removed') AS removed,
  coalesce((SELECT string_agg(indicator, ',' ORDER BY indicator) FROM chr c WHERE c.tier = f.tier AND change = 'added' AND r <= 20), '') AS added_examples,
  coalesce((SELECT string_agg(indicator, ',' ORDER BY indicator) FROM chr c WHERE c.tier = f.tier AND change = 'removed' AND r <= 20), '') AS removed_examples,
  (SELECT string_agg(concat(drop_reason, '=', n), ',' ORDER BY drop_reason) FROM (SELECT drop_reason, count(*) AS n FROM drops d WHERE d.tier = f.tier GROUP BY 1)) AS dropped,
  (SELECT string_agg(concat(drop_reason, '=', x), ',' ORDER BY drop_reason) FROM (SELECT drop_reason, string_agg(indicator, '+' ORDER BY r) AS x FROM drops d WHERE d.tier = f.tier AND r <= 5 GROUP BY 1)) AS examples,
  (SELECT string_agg(concat(source, '=', status, ':', records, ':', independence_class, ':', CASE WHEN vote AND enabled THEN 'true' ELSE 'false' END, ':', coalesce(license, '')), ',' ORDER BY source) FROM st JOIN src ON source = name) AS sources,
  (SELECT string_agg(DISTINCT independence_class, ',' ORDER BY independence_class) FROM src WHERE enabled AND vote AND weight > 0) AS active_voting_classes
FROM ({FINALN}) f""",
    ),
)
def sk08_manifest(spark, sf):
    """The run's document of every tier, put together and taken apart again."""
    before = prior_state(spark, sf).filter("band <> 'withheld'").select(F.lit("primary").alias("tier"), "indicator")
    doc = documents.manifest(
        judged(spark, sf, with_labels=True), D.sources(spark), D.AS_OF, _status(spark, sf), before
    )
    facts = lambda s: F.concat_ws(
        ":", s["status"], s["records"], s["independence_class"], s["votes"], F.coalesce(s["license"], F.lit(""))
    )
    joined = lambda c: F.array_join(c, ",")
    return doc.select(
        "tier",
        "counts.*",
        _named("corroboration_histogram").alias("histogram"),
        "deltas.added",
        "deltas.removed",
        joined("deltas.added_examples").alias("added_examples"),
        joined("deltas.removed_examples").alias("removed_examples"),
        _named("filters.dropped").alias("dropped"),
        _named("filters.examples", lambda v: F.array_join(v, "+")).alias("examples"),
        _named("sources", facts).alias("sources"),
        joined("active_voting_classes").alias("active_voting_classes"),
    )


@query(
    "sk08_insights_document",
    D.with_sql(
        D.SRC,
        D.OBS,
        D.scored_sql(),
        D.ALLOW,
        JUDGED,
        CAPPED,
        D.RANGES,
        ENR,
        CLS,
        PAIRS,
        SPECTRUM,
        select="""SELECT
  (SELECT count(DISTINCT indicator) FROM obs) AS addresses_observed, (SELECT count(*) FROM scored WHERE tier = 'primary' AND band <> 'withheld') AS addresses_published,
  (SELECT string_agg(concat(k, '=', n), ',' ORDER BY k) FROM (SELECT classes::VARCHAR AS k, count(*) AS n FROM (SELECT indicator, count(DISTINCT CASE WHEN vote THEN independence_class END) AS classes FROM obs JOIN src ON source = name GROUP BY 1) GROUP BY 1)) AS agreement,
  (SELECT string_agg(concat(source, '=', n, ':', alone), ',' ORDER BY source) FROM (SELECT source, count(*) AS n, count(*) FILTER (k = 1) AS alone FROM (SELECT indicator, source, count(*) OVER (PARTITION BY indicator) AS k FROM (SELECT DISTINCT indicator, source FROM obs)) GROUP BY 1)) AS sources,
  (SELECT string_agg(concat(a, '~', b, '=', shared), ',' ORDER BY j DESC, a, b) FROM (SELECT a, b, shared, round(shared / (na + nb - shared), 4) AS j FROM pairs ORDER BY j DESC, a, b LIMIT 20)) AS class_overlap,
  (SELECT string_agg(concat(source, '=', n), ',' ORDER BY source) FROM (SELECT source, count(*) FILTER (family = 6) AS n FROM obs GROUP BY 1) WHERE n > 0) AS family_coverage,
  (SELECT string_agg(concat(family, '=', n), ',' ORDER BY family) FROM (SELECT family, count(*) AS n FROM judged WHERE tier = 'primary' AND band <> 'withheld' GROUP BY 1)) AS families,
  (SELECT count(*) FILTER (observations > 0) FROM spec) AS occupied_buckets,
  (SELECT string_agg(concat(asn, '=', addresses), ',' ORDER BY addresses DESC, asn) FROM (SELECT asn, addresses FROM roll WHERE addresses >= 5 ORDER BY addresses DESC, asn LIMIT 25)) AS networks""",
    ),
)
def sk08_insights(spark, sf):
    """The document of statistics over all sources."""
    doc = documents.insights(
        D.observations(spark, sf), judged(spark, sf), D.sources(spark), D.AS_OF, D.ranges(spark, sf)
    )
    pair = lambda a, b: lambda r: F.concat(r[a].cast("string"), F.lit("="), r[b].cast("string"))
    return doc.select(
        "corpus.addresses_observed",
        F.col("corpus.addresses_published_primary").alias("addresses_published"),
        _named("agreement").alias("agreement"),
        _text(
            F.col("sources"),
            lambda r: F.concat(
                r["source"], F.lit("="), r["addresses_reported"], F.lit(":"), r["reported_only_by_this_source"]
            ),
        ).alias("sources"),
        _text(F.col("class_overlap"), lambda r: F.concat(r["a"], F.lit("~"), r["b"], F.lit("="), r["shared"])).alias(
            "class_overlap"
        ),
        _text(F.col("family_coverage"), pair("source", "ipv6_observations")).alias("family_coverage"),
        _text(F.col("families"), pair("family", "published")).alias("families"),
        "spectrum.occupied_buckets",
        _text(F.col("networks"), pair("asn", "addresses")).alias("networks"),
    )


_FILLED = {
    "tier": "tier", "ip_or_cidr": "indicator", "address_family": "family", "score": "score", "band": "band",
    "independence_classes": "classes", "sources": "sources", "categories": "categories", "tags": "tags",
    "first_seen": "first_seen", "last_seen": "last_seen", "promoted_by": "promoted_by",
    "restricted_corroboration": "restricted", "source_reference": "nullif(source_reference, '')",
    "source_registry": "nullif(source_registry, '')",
}
_KINDS = {"score": "double", "restricted_corroboration": "integer"} | {
    c: "array" for c in ("independence_classes", "sources", "categories", "tags")
}


@query(
    "sk09_published_schema",
    psql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS field, '{_KINDS.get(name, 'string')}' AS kind, {k}::BIGINT AS position, count({c}) AS filled FROM pub"
            for k, (name, c) in enumerate(_FILLED.items())
        )
    ),
)
def sk09(spark, sf):
    """Fields of the published schema, and how many published records fill each."""
    shown = published(spark, sf)
    full = writers.full_rows(shown)
    text = F.lit(writers.published_schema(shown))
    kind = "fields array<struct<name string, type string>>"
    fields = F.posexplode(F.from_json(text, kind)["fields"])
    counts = full.agg(*[F.count(c).alias(c) for c in full.columns])
    filled = F.map_from_arrays(F.array(*[F.lit(c) for c in full.columns]), F.array(*[F.col(c) for c in full.columns]))
    return counts.select(filled.alias("filled"), fields.alias("position", "f")).select(
        F.col("f.name").alias("field"),
        # A list's type is an object in the schema; its kind is named there.
        F.when(F.startswith("f.type", F.lit("{")), F.get_json_object("f.type", "$.type"))
        .otherwise(F.col("f.type"))
        .alias("kind"),
        F.col("position").cast("bigint").alias("position"),
        F.try_element_at("filled", F.col("f.name")).alias("filled"),
    )


@query(
    "ag09_collected_and_carried",
    ssql(
        "SELECT tier, count(DISTINCT indicator) AS indicators, (SELECT count(*) FROM allobs WHERE NOT carried) AS collected, (SELECT count(*) FROM allobs WHERE carried) AS carried "
        "FROM allobs CROSS JOIN (VALUES ('primary'), ('noncommercial'), ('permissive')) t(tier) GROUP BY tier",
        CARRIED,
        _ALLOBS,
    ),
)
def ag09_watched(spark, sf):
    """Observations collected and carried, counted while the judged rows are written."""
    observations = all_observations(spark, sf)
    counted, watch = reports.watched(observations)
    rows = written(
        plan.judge(counted, D.sources(spark), D.allowed(spark, sf), D.AS_OF, rules=D.RULES), "judged"
    )
    seen = watch.get
    return rows.groupBy("tier").agg(
        F.count("*").alias("indicators"),
        F.lit(seen["collected"]).cast("bigint").alias("collected"),
        F.lit(seen["carried"]).cast("bigint").alias("carried"),
    )


@query(
    "ag37_sources_not_ok",
    D.with_sql(D.SRC, D.RAW, _FETCH, _STATUS, select="SELECT source, status, records FROM st WHERE status <> 'ok'"),
)
def ag37_list(spark, sf):
    """Sources of a run that were not ok."""
    return reports.not_ok(_status(spark, sf))


@query(
    "tk07_last_forty_runs",
    D.with_sql(
        _RUNS,
        select="SELECT *, row_number() OVER (ORDER BY generated_at) AS run FROM (SELECT generated_at, published, sources_total - sources_ok AS missing, CASE WHEN sources_total - sources_ok >= 2 THEN 'severe' WHEN sources_total - sources_ok = 1 THEN 'partial' ELSE 'ok' END AS state FROM runs ORDER BY generated_at DESC LIMIT 40)",
    ),
)
def tk07_runs(spark, sf):
    """Health and size of the newest forty runs, oldest first."""
    last = _history(spark, sf).orderBy(F.desc("generated_at")).limit(K.SHOWN_RUNS)
    health = reports.run_health(last).join(last.select("generated_at", "published"), "generated_at")
    return health.withColumn("run", F.row_number().over(Window.orderBy("generated_at")))


@query(
    "tk07_ipv6_coverage_order",
    osql(
        "SELECT source, n AS ipv6_observations, row_number() OVER (ORDER BY n DESC, source) AS place FROM (SELECT source, count(*) FILTER (family = 6) AS n FROM obs GROUP BY 1) WHERE n > 0"
    ),
)
def tk07_coverage(spark, sf):
    """Sources by the IPv6 they report."""
    rows = families.observation_coverage(D.observations(spark, sf), D.sources(spark))
    return families.by_coverage(rows).select("source", "ipv6_observations", "place")
