"""Safety rules, licence rules, caps, interval joins and state."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quorumlens.catalog import adapters as D
from quorumlens.catalog.registry import query
from quorumlens.functions import addresses as A
from quorumlens.operators import carry, corroborate, intervals, ordered, reports, safety
from quorumlens.plans import run as plan

JUDGED = D.JUDGED.format(scored="scored")


def judged(spark, sf, tiers=corroborate.TIERS, with_labels=False):
    return plan.judge(
        D.observations(spark, sf),
        D.sources(spark),
        D.allowed(spark, sf),
        D.AS_OF,
        labels=D.labels(spark, sf) if with_labels else None,
        tiers=tiers,
        rules=D.RULES,
    )


def jsql(select: str, *more: str) -> str:
    return D.with_sql(D.SRC, D.OBS, D.scored_sql(), D.ALLOW, JUDGED, *more, select=select)


@query(
    "fl01_first_failing_rule",
    jsql("SELECT tier, indicator, drop_reason FROM judged"),
)
def fl01(spark, sf):
    """First failing safety or licence rule of every scored row."""
    return judged(spark, sf).select("tier", "indicator", "drop_reason")


@query(
    "fl02_too_wide",
    jsql(
        "SELECT tier, indicator FROM judged WHERE is_net AND prefix < CASE WHEN family = 4 THEN 22 ELSE 48 END AND NOT list_contains(sources, 'blocks')"
    ),
)
def fl02(spark, sf):
    """Networks too wide to publish that no netblock source vouches for."""
    scored = corroborate.corroborate(
        D.observations(spark, sf), D.sources(spark), D.AS_OF, corroborate.TIERS, D.RULES
    )
    return scored.filter(safety.too_wide(D.RULES)).select("tier", "indicator")


@query("fl03_not_redistributable", jsql("SELECT tier, count(*) AS n FROM judged WHERE len(sources) = 0 GROUP BY ALL"))
def fl03(spark, sf):
    """Rows without any source the tier may name."""
    return judged(spark, sf).filter(F.size("sources") == 0).groupBy("tier").agg(F.count("*").alias("n"))


@query(
    "fl04_tag_only",
    jsql("SELECT tier, indicator FROM judged WHERE sources = ['exits']"),
)
def fl04(spark, sf):
    """Rows named by annotating sources alone."""
    return (
        judged(spark, sf).filter((F.size("sources") > 0) & F.col("only_tagging")).select("tier", "indicator")
    )


CAPPED = f"""{D.LABELS},
shown AS (
  SELECT j.*, drop_reason IS NULL AND band = 'high' AND NOT is_net AND tier IN ('primary', 'permissive') AND b.address IS NOT NULL AS benign_capped
  FROM judged j LEFT JOIN (SELECT DISTINCT address FROM lab WHERE label = 'benign') b ON j.indicator = b.address),
final AS (SELECT * EXCLUDE (band), CASE WHEN benign_capped THEN 'medium' ELSE band END AS band FROM shown),
pub AS (SELECT * FROM final WHERE drop_reason IS NULL AND band <> 'withheld')"""


def published(spark, sf, tiers=corroborate.TIERS):
    return plan.published_of(judged(spark, sf, tiers, with_labels=True))


def psql(select: str, *more: str) -> str:
    return jsql(select, CAPPED, *more)


@query(
    "fl09_benign_cap",
    psql("SELECT tier, band, count(*) AS n, count(*) FILTER (benign_capped) AS capped FROM pub GROUP BY ALL"),
)
def fl09(spark, sf):
    """High rows of benign addresses shown as medium, except in the non-commercial tier."""
    return (
        published(spark, sf)
        .groupBy("tier", "band")
        .agg(F.count("*").alias("n"), F.count_if("benign_capped").alias("capped"))
    )


@query(
    "jn07_benign_semi_join",
    psql("SELECT indicator FROM pub WHERE tier = 'primary' AND benign_capped"),
)
def jn07(spark, sf):
    """Published addresses in the benign set."""
    return published(spark, sf, ("primary",)).filter("benign_capped").select("indicator")


@query("fl10_family_split", psql("SELECT tier, family::BIGINT AS family, count(*) AS n FROM pub GROUP BY ALL"))
def fl10(spark, sf):
    """Published rows per family."""
    return published(spark, sf).groupBy("tier", "family").agg(F.count("*").alias("n"))


@query("ag10_drop_counts", jsql("SELECT tier, drop_reason, count(*) AS dropped FROM judged WHERE drop_reason IS NOT NULL GROUP BY ALL"))
def ag10(spark, sf):
    """Rows dropped per rule."""
    return safety.drop_counts(judged(spark, sf))


@query(
    "tk04_drop_examples",
    jsql(
        "SELECT tier, drop_reason, indicator, rank FROM (SELECT *, row_number() OVER (PARTITION BY tier, drop_reason ORDER BY family, lo, coalesce(prefix, 128)) AS rank "
        "FROM judged WHERE drop_reason IS NOT NULL) WHERE rank <= 5"
    ),
)
def tk04(spark, sf):
    """First five examples per rule, in address order."""
    return safety.drop_examples(judged(spark, sf)).select("tier", "drop_reason", "indicator", "rank")


# ------------------------------------------------------------------ interval joins

_ENT = "ent AS (SELECT DISTINCT indicator, family, is_net, prefix, lo, hi FROM obs)"


@query(
    "jn02_allowlist_anti_join",
    D.with_sql(
        D.OBS,
        D.ALLOW,
        _ENT,
        select="SELECT indicator FROM ent e WHERE NOT EXISTS (SELECT 1 FROM allow a WHERE a.family = e.family AND a.lo <= e.hi AND a.hi >= e.lo)",
    ),
)
def jn02(spark, sf):
    """Entries overlapping no allowed network, in either direction."""
    entries = D.observations(spark, sf).select(*A.ADDRESS_COLUMNS).distinct().persist(StorageLevel.DISK_ONLY)
    return intervals.without_overlap(entries, D.allowed(spark, sf)).select("indicator")


@query(
    "jn03_network_lookup",
    D.with_sql(
        D.OBS,
        D.RANGES,
        _ENT,
        select="SELECT indicator, coalesce(asn, 0) AS asn, coalesce(country, '??') AS country, coalesce(name, 'unrouted or unknown') AS name "
        "FROM ent e LEFT JOIN ranges r ON e.family = 4 AND e.lo BETWEEN r.lo AND r.hi",
    ),
)
def jn03(spark, sf):
    """Network of every entry's first address."""
    from quorumlens.operators.networks import enrich

    entries = D.observations(spark, sf).select(*A.ADDRESS_COLUMNS).distinct()
    return enrich(entries, D.ranges(spark, sf)).select("indicator", "asn", "country", "name")


@query(
    "jn03_overlapping_ranges",
    D.with_sql(
        D.OBS,
        _ENT,
        "rng AS (SELECT 16777216 + s_suppkey * 99991 AS lo, 16777216 + s_suppkey * 99991 + s_suppkey % 7 * 60000 AS hi, s_name AS name FROM supplier)",
        select="SELECT indicator, CASE WHEN e.lo <= r.hi THEN r.name END AS name FROM (SELECT * FROM ent WHERE family = 4) e ASOF LEFT JOIN rng r ON e.lo >= r.lo "
        "UNION ALL SELECT indicator, NULL FROM ent WHERE family = 6",
    ),
)
def jn03_overlap(spark, sf):
    """The range with the greatest start answers where ranges overlap, and only if it reaches the address."""
    start = F.lit(16777216) + F.col("s_suppkey") * 99991
    ranges = D.table(spark, sf, "supplier").select(
        start.alias("lo"), (start + F.col("s_suppkey") % 7 * 60000).alias("hi"), F.col("s_name").alias("name")
    )
    entries = D.observations(spark, sf).select(*A.ADDRESS_COLUMNS).distinct()
    return ordered.as_of(entries, ranges, ["name"], "net").select("indicator", "net.name")


def _targets(spark, sf):
    """Orders as looked-up addresses, some of them unreadable."""
    o = D.table(spark, sf, "orders").select((F.col("o_orderkey") % 24000).alias("slot"), "o_orderkey")
    text = A.v4_text(D.v4_of(F.col("slot")) + F.col("o_orderkey") % 3)
    six = F.concat(
        F.lit("2a00:1:"), F.lower(F.hex(F.lit(4096) + F.col("slot") % 4096)), F.lit("::"), F.lower(F.hex(F.col("o_orderkey") % 3 + 1))
    )
    target = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("host-"), "o_orderkey")).when(
        F.col("o_orderkey") % 4 == 1, six
    ).otherwise(text)
    return A.with_address(o.select(target.alias("target")).distinct(), "target", "address")


_TARGETS = f"""tgt AS (SELECT DISTINCT target, family, n FROM (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN concat('host-', o_orderkey) WHEN o_orderkey % 4 = 1 THEN concat('2a00:1:', printf('%x', 4096 + slot % 4096), '::', o_orderkey % 3 + 1)
      ELSE {D.v4_text_sql('n4')} END AS target,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 6 ELSE 4 END AS family,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN CAST(10752 AS HUGEINT) * CAST('{2**112}' AS HUGEINT) + CAST('{2**96}' AS HUGEINT)
        + CAST(4096 + slot % 4096 AS HUGEINT) * CAST('{2**80}' AS HUGEINT) + o_orderkey % 3 + 1 ELSE CAST(n4 AS HUGEINT) END AS n
  FROM (SELECT o_orderkey, o_orderkey % 24000 AS slot, {D.V4_OF.format(slot='(o_orderkey % 24000)')} + o_orderkey % 3 AS n4 FROM orders)))"""


@query(
    "jn04_explain_lookup",
    psql(
        "SELECT target, matched, CASE WHEN family IS NULL THEN 'invalid' WHEN exact IS NOT NULL THEN 'exact' WHEN matched IS NOT NULL THEN 'inside' ELSE 'absent' END AS match_kind FROM ("
        "SELECT t.target, t.family, max(e.indicator) AS exact, coalesce(max(e.indicator), arg_min(c.indicator, c.lo * 1000 + c.prefix)) AS matched FROM tgt t "
        "LEFT JOIN (SELECT * FROM pub WHERE tier = 'primary') e ON e.indicator = t.target "
        "LEFT JOIN (SELECT * FROM pub WHERE tier = 'primary' AND is_net) c ON c.family = t.family AND t.n BETWEEN c.lo AND c.hi GROUP BY ALL)".replace(
            "c.lo * 1000 + c.prefix", "CASE WHEN c.family = 4 THEN c.lo * 1000 + c.prefix ELSE c.lo // 1000 * 1000 + c.prefix END"
        ),
        _TARGETS,
    ),
)
def jn04(spark, sf):
    """Why an address is or is not published: exact entry, containing network, absent or unreadable."""
    return intervals.explain_targets(_targets(spark, sf), published(spark, sf, ("primary",)))


@query(
    "jn05_provenance",
    psql(
        "SELECT p.tier, p.indicator, s.name AS source, s.independence_class, s.weight, s.vote, s.redistribute FROM (SELECT tier, indicator, unnest(sources) AS source FROM pub) p JOIN src s ON p.source = s.name"
    ),
)
def jn05(spark, sf):
    """Published rows with the registry facts of every source behind them."""
    return reports.provenance(published(spark, sf), D.sources(spark)).select(
        "tier", "indicator", "source", "independence_class", "weight", "vote", "redistribute"
    )


# ------------------------------------------------------------------ state

STATE = ",\n".join(
    [
        D.PRIOR,
        D.FRESH,
        D.scored_sql("prior", D.CUT, "ps"),
        """state AS (SELECT p.indicator, first_seen, last_seen, band, len(classes) AS class_count FROM ps p WHERE tier = 'primary')""",
        "sight AS (SELECT indicator, source, max(last_seen) AS last_seen FROM prior GROUP BY ALL)",
    ]
)


def prior_state(spark, sf):
    """State after a run over the events before the cut (no safety rules, to keep all rows)."""
    obs = D.prior_observations(spark, sf)
    scored = corroborate.corroborate(obs, D.sources(spark), D.CUT, ("primary",), D.RULES)
    return carry.build_state(scored, obs)


def ssql(select: str, *more: str) -> str:
    return D.with_sql(D.SRC, D.OBS, STATE, *more, select=select)


@query(
    "ag08_latest_sightings",
    ssql("SELECT indicator, source, strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen FROM sight"),
)
def ag08(spark, sf):
    """Latest sighting per indicator and source."""
    return carry.latest_sightings(D.prior_observations(spark, sf))


@query(
    "st01_state_table",
    ssql(
        "SELECT s.indicator, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(s.last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen, band, class_count, "
        "(SELECT string_agg(concat(source, '=', strftime(g.last_seen, '%Y-%m-%d')), '|' ORDER BY source) FROM sight g WHERE g.indicator = s.indicator) AS sightings FROM state s"
    ),
)
def st01(spark, sf):
    """State a run leaves behind: scored rows with every source's latest sighting."""
    text = F.transform(
        "sightings", lambda s: F.concat(s["source"], F.lit("="), F.date_format(s["last_seen"], "yyyy-MM-dd"))
    )
    return prior_state(spark, sf).withColumn("sightings", text)


@query(
    "src19_state_scan_and_seed",
    ssql(
        "SELECT band, class_count, count(*) AS indicators, 0::BIGINT AS sightings FROM state WHERE band <> 'withheld' GROUP BY ALL"
    ),
)
def src19(spark, sf):
    """Cold start: state seeded from the published table carries no sightings."""
    scored = corroborate.corroborate(
        D.prior_observations(spark, sf), D.sources(spark), D.CUT, ("primary",), D.RULES
    )
    return (
        carry.seed_state(safety.publishable(scored))
        .groupBy("band", "class_count")
        .agg(F.count("*").alias("indicators"), F.sum(F.size("sightings")).alias("sightings"))
    )


CARRIED = f"""now_rep AS (SELECT DISTINCT indicator, source FROM fresh),
carried AS (
  SELECT g.indicator, g.source, t.first_seen, g.last_seen, s.categories
  FROM sight g JOIN state t USING (indicator) JOIN src s ON s.name = g.source
  WHERE s.enabled AND s.vote AND s.ttl_days > 0 AND g.last_seen < TIMESTAMP '{D.AS_OF}' AND DATE '{D.AS_OF}' - CAST(g.last_seen AS DATE) <= s.ttl_days
    AND g.indicator IN (SELECT indicator FROM now_rep) AND NOT EXISTS (SELECT 1 FROM now_rep n WHERE n.indicator = g.indicator AND n.source = g.source))"""


def carried_rows(spark, sf):
    return carry.carried_observations(
        D.fresh_observations(spark, sf), prior_state(spark, sf), D.sources(spark), D.AS_OF
    )


@query(
    "jn09_carried_votes",
    ssql(
        "SELECT indicator, source, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen, array_to_string(categories, '|') AS categories FROM carried",
        CARRIED,
    ),
)
def jn09(spark, sf):
    """Sightings of sources that missed the run, for indicators somebody reports now."""
    return carried_rows(spark, sf).select("indicator", "source", "first_seen", "last_seen", "categories")


_ALLOBS = """allobs AS (
  SELECT * EXCLUDE (event_id, value) FROM fresh UNION ALL BY NAME
  SELECT c.indicator, o.family, o.is_net, o.prefix, o.lo, o.hi, c.source, c.first_seen, c.last_seen, c.categories, CAST([] AS VARCHAR[]) AS tags,
    NULL::DATE AS source_last_reported, TRUE AS carried, FALSE AS evidence_stale, NULL::VARCHAR AS source_reference, NULL::VARCHAR AS source_registry
  FROM carried c JOIN (SELECT DISTINCT indicator, family, is_net, prefix, lo, hi FROM fresh) o USING (indicator))"""
MERGED = f"""{CARRIED},
{_ALLOBS},
{D.scored_sql('allobs')},
merged AS (SELECT s.* EXCLUDE (first_seen), least(s.first_seen, t.first_seen) AS first_seen, t.indicator IS NULL AS is_new FROM scored s LEFT JOIN state t USING (indicator))"""


def all_observations(spark, sf):
    """Fresh and carried observations."""
    fresh = D.fresh_observations(spark, sf).drop("event_id", "value")
    return fresh.unionByName(carried_rows(spark, sf))


def merged(spark, sf, tiers=("primary",)):
    scored = corroborate.corroborate(
        all_observations(spark, sf), D.sources(spark), D.AS_OF, tiers, D.RULES
    )
    return carry.merge_first_seen(scored, prior_state(spark, sf))


@query("so01_fresh_and_carried", ssql("SELECT source, carried, count(*) AS n FROM allobs GROUP BY ALL", CARRIED, _ALLOBS))
def so01(spark, sf):
    """Union of fresh and carried observations."""
    return all_observations(spark, sf).groupBy("source", "carried").agg(F.count("*").alias("n"))


@query(
    "st02_scored_with_carried",
    ssql("SELECT indicator, score, band, promoted_by FROM scored WHERE tier = 'primary'", CARRIED, _ALLOBS, D.scored_sql("allobs")),
)
def st02(spark, sf):
    """Scores with carried votes; carried rows cannot promote."""
    return corroborate.corroborate(
        all_observations(spark, sf), D.sources(spark), D.AS_OF, ("primary",), D.RULES
    ).select("indicator", "score", "band", "promoted_by")


@query(
    "jn06_first_seen_merge",
    ssql(
        "SELECT indicator, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, is_new FROM merged WHERE tier = 'primary'",
        MERGED,
    ),
)
def jn06(spark, sf):
    """Earliest first_seen across runs; unknown indicators are new."""
    return merged(spark, sf).select("indicator", "first_seen", "is_new")


def aged(spark, sf):
    """Ageing two weeks after the data ends, so that both fates occur."""
    fresh = D.fresh_observations(spark, sf).select("indicator").distinct()
    return carry.ageing(prior_state(spark, sf), fresh, D.sources(spark), "2024-02-06")


_AGED = (
    "SELECT indicator, CASE WHEN last_seen >= TIMESTAMP '2024-02-06' - INTERVAL 30 DAY THEN 'retained' ELSE 'aged_out' END AS fate "
    "FROM state WHERE indicator NOT IN (SELECT indicator FROM fresh)"
)


@query("jn08_ageing", ssql(_AGED))
def jn08(spark, sf):
    """State rows nobody reports now: kept in grace, or aged out."""
    return aged(spark, sf).select("indicator", "fate")


@query("st03_ageing_counts", ssql(f"SELECT fate, count(*) AS n FROM ({_AGED}) GROUP BY ALL"))
def st03(spark, sf):
    """How many state rows are retained and aged out; none comes back into the list."""
    return aged(spark, sf).groupBy("fate").agg(F.count("*").alias("n"))


_DELTA = (
    "delta AS (SELECT indicator, 'added' AS change FROM merged WHERE tier = 'primary' AND band <> 'withheld' AND indicator NOT IN (SELECT indicator FROM state WHERE band <> 'withheld') "
    "UNION ALL SELECT indicator, 'removed' FROM state WHERE band <> 'withheld' AND indicator NOT IN (SELECT indicator FROM merged WHERE tier = 'primary' AND band <> 'withheld'))"
)


def delta(spark, sf):
    now = safety.publishable(merged(spark, sf))
    before = prior_state(spark, sf).filter("band <> 'withheld'")
    return carry.published_delta(now, before)


@query("jn11_published_delta", ssql("SELECT * FROM delta", MERGED, _DELTA))
def jn11(spark, sf):
    """Added and removed indicators between two publications."""
    return delta(spark, sf)


@query(
    "so03_delta_counts_and_examples",
    ssql(
        "SELECT change, indicator, rank FROM (SELECT *, row_number() OVER (PARTITION BY change ORDER BY indicator) AS rank FROM delta) WHERE rank <= 20",
        MERGED,
        _DELTA,
    ),
)
def so03(spark, sf):
    """First twenty added and removed."""
    return safety.first_per_group(delta(spark, sf), ["change"], [F.col("indicator").asc()], 20)


@query(
    "fl12_churn",
    ssql(
        "SELECT old_high, new_high, round(abs(new_high - old_high) / old_high, 6) AS churn FROM (SELECT (SELECT count(*) FROM state WHERE band = 'high') AS old_high, "
        "(SELECT count(*) FROM merged WHERE tier = 'primary' AND band = 'high') AS new_high)",
        MERGED,
    ),
)
def fl12(spark, sf):
    """Relative change of the high list between two runs."""
    old = prior_state(spark, sf).agg(F.count_if(F.col("band") == "high").alias("n")).scalar()
    new = merged(spark, sf).agg(F.count_if(F.col("band") == "high").alias("new_high"))
    return new.withColumn("old_high", old).select(
        "old_high", "new_high", F.round(safety.churn(F.col("new_high"), F.col("old_high")), 6).alias("churn")
    )


@query("so05_observed_keys", D.with_sql(D.OBS, select="SELECT count(DISTINCT indicator) AS indicators FROM obs"))
def so05(spark, sf):
    """Distinct indicators observed."""
    return D.observations(spark, sf).select("indicator").distinct().agg(F.count("*").alias("indicators"))
