"""Statistics, reports and analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorumlens.catalog import adapters as D
from quorumlens.catalog.registry import query
from quorumlens.catalog.safety_queries import judged, psql, published
from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.operators import carry, families, intervals, membership, networks, reports, safety
from quorumlens.sources import registry as R

OBS_SRC = (D.SRC, D.OBS)
CLS = (
    "cls AS (SELECT DISTINCT indicator, independence_class AS c FROM obs JOIN src ON source = name WHERE vote), "
    "n AS (SELECT c, count(*) AS n FROM cls GROUP BY c)"
)
PAIRS = (
    "pairs AS (SELECT x.c AS a, y.c AS b, (SELECT count(*) FROM cls p JOIN cls q USING (indicator) WHERE p.c = x.c AND q.c = y.c) AS shared, x.n AS na, y.n AS nb "
    "FROM n x JOIN n y ON x.c < y.c)"
)


def osql(select: str, *more: str) -> str:
    return D.with_sql(*OBS_SRC, *more, select=select)


def class_patterns(spark, sf):
    return membership.class_patterns(D.observations(spark, sf), D.sources(spark))


@query("jn10_class_pairs", osql("SELECT a, b, shared FROM pairs WHERE shared > 0", CLS, PAIRS))
def jn10(spark, sf):
    """Indicators shared by each pair of classes."""
    return membership.pair_counts(class_patterns(spark, sf))


@query(
    "ag14_class_overlap",
    osql("SELECT a, b, shared, round(shared / (na + nb - shared), 4) AS jaccard FROM pairs", CLS, PAIRS),
)
def ag14(spark, sf):
    """Pairwise class overlap."""
    return membership.overlap(class_patterns(spark, sf))


_J = "SELECT a, b, shared, round(shared / (na + nb - shared), 4) AS jaccard FROM pairs ORDER BY jaccard DESC, a, b LIMIT "


@query("tk02_top_class_pairs", osql(_J + "20", CLS, PAIRS))
def tk02(spark, sf):
    """Twenty highest overlaps."""
    return membership.top_overlaps(class_patterns(spark, sf))


@query("tk07_top_eight_pairs", osql(_J + "8", CLS, PAIRS))
def tk07(spark, sf):
    """Eight highest overlaps."""
    return membership.top_overlaps(class_patterns(spark, sf), 8)


@query(
    "ag12_agreement_histogram",
    osql(
        "SELECT classes, count(*) AS indicators FROM (SELECT indicator, count(DISTINCT CASE WHEN vote THEN independence_class END) AS classes FROM obs JOIN src ON source = name GROUP BY 1) GROUP BY 1"
    ),
)
def ag12(spark, sf):
    """Indicators by number of voting classes, none included."""
    return membership.agreement(class_patterns(spark, sf))


@query(
    "ag13_source_contribution",
    osql(
        "SELECT source, addresses_reported, reported_only_by_this_source, coalesce(credit, license) AS credit, independence_class, redistribute AS republished, redistribute OR redistribute_noncommercial AS republished_noncommercial_tier FROM ("
        "SELECT source, count(*) AS addresses_reported, count(*) FILTER (k = 1) AS reported_only_by_this_source FROM (SELECT indicator, source, count(*) OVER (PARTITION BY indicator) AS k FROM (SELECT DISTINCT indicator, source FROM obs)) GROUP BY 1) JOIN src ON source = name"
    ),
)
def ag13(spark, sf):
    """Indicators per source, and those only it reports."""
    return membership.source_contribution(
        membership.source_patterns(D.observations(spark, sf)), D.sources(spark)
    )


@query(
    "jn15_source_containment",
    osql(
        "SELECT a.source AS row_source, b.source AS col_source, count(*) AS shared, round(count(*) * 100.0 / max(n), 1)::DOUBLE AS percent FROM pr a JOIN pr b USING (indicator) JOIN sz ON sz.source = a.source WHERE a.source <> b.source GROUP BY ALL",
        "pr AS (SELECT DISTINCT indicator, source FROM obs)",
        "sz AS (SELECT source, count(*) AS n FROM pr GROUP BY 1)",
    ),
)
def jn15(spark, sf):
    """Share of each source's indicators also in each other source."""
    return membership.containment(membership.source_patterns(D.observations(spark, sf)))


@query(
    "jn15_lineitem_containment",
    "WITH pr AS (SELECT DISTINCT l_partkey, concat(l_returnflag, l_linestatus) AS s FROM lineitem), sz AS (SELECT s, count(*) AS n FROM pr GROUP BY 1) "
    "SELECT a.s AS row_source, b.s AS col_source, count(*) AS shared, round(count(*) * 100.0 / max(n), 1)::DOUBLE AS percent FROM pr a JOIN pr b USING (l_partkey) JOIN sz ON sz.s = a.s WHERE a.s <> b.s GROUP BY ALL",
)
def jn15_line(spark, sf):
    """The same over line items: parts shared between flag pairs."""
    line = D.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("indicator"), F.concat("l_returnflag", "l_linestatus").alias("m")
    )
    return membership.containment(membership.patterns(line, F.col("m")))


@query(
    "jn16_candidate_source",
    osql(
        "SELECT source, shared, round(shared / (n_source + nc - shared), 4) AS jaccard, shared / (n_source + nc - shared) > 0.5 AS same_class FROM ("
        "SELECT source, count(*) AS n_source, count(*) FILTER (indicator IN (SELECT indicator FROM cand)) AS shared, (SELECT count(*) FROM cand) AS nc FROM base GROUP BY 1)",
        D.scored_sql(),
        "cand AS (SELECT DISTINCT indicator FROM obs WHERE event_id % 3 = 0)",
        "base AS (SELECT DISTINCT indicator, source FROM obs UNION ALL SELECT DISTINCT indicator, '(published)' FROM scored WHERE tier = 'primary' AND band <> 'withheld')",
    ),
)
def jn16(spark, sf):
    """A candidate list measured against every source and the published table."""
    from quorumlens.catalog.scoring_queries import scored

    obs = D.observations(spark, sf)
    candidate = obs.filter(F.col("event_id") % 3 == 0)
    return membership.candidate_overlap(candidate, obs, safety.publishable(scored(spark, sf)))


# ------------------------------------------------------------------ networks

ENR = """enr AS (SELECT o.*, coalesce(r.asn, 0) AS asn, coalesce(r.country, '??') AS country, least(CASE WHEN is_net THEN o.hi - o.lo + 1 ELSE 1 END, 1024)::BIGINT AS w
  FROM obs o LEFT JOIN ranges r ON o.family = 4 AND o.lo BETWEEN r.lo AND r.hi),
firstname AS (SELECT asn, arg_min(name, lo) AS name FROM ranges GROUP BY 1),
roll AS (SELECT e.asn, max(f.name) AS name, sum(w)::BIGINT AS addresses, count(DISTINCT source) AS sources_reporting FROM enr e LEFT JOIN firstname f USING (asn) WHERE family = 4 AND e.asn <> 0 GROUP BY 1)"""


def nsql(select: str, *more: str) -> str:
    return D.with_sql(*OBS_SRC, D.RANGES, ENR, *more, select=select)


def enriched(spark, sf):
    return networks.enriched_observations(D.observations(spark, sf), D.ranges(spark, sf))


def rollup(spark, sf):
    return networks.network_rollup(enriched(spark, sf), D.ranges(spark, sf))


@query("ag20_network_rollup", nsql("SELECT * FROM roll"))
def ag20(spark, sf):
    """Weighted addresses and sources per ASN."""
    return rollup(spark, sf)


@query("tk01_top_networks", nsql("SELECT * FROM roll WHERE addresses >= 5 ORDER BY addresses DESC, asn LIMIT 25"))
def tk01(spark, sf):
    """Twenty-five largest ASNs above the minimum cell."""
    return networks.top_networks(rollup(spark, sf))


_SMALLC = "(SELECT count(*) FROM (SELECT country, sum(w) AS a FROM enr WHERE family = 4 AND asn <> 0 GROUP BY 1) WHERE a < 5)"


@query(
    "ag20_suppressed_networks",
    nsql(
        "SELECT count(*) AS distinct_asns, count(*) FILTER (addresses < 5) AS asns_below_threshold, coalesce(sum(addresses) FILTER (addresses < 5), 0)::BIGINT AS addresses_in_suppressed_asns, "
        + _SMALLC
        + " AS countries_below_threshold FROM roll"
    ),
)
def ag20s(spark, sf):
    """Totals folded away below the minimum cell."""
    e = enriched(spark, sf)
    return networks.suppressed_networks(networks.network_rollup(e, D.ranges(spark, sf)), e)


@query("ag21_small_countries", nsql("SELECT " + _SMALLC + " AS countries_below_threshold"))
def ag21(spark, sf):
    """How many countries stay below the minimum cell; none is named."""
    return networks.small_countries(enriched(spark, sf))


@query(
    "ag22_unenriched",
    nsql(
        "SELECT count(*) FILTER (family = 4 AND asn = 0) AS unenriched_no_asn, count(*) FILTER (family = 6) AS unenriched_ipv6, count(*) FILTER (asn = 0) AS unenriched_observations FROM enr"
    ),
)
def ag22(spark, sf):
    """Observations without a network, by reason."""
    return networks.unenriched(enriched(spark, sf))


@query("jn13_network_names", D.with_sql(D.RANGES, select="SELECT asn, arg_min(name, lo) AS name FROM ranges GROUP BY 1"))
def jn13(spark, sf):
    """Name of an ASN's first range."""
    return networks.network_names(D.ranges(spark, sf))


@query("ag27_announced_sizes", D.with_sql(D.RANGES, select="SELECT asn, sum(hi - lo + 1)::BIGINT AS announced FROM ranges GROUP BY 1"))
def ag27(spark, sf):
    """Addresses announced per ASN."""
    return networks.announced_sizes(D.ranges(spark, sf))


SPECTRUM = """spec AS (SELECT b.bucket, coalesce(h.n, 0) AS observations FROM (SELECT unnest(generate_series(0, 511)) AS bucket) b
  LEFT JOIN (SELECT bucket, count(*) AS n FROM (SELECT unnest(generate_series(CAST(lo // 8388608 AS BIGINT), CAST(hi // 8388608 AS BIGINT))) AS bucket FROM obs WHERE family = 4) GROUP BY 1) h USING (bucket))"""


@query("ag23_spectrum", osql("SELECT bucket, observations FROM spec", SPECTRUM))
def ag23(spark, sf):
    """Observations per slice of IPv4 space."""
    return networks.spectrum(D.observations(spark, sf))


@query(
    "ag23_spectrum_summary",
    osql(
        "SELECT count(*) FILTER (observations > 0) AS occupied_buckets, count(*) FILTER (observations = 0) AS empty_buckets, max(observations) AS peak FROM spec",
        SPECTRUM,
    ),
)
def ag23s(spark, sf):
    """Occupied and empty slices, and the peak."""
    return networks.spectrum_summary(networks.spectrum(D.observations(spark, sf)))


@query(
    "ag24_address_grid",
    osql(
        "SELECT octet, observations, round(CASE WHEN observations = 0 THEN 0.07 ELSE 0.2 + 0.8 * ln(1 + observations) / ln(1 + max(observations) OVER ()) END, 3) AS shade, octet >= 224 AS reserved "
        "FROM (SELECT bucket // 2 AS octet, sum(observations)::BIGINT AS observations FROM spec GROUP BY 1)",
        SPECTRUM,
    ),
)
def ag24(spark, sf):
    """One cell per /8, logarithmically shaded."""
    return networks.grid(networks.spectrum(D.observations(spark, sf)))


@query(
    "ag24_grid_summary",
    osql(
        "SELECT count(*) FILTER (observations > 0) AS occupied, arg_max(octet, observations * 1000 - octet) AS busiest, max(observations) AS busiest_observations "
        "FROM (SELECT bucket // 2 AS octet, sum(observations)::BIGINT AS observations FROM spec GROUP BY 1)",
        SPECTRUM,
    ),
)
def ag24s(spark, sf):
    """Occupied /8s and the busiest."""
    return networks.grid_summary(networks.grid(networks.spectrum(D.observations(spark, sf))))


HIST = f"""today AS (SELECT coalesce(source_last_reported, DATE '{D.AS_OF}') AS day, asn, count(DISTINCT indicator) AS addresses FROM enr WHERE family = 4 AND asn <> 0 GROUP BY 1, 2),
earlier AS (SELECT CAST(last_seen AS DATE) - 60 AS day, asn, count(DISTINCT indicator) AS addresses FROM enr WHERE family = 4 AND asn <> 0 GROUP BY 1, 2
  UNION ALL SELECT coalesce(source_last_reported, DATE '{D.AS_OF}') AS day, asn, count(DISTINCT indicator) + asn % 3 - 1 AS addresses FROM enr WHERE family = 4 AND asn <> 0 GROUP BY 1, 2),
hist AS (SELECT day, asn, max(addresses) AS addresses FROM (SELECT * FROM today UNION ALL SELECT * FROM earlier) WHERE day >= DATE '{D.AS_OF}' - 90 GROUP BY 1, 2)"""


def today(spark, sf):
    return networks.daily_networks(D.observations(spark, sf), D.ranges(spark, sf), D.AS_OF)


def history(spark, sf):
    """History of earlier runs (sixty days back, and differing counts for known days) with this run."""
    obs = D.observations(spark, sf)
    back = obs.withColumn("source_last_reported", F.date_sub(F.to_date("last_seen"), 60))
    old = networks.daily_networks(back, D.ranges(spark, sf), D.AS_OF)
    now = today(spark, sf)
    differing = now.withColumn("addresses", F.col("addresses") + F.col("asn") % 3 - 1)
    return networks.merge_history(old.unionByName(differing), now, D.AS_OF)


@query("ag25_daily_networks", nsql("SELECT CAST(day AS VARCHAR) AS day, asn, addresses FROM today", HIST))
def ag25(spark, sf):
    """Distinct entries per upstream day and ASN."""
    return today(spark, sf)


@query("jn12_history_merge", nsql("SELECT CAST(day AS VARCHAR) AS day, asn, addresses FROM hist", HIST))
def jn12(spark, sf):
    """History merged by maximum, ninety days kept."""
    return history(spark, sf)


@query(
    "st04_history_reread",
    nsql("SELECT CAST(day AS VARCHAR) AS day, sum(addresses)::BIGINT AS addresses FROM today GROUP BY ALL", HIST),
)
def st04(spark, sf):
    """Reading the same run twice changes nothing."""
    now = today(spark, sf)
    twice = networks.merge_history(networks.merge_history(None, now, D.AS_OF), now, D.AS_OF)
    return twice.groupBy("day").agg(F.sum("addresses").alias("addresses"))


@query("fl13_retention", nsql("SELECT count(DISTINCT day) AS days, CAST(min(day) AS VARCHAR) AS oldest FROM hist", HIST))
def fl13(spark, sf):
    """Days left after the ninety-day cut."""
    return history(spark, sf).agg(F.count_distinct("day").alias("days"), F.min("day").alias("oldest"))


WINS = f"""wins AS (
  SELECT w AS "window", asn, sum(addresses)::BIGINT AS address_days, count(*) AS days_active, max(addresses) AS peak_day FROM hist CROSS JOIN
    (VALUES ('all_time', 100000), ('last_30_days', 30), ('last_60_days', 60)) v(w, n) WHERE day >= DATE '{D.AS_OF}' - CAST(n - 1 AS INTEGER) GROUP BY 1, 2 HAVING sum(addresses) >= 5),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "window" ORDER BY days_active DESC, address_days DESC, asn) AS rank FROM wins)"""


@query("ag26_window_totals", nsql("SELECT * FROM wins", HIST, WINS))
def ag26(spark, sf):
    """Address-days, active days and peak day per window and ASN."""
    return networks.window_totals(history(spark, sf), D.AS_OF)


@query(
    "tk03_persistent_networks",
    nsql(
        'SELECT "window", rank, asn, coalesce(f.name, \'unknown\') AS name, address_days, days_active, peak_day, announced, '
        "CASE WHEN announced >= 256 THEN round(address_days / (announced / 1000000.0), 1) END AS per_million FROM ranked LEFT JOIN firstname f USING (asn) "
        "LEFT JOIN (SELECT asn, sum(hi - lo + 1)::BIGINT AS announced FROM ranges GROUP BY 1) a USING (asn) WHERE rank <= 10",
        HIST,
        WINS,
    ),
)
def tk03(spark, sf):
    """Ten most persistent networks per window."""
    return networks.persistence(history(spark, sf), D.ranges(spark, sf), D.AS_OF)


@query(
    "tk08_window_completeness",
    nsql(
        f"SELECT count(DISTINCT day) AS days_recorded, (DATE '{D.AS_OF}' - min(day) + 1)::BIGINT AS span_days, CAST(min(day) AS VARCHAR) AS oldest, CAST(max(day) AS VARCHAR) AS newest, "
        f"DATE '{D.AS_OF}' - min(day) + 1 >= 30 AS last_30_complete, DATE '{D.AS_OF}' - min(day) + 1 >= 60 AS last_60_complete FROM hist",
        HIST,
    ),
)
def tk08(spark, sf):
    """Span of the history and which windows it fills."""
    return networks.history_span(history(spark, sf), D.AS_OF)


# ------------------------------------------------------------------ families


@query(
    "ag15_family_coverage",
    osql(
        "SELECT source, count(*) FILTER (family = 6) AS ipv6_observations, count(*) FILTER (family = 4) AS ipv4_observations, any_value(independence_class) AS independence_class, any_value(redistribute) AS redistributable "
        "FROM obs JOIN src ON source = name GROUP BY 1 HAVING count(*) FILTER (family = 6) > 0"
    ),
)
def ag15(spark, sf):
    """Sources reporting IPv6, with both families' counts."""
    return families.observation_coverage(D.observations(spark, sf), D.sources(spark))


P1 = "p1 AS (SELECT *, coalesce(prefix, CASE WHEN family = 4 THEN 32 ELSE 128 END) AS plen FROM pub WHERE tier = 'primary')"
SUB64 = f"CASE WHEN NOT is_net THEN 1 WHEN family = 4 THEN hi - lo + 1 ELSE greatest((hi - lo + 1) // CAST('{2**64}' AS HUGEINT), 1) END"


def fsql(select: str, *more: str) -> str:
    return psql(select, P1, *more)


def primary(spark, sf):
    return published(spark, sf, ("primary",))


@query(
    "ag16_family_stats",
    fsql(
        f"SELECT family::BIGINT AS family, concat('v', family) AS address_family, count(*) AS published, count(*) FILTER (band = 'high') AS high, count(*) FILTER (band = 'medium') AS medium, "
        f"CAST(sum({SUB64}) AS VARCHAR) AS blast_radius_64, count(DISTINCT lo // CASE WHEN family = 4 THEN 65536::HUGEINT ELSE CAST('{2**96}' AS HUGEINT) END) AS distinct_allocations, "
        "(SELECT count(DISTINCT c) FROM (SELECT unnest(classes) AS c FROM p1 q WHERE q.family = p1.family)) AS independence_classes, "
        "(SELECT count(DISTINCT c) FROM (SELECT unnest(sources) AS c FROM p1 q WHERE q.family = p1.family)) AS sources FROM p1 GROUP BY family"
    ),
)
def ag16(spark, sf):
    """Published rows, scope and breadth per family."""
    return families.family_stats(primary(spark, sf))


@query(
    "ag17_scope_by_prefix",
    fsql(
        f"SELECT family::BIGINT AS family, concat('/', plen) AS prefix, count(*) AS entries, CAST(sum({SUB64}) AS VARCHAR) AS blast_radius_64, CAST(max({SUB64}) AS VARCHAR) AS one_entry_64 FROM p1 GROUP BY family, plen"
    ),
)
def ag17(spark, sf):
    """Entries and scope per prefix length."""
    return families.scope_by_prefix(primary(spark, sf))


@query(
    "ag17_ipv6_totals",
    fsql(
        f"SELECT count(*) AS entries, sum(greatest((hi - lo + 1) // CAST('{2**80}' AS HUGEINT), 1))::BIGINT AS sites_48, count(DISTINCT lo // CAST('{2**96}' AS HUGEINT)) AS distinct_allocations_32 FROM p1 WHERE family = 6"
    ),
)
def ag17t(spark, sf):
    """IPv6 entries, sites and allocations."""
    return families.ipv6_totals(primary(spark, sf))


@query(
    "ag18_folded_prefixes",
    fsql(
        "SELECT family::BIGINT AS family, CASE WHEN n >= 5 THEN k END AS key, sum(n)::BIGINT AS entries, count(*) AS cells FROM (SELECT family, concat('/', plen) AS k, count(*) AS n FROM p1 GROUP BY ALL) GROUP BY ALL"
    ),
)
def ag18(spark, sf):
    """Prefix histogram, cells under five folded."""
    return families.prefix_histogram(primary(spark, sf))


@query(
    "ag18_folded_blocks",
    fsql(
        f"SELECT family::BIGINT AS family, CASE WHEN n >= 5 THEN k END AS key, sum(n)::BIGINT AS entries, count(*) AS cells FROM (SELECT family, concat(printf('%x', CAST(lo // CAST('{2**116}' AS HUGEINT) AS BIGINT) * 16), '::/12') AS k, count(*) AS n FROM p1 WHERE family = 6 GROUP BY ALL) GROUP BY ALL"
    ),
)
def ag18b(spark, sf):
    """IPv6 entries per /12, cells under five folded."""
    return families.unicast_blocks(primary(spark, sf))


@query(
    "fl11_min_cell",
    nsql(
        "SELECT CASE WHEN addresses >= 5 THEN asn END AS asn, sum(addresses)::BIGINT AS addresses, count(*) AS cells FROM roll GROUP BY 1"
    ),
)
def fl11(spark, sf):
    """ASNs under the minimum cell folded into one unnamed row."""
    return (
        rollup(spark, sf)
        .groupBy(F.when(F.col("addresses") >= K.MIN_CELL, F.col("asn")).alias("asn"))
        .agg(F.sum("addresses").alias("addresses"), F.count("*").alias("cells"))
    )


def _own(column: str) -> str:
    """Distinct elements of an array column in the entries of one family."""
    return f"(SELECT count(DISTINCT c) FROM (SELECT unnest({column}) AS c FROM p1 q WHERE q.family = p1.family))"


@query(
    "ag19_flat_dimensions",
    fsql(
        "SELECT family::BIGINT AS family, analysis, v AS distinct_values, reason FROM (SELECT family, unnest(["
        "{'analysis': 'Score distribution', 'v': count(DISTINCT score), 'reason': concat('all scores are ', round(min(score), 1))}, "
        "{'analysis': 'Band split', 'v': count(DISTINCT band), 'reason': concat('all entries are ', min(band))}, "
        "{'analysis': 'Category breakdown', 'v': count(DISTINCT list_sort(categories)), 'reason': 'all entries have one set of categories'}, "
        f"{{'analysis': 'Corroboration histogram', 'v': {_own('classes')}, 'reason': concat({_own('classes')}, ' class in all')}}, "
        f"{{'analysis': 'Added and removed each run', 'v': {_own('sources')}, 'reason': 'one source, so all entries come and go together'}}, "
        "{'analysis': 'Network and ASN persistence', 'v': CASE WHEN family = 6 THEN 0::BIGINT END, 'reason': 'no range names an IPv6 network'}"
        "], recursive := true) FROM p1 GROUP BY family) WHERE v < 2"
    ),
)
def ag19(spark, sf):
    """Analyses without signal per family, and why."""
    return families.flat_dimensions(primary(spark, sf))


@query(
    "ag19_flat_after_one_source",
    fsql(
        "SELECT 6::BIGINT AS family, analysis, v AS distinct_values FROM (SELECT unnest(["
        "{'analysis': 'Score distribution', 'v': count(DISTINCT score)}, {'analysis': 'Band split', 'v': count(DISTINCT band)}, "
        "{'analysis': 'Category breakdown', 'v': count(DISTINCT list_sort(categories))}, "
        "{'analysis': 'Corroboration histogram', 'v': (SELECT count(DISTINCT c) FROM (SELECT unnest(classes) AS c FROM one))}, "
        "{'analysis': 'Added and removed each run', 'v': (SELECT count(DISTINCT c) FROM (SELECT unnest(sources) AS c FROM one))}, "
        "{'analysis': 'Network and ASN persistence', 'v': 0::BIGINT}], recursive := true) FROM one HAVING count(*) > 0) WHERE v < 2",
        "one AS (SELECT * FROM p1 WHERE family = 6 AND sources = ['blocks'])",
    ),
)
def ag19_one(spark, sf):
    """Entries that one source alone reports have several flat dimensions."""
    alone = primary(spark, sf).filter((F.col("family") == 6) & (F.col("sources") == F.array(F.lit("blocks"))))
    return families.flat_dimensions(alone).drop("reason")


@query(
    "ag33_concentration",
    fsql(
        "SELECT family::BIGINT AS family, count(*) AS entries, (SELECT count(DISTINCT c) FROM (SELECT unnest(classes) AS c FROM p1 q WHERE q.family = p1.family)) AS classes, "
        "(SELECT count(DISTINCT c) FROM (SELECT unnest(classes) AS c FROM p1 q WHERE q.family = p1.family)) < 2 AS single_class FROM p1 GROUP BY family"
    ),
)
def ag33(spark, sf):
    """Families resting on a single class."""
    return families.concentration(primary(spark, sf))


def _listed_blocks(spark, sf):
    """Line items as IPv6 networks: eight for a part, of which orders leave some unlisted, so neighbours collapse
    in part."""
    line = D.table(spark, sf, "lineitem").select(
        (F.lit(5 << 16) + F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("u"),
        (F.col("l_suppkey") % 5).alias("m"),
    ).distinct()
    part = lambda n: F.lower(F.hex(n))
    text = F.concat(
        F.lit("2a00:"),
        part(F.floor(F.col("u") / 65536)),
        F.lit(":"),
        part(F.col("u") % 65536),
        F.lit("::/"),
        F.when(F.col("m") == 0, "47").otherwise("48"),
    )
    return A.with_address(line.select(text.alias("t")).distinct(), "t", "network").drop("t")


# Blocks of 2**p units of /48, full when every unit is listed; the widest full ones that hold several
# listed networks.
_RUNS14 = """nets AS (SELECT DISTINCT 327680 + l_partkey * 8 + l_linenumber AS u0, CASE WHEN l_suppkey % 5 = 0 THEN 47 ELSE 48 END AS prefix FROM lineitem),
nets2 AS (SELECT DISTINCT CASE WHEN prefix = 47 THEN u0 // 2 * 2 ELSE u0 END AS u, prefix FROM nets),
units AS (SELECT u FROM nets2 UNION SELECT u + 1 FROM nets2 WHERE prefix = 47),
full_blocks AS (SELECT p, u // (1 << p) AS b FROM units, (SELECT unnest(generate_series(0, 32)) AS p) GROUP BY ALL HAVING count(*) = 1 << p),
roots AS (SELECT * FROM full_blocks f WHERE NOT EXISTS (SELECT 1 FROM full_blocks g WHERE g.p = f.p + 1 AND g.b = f.b // 2)),
mem AS (SELECT r.p, r.b, n.u, n.prefix, count(*) OVER (PARTITION BY r.p, r.b) AS members FROM roots r JOIN nets2 n ON n.u // (1 << r.p) = r.b AND 48 - n.prefix <= r.p)"""


def _v6(u: str) -> str:
    return f"concat('2a00:', printf('%x', ({u}) // 65536), CASE WHEN ({u}) % 65536 = 0 THEN '' ELSE concat(':', printf('%x', ({u}) % 65536)) END, '::/')"


@query(
    "jn14_contiguous_runs",
    D.with_sql(
        _RUNS14,
        select=f"SELECT concat({_v6('b * (1::BIGINT << p)')}, 48 - p) AS aggregate, concat({_v6('u')}, prefix) AS member, members FROM mem WHERE members > 1",
    ),
)
def jn14(spark, sf):
    """Neighbouring IPv6 networks and the block they fill together."""
    runs = intervals.aggregated_runs(_listed_blocks(spark, sf))
    return runs.select(
        F.concat(A.v6_text("block"), F.lit("/"), F.col("block_prefix")).alias("aggregate"), "member", "members"
    )


# ------------------------------------------------------------------ reports

FINALN = (
    "SELECT tier, count(*) AS indicators, count(*) FILTER (drop_reason IS NULL AND band <> 'withheld') AS published, count(*) FILTER (drop_reason IS NULL AND band = 'high') AS high, "
    "count(*) FILTER (drop_reason IS NULL AND band = 'medium') AS medium, count(*) FILTER (drop_reason IS NULL AND band = 'withheld') AS withheld, "
    "count(*) FILTER (drop_reason IS NULL AND band <> 'withheld' AND promoted_by IS NOT NULL) AS promoted, count(*) FILTER (drop_reason IS NULL AND band <> 'withheld' AND benign_capped) AS benign_capped FROM final GROUP BY tier"
)


@query("ag09_run_counts", psql(FINALN))
def ag09(spark, sf):
    """Counters of a run, all tiers."""
    return reports.run_counts(judged(spark, sf, with_labels=True))


@query("ag11_corroboration_histogram", psql("SELECT tier, len(classes) AS classes, count(*) AS indicators FROM pub GROUP BY ALL"))
def ag11(spark, sf):
    """Published rows by number of classes."""
    return reports.corroboration_histogram(published(spark, sf))


@query(
    "ag28_corpus_counts",
    osql(
        "SELECT count(DISTINCT indicator) AS addresses_observed, count(DISTINCT source) AS sources_contributing, count(DISTINCT CASE WHEN vote THEN independence_class END) AS independence_classes, "
        "(SELECT count(*) FROM scored WHERE tier = 'primary' AND band <> 'withheld') AS addresses_published_primary FROM obs JOIN src ON source = name",
        D.scored_sql(),
    ),
)
def ag28(spark, sf):
    """Size of the corpus."""
    from quorumlens.catalog.scoring_queries import scored

    return reports.corpus_counts(D.observations(spark, sf), scored(spark, sf), D.sources(spark))


@query(
    "ag32_contributing_sources",
    psql(
        "SELECT DISTINCT tier, source, 'contributing' AS role FROM (SELECT tier, unnest(sources) AS source FROM pub)"
    ),
)
def ag32(spark, sf):
    """Sources behind each tier's list."""
    return reports.contributing_sources(published(spark, sf), D.sources(spark))


def _declared(spark, sf):
    """Attribution each source's events declare: the text in the latest one."""
    e = D.raw_entries(spark, sf).filter("source in ('blocks', 'purchase')")
    return e.groupBy("source").agg(
        F.max(F.struct("event_id", F.concat(F.lit("(c) "), F.col("event_id")).alias("v")))["v"].alias("copyright"),
        F.max(F.struct("event_id", F.concat(F.lit("terms-"), F.col("event_id")).alias("v")))["v"].alias("terms"),
    )


@query(
    "ag34_attribution",
    psql(
        "SELECT tier, source, coalesce(credit, copyright, license) AS credit, coalesce(terms, license_url) AS terms, CASE WHEN credit IS NOT NULL THEN coalesce(copyright, license) END AS detail "
        "FROM (SELECT DISTINCT tier, source FROM (SELECT tier, unnest(sources) AS source FROM pub)) JOIN src ON source = name LEFT JOIN dec USING (source)",
        "dec AS (SELECT source, concat('(c) ', max(event_id)) AS copyright, concat('terms-', max(event_id)) AS terms FROM obs WHERE source IN ('blocks', 'purchase') GROUP BY 1)",
    ),
)
def ag34(spark, sf):
    """Credit and terms of every contributing source."""
    contributing = reports.contributing_sources(published(spark, sf), D.sources(spark))
    return reports.attribution(contributing, D.sources(spark), _declared(spark, sf))


@query(
    "ag35_funnel",
    psql(
        "SELECT step, label, n AS indicators, round(n * 100.0 / max(n) OVER (), 0)::DOUBLE AS percent FROM (SELECT unnest([{'step': 1::BIGINT, 'label': 'observed', 'n': count(*)}, {'step': 2::BIGINT, 'label': 'restricted', 'n': count(*) FILTER (drop_reason = 'not_redistributable')}, "
        "{'step': 3::BIGINT, 'label': 'allowlisted', 'n': count(*) FILTER (drop_reason = 'allowlisted')}, {'step': 4::BIGINT, 'label': 'tag_only', 'n': count(*) FILTER (drop_reason = 'tag_only')}, "
        "{'step': 5::BIGINT, 'label': 'withheld', 'n': count(*) FILTER (drop_reason IS NULL AND band = 'withheld')}, {'step': 6::BIGINT, 'label': 'published', 'n': count(*) FILTER (drop_reason IS NULL AND band <> 'withheld')}], recursive := true) FROM final WHERE tier = 'primary')"
    ),
)
def ag35(spark, sf):
    """From observed to published, step by step."""
    return reports.funnel(judged(spark, sf, ("primary",), with_labels=True))


@query(
    "ag36_corroboration_shares",
    psql(
        "SELECT round(promoted * 100.0 / published, 0)::DOUBLE AS promoted_of_published, round(promoted * 100.0 / high, 0)::DOUBLE AS promoted_of_high, "
        "(SELECT count(*) FROM (SELECT indicator FROM obs JOIN src ON source = name WHERE vote GROUP BY 1 HAVING count(DISTINCT independence_class) = 1)) AS single_class_seen FROM (" + FINALN + ") WHERE tier = 'primary'"
    ),
)
def ag36(spark, sf):
    """Promoted share of the list; indicators only one class saw."""
    counts = reports.run_counts(judged(spark, sf, ("primary",), with_labels=True))
    single = membership.agreement(class_patterns(spark, sf)).filter("classes = 1").select("indicators")
    return reports.corroboration_shares(counts, single)


@query(
    "ag40_label_shares",
    psql(
        "SELECT tier, coalesce(label, 'unknown') AS label, count(*) AS addresses FROM pub LEFT JOIN (SELECT DISTINCT address, label FROM lab) ON address = indicator WHERE NOT is_net GROUP BY ALL"
    ),
)
def ag40(spark, sf):
    """Published addresses per classification."""
    return reports.label_shares(published(spark, sf), D.labels(spark, sf))


def _history(spark, sf):
    """One run per customer's order day: counts of orders as run numbers."""
    o = D.table(spark, sf, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("generated_at")).agg(
        F.count("*").alias("published"),
        F.count_if(F.col("o_orderstatus") != "P").alias("sources_ok"),
        F.count("*").alias("sources_total"),
    )


_RUNS = "runs AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS generated_at, count(*) AS published, count(*) FILTER (o_orderstatus <> 'P') AS sources_ok, count(*) AS sources_total FROM orders GROUP BY 1)"


@query(
    "ag37_run_health",
    D.with_sql(
        _RUNS,
        select="SELECT generated_at, sources_total - sources_ok AS missing, CASE WHEN sources_total - sources_ok >= 2 THEN 'severe' WHEN sources_total - sources_ok = 1 THEN 'partial' ELSE 'ok' END AS state FROM runs",
    ),
)
def ag37(spark, sf):
    """Health of every run."""
    return reports.run_health(_history(spark, sf))


_APPEND = (
    "SELECT * FROM (SELECT * FROM runs WHERE generated_at <> (SELECT max(generated_at) FROM runs) UNION ALL SELECT max(generated_at), count(*), 0::BIGINT, 1::BIGINT FROM runs) ORDER BY generated_at DESC LIMIT 720"
)


def _append(spark, sf):
    runs = _history(spark, sf)
    entry = runs.agg(
        F.max("generated_at").alias("generated_at"),
        F.count("*").alias("published"),
        F.lit(0).cast("bigint").alias("sources_ok"),
        F.lit(1).cast("bigint").alias("sources_total"),
    )
    return carry.append_run(runs, entry)


@query("tk06_rolling_history", D.with_sql(_RUNS, select=_APPEND))
def tk06(spark, sf):
    """Newest 720 runs, the same timestamp replaced."""
    return _append(spark, sf)


@query(
    "st05_run_history",
    D.with_sql(_RUNS, select=f"SELECT count(*) AS runs, min(generated_at) AS oldest, sum(published)::BIGINT AS published FROM ({_APPEND})"),
)
def st05(spark, sf):
    """Span of the kept history."""
    return _append(spark, sf).agg(
        F.count("*").alias("runs"), F.min("generated_at").alias("oldest"), F.sum("published").alias("published")
    )


@query(
    "ag29_active_classes",
    osql(
        "SELECT independence_class, count(*) AS observations FROM obs JOIN src ON source = name WHERE enabled AND vote AND weight > 0 GROUP BY 1"
    ),
)
def ag29(spark, sf):
    """Active voting classes and the observations behind them."""
    dim = D.sources(spark)
    active = R.active_voting_classes(dim)
    named = dim.select(F.col("name").alias("source"), "independence_class")
    per = D.observations(spark, sf).groupBy("source").agg(F.count("*").alias("n"))
    return (
        per.join(named, "source")
        .join(active, "independence_class", "left_semi")
        .groupBy("independence_class")
        .agg(F.sum("n").alias("observations"))
    )
