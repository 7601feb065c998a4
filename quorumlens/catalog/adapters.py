"""The driver tables seen as observations, sources, ranges, allowlist, labels and payload lines.

Each view exists twice: as a DataFrame and as the SQL (common table expressions) the results are
checked against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.operators.corroborate import Rules
from quorumlens.sources.registry import REGISTRY_SCHEMA, dimension

AS_OF = "2024-01-31"
CUT = "2024-01-17"
RULES = Rules(netblock_sources=("blocks",))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Result columns in the four types both engines print alike."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("string")
        elif kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "array<string>":
            c = F.array_join(c, "|")
        elif kind == "binary":
            c = F.lower(F.hex(c))
        out.append(c.alias(name))
    return df.select(*out)


# ------------------------------------------------------------------ sources

_SOURCES = [
    # name, ord, parser, url, class, weight, categories, ttl, enabled, vote, redistribute,
    # noncommercial only, explicit grant, noncommercial compatible, dormant, tag only, levels,
    # floor, licence, licence url, credit
    ("view", 0, "plain_text", "u/view", "web", 0.6, ["scanning"], 14, True, True, True, False, False, True, False, False, None, None, "terms A", None, "View project"),
    ("click", 1, "ipsum_levels", "u/click/{level}", "web", 0.5, ["web-attack"], 7, True, True, True, False, True, True, False, False, [3, 5], None, "CC0", "u/cc0", None),
    ("purchase", 2, "ipthreat", "u/purchase", "abusech", 0.8, ["brute-force", "scanning"], 30, True, True, True, False, False, True, False, False, None, 20, None, None, None),
    ("signup", 3, "plain_text", "u/signup", "forms", 0.9, ["reported-abuse"], 30, True, True, True, False, True, False, False, False, None, None, "CC BY-SA", "u/bysa", "Signup team"),
    ("error", 4, "abuseipdb", "u/error", "health", 0.7, ["reported-abuse"], 10, True, True, False, True, False, True, False, False, None, None, "CC BY-NC-SA", "u/nc", None),
    ("frozen", 5, "plain_text", "u/frozen", "cold", 0.4, ["abuse"], 30, True, True, True, False, True, False, True, False, None, None, "MIT", None, None),
    ("exits", 6, "plain_text", "u/exits", "exits", 0.0, ["tor-exit"], 14, True, False, True, False, True, True, False, True, None, None, "CC0", None, "Exit list"),
    ("blocks", 7, "spamhaus_json", "u/blocks", "blocks", 1.0, ["hijacked-netblock", "criminal-hosting"], 30, True, True, True, False, True, True, False, False, None, None, "named terms", "u/blocks/terms", None),
]


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_SOURCES, REGISTRY_SCHEMA)


def source_dimension(spark: SparkSession, *columns) -> DataFrame:
    """Registry columns keyed by ``source``, for joining observations."""
    return dimension(sources(spark), F.col("name").alias("source"), *columns)


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, list):
        return "[" + ", ".join(_sql_value(x) for x in v) + "]"
    if isinstance(v, float):
        return f"{v}::DOUBLE"
    return f"'{v}'" if isinstance(v, str) else str(v)


SRC = (
    "src AS (SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in _SOURCES)
    + ") AS v(name, ord, parser, url, independence_class, weight, categories, ttl_days, enabled, vote, "
    "redistribute, redistribute_noncommercial, explicit_grant, noncommercial_compatible, dormant, "
    "tag_only, levels, min_score, license, license_url, credit))"
)

# ------------------------------------------------------------------ observations


def _slot() -> Column:
    return F.col("user_id") * 16 + F.dayofmonth("ts") % 16


def v4_of(slot: Column) -> Column:
    return F.lit(16777216) + (slot * 65537) % F.lit(3623878656)


def _hex(n: Column) -> Column:
    return F.lower(F.hex(n))


def raw_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the entry text they report: six tenths IPv4 addresses, the rest IPv4 networks,
    IPv6 addresses and IPv6 networks."""
    e = table(spark, sf, "events").withColumn("slot", _slot())
    shape = F.col("user_id") % 10
    v4 = A.v4_text(v4_of(F.col("slot")))
    head = F.concat(
        F.lit("2a00:"),
        _hex(F.floor(F.col("slot") / 4096).cast("bigint") + 1),
        F.lit(":"),
        _hex(F.lit(4096) + F.col("slot") % 4096),
        F.lit("::"),
    )
    entry = (
        F.when(shape <= 5, v4)
        .when(shape == 6, F.concat(v4, F.lit("/24")))
        .when(shape == 7, F.concat(v4, F.lit("/20")))
        .when(shape == 8, F.concat(head, F.lit("1")))
        .otherwise(F.concat(head, F.when(F.col("user_id") % 20 == 9, "/48").otherwise("/40")))
    )
    source = (
        F.when((F.col("event_type") == "view") & (F.col("event_id") % 5 == 0), "exits")
        .when((F.col("event_type") == "click") & (F.col("event_id") % 4 == 0), "frozen")
        .when((F.col("event_type") == "signup") & (F.col("event_id") % 6 == 0), "blocks")
        .otherwise(F.col("event_type"))
    )
    return e.withColumns({"entry": entry, "source": source})


RAW = """raw AS (
  SELECT *, CASE WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'exits'
                 WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'frozen'
                 WHEN event_type = 'signup' AND event_id % 6 = 0 THEN 'blocks'
                 ELSE event_type END AS source
  FROM (SELECT *, user_id * 16 + day(ts) % 16 AS slot FROM events)
)"""

V4_OF = "(16777216 + ({slot} * 65537) % 3623878656)"


def v4_text_sql(n: str) -> str:
    return (
        f"concat(({n}) // 16777216, '.', (({n}) // 65536) % 256, '.', "
        f"(({n}) // 256) % 256, '.', ({n}) % 256)"
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """All events as observations."""
    rows = A.with_address(raw_entries(spark, sf), "entry", "entry")
    day = F.date_trunc("day", "ts")
    none = F.array().cast("array<string>")
    tags = (
        F.when(F.col("source") == "exits", F.array(F.lit("tor-exit")))
        .when(
            F.col("source") == "click",
            F.array(F.concat(F.lit("ipsum-level-"), (F.col("event_id") % 8).cast("string"))),
        )
        .when((F.col("source") == "purchase") & (F.col("value") < 120), F.array(F.lit("compromised-host")))
        .otherwise(none)
    )
    categories = F.create_map(
        *[x for r in _SOURCES for x in (F.lit(r[0]), F.array(*[F.lit(c) for c in r[6]]))]
    )
    listed = F.col("source").isin("blocks", "signup")
    return rows.select(
        *A.ADDRESS_COLUMNS,
        "source",
        day.alias("first_seen"),
        day.alias("last_seen"),
        F.when(
            (F.col("source") == "error") & (F.col("value") > 60),
            F.array(F.lit("spam-source"), F.lit("odd")),
        )
        .otherwise(F.try_element_at(categories, F.col("source")))
        .alias("categories"),
        tags.alias("tags"),
        F.when(F.col("event_id") % 3 == 0, F.to_date("ts")).alias("source_last_reported"),
        F.lit(False).alias("carried"),
        ((F.col("source") == "click") & (F.col("event_id") % 7 == 0)).alias("evidence_stale"),
        F.when(listed, F.concat(F.lit("SBL"), F.lpad(F.col("event_id").cast("string"), 9, "0"))).alias(
            "source_reference"
        ),
        F.when(listed, F.concat(F.lit("rir"), (F.col("event_id") % 3).cast("string"))).alias(
            "source_registry"
        ),
        "event_id",
        "value",
    )


def fresh_observations(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).filter(F.col("last_seen") >= F.lit(CUT).cast("timestamp"))


def prior_observations(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).filter(F.col("last_seen") < F.lit(CUT).cast("timestamp"))


def _obs_sql() -> str:
    n = "n"
    cats = " ".join(
        f"WHEN '{r[0]}' THEN {_sql_value(r[6])}" for r in _SOURCES
    )
    head = "concat('2a00:', printf('%x', slot // 4096 + 1), ':', printf('%x', g3), '::')"
    base6 = "(CAST(10752 AS HUGEINT) * H112 + CAST(slot // 4096 + 1 AS HUGEINT) * H96 + CAST(g3 AS HUGEINT) * H80)"
    h = {k: f"CAST('{2**k}' AS HUGEINT)" for k in (80, 88, 96, 112)}
    base6 = base6.replace("H112", h[112]).replace("H96", h[96]).replace("H80", h[80])
    return f"""obs0 AS (
  SELECT *, user_id % 10 AS shape, {V4_OF.format(slot='slot')} AS n0,
    CASE WHEN user_id % 10 = 9 AND user_id % 20 <> 9 THEN (4096 + slot % 4096) // 256 * 256
         ELSE 4096 + slot % 4096 END AS g3
  FROM raw),
obs1 AS (
  SELECT *, CASE WHEN shape <= 5 THEN NULL WHEN shape = 6 THEN 24 WHEN shape = 7 THEN 20 WHEN shape = 8 THEN NULL
              WHEN user_id % 20 = 9 THEN 48 ELSE 40 END AS prefix,
    CASE WHEN shape = 6 THEN n0 // 256 * 256 WHEN shape = 7 THEN n0 // 4096 * 4096 ELSE n0 END AS {n}
  FROM obs0),
obs AS (
  SELECT
    CASE WHEN shape <= 5 THEN {v4_text_sql(n)} WHEN shape <= 7 THEN concat({v4_text_sql(n)}, '/', prefix)
         WHEN shape = 8 THEN concat({head}, '1') ELSE concat({head}, '/', prefix) END AS indicator,
    CASE WHEN shape <= 7 THEN 4 ELSE 6 END AS family, prefix IS NOT NULL AS is_net, prefix,
    CASE WHEN shape <= 7 THEN CAST(n AS HUGEINT) WHEN shape = 8 THEN {base6} + 1 ELSE {base6} END AS lo,
    CASE WHEN shape <= 5 THEN CAST(n AS HUGEINT) WHEN shape = 6 THEN CAST(n + 255 AS HUGEINT) WHEN shape = 7 THEN CAST(n + 4095 AS HUGEINT)
         WHEN shape = 8 THEN {base6} + 1 WHEN prefix = 48 THEN {base6} + {h[80]} - 1 ELSE {base6} + {h[88]} - 1 END AS hi,
    source, date_trunc('day', ts) AS first_seen, date_trunc('day', ts) AS last_seen,
    CASE WHEN source = 'error' AND value > 60 THEN ['spam-source', 'odd'] ELSE CASE source {cats} END END AS categories,
    CASE WHEN source = 'exits' THEN ['tor-exit'] WHEN source = 'click' THEN [concat('ipsum-level-', event_id % 8)]
         WHEN source = 'purchase' AND value < 120 THEN ['compromised-host'] ELSE CAST([] AS VARCHAR[]) END AS tags,
    CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) END AS source_last_reported,
    FALSE AS carried, source = 'click' AND event_id % 7 = 0 AS evidence_stale,
    CASE WHEN source IN ('blocks', 'signup') THEN concat('SBL', lpad(CAST(event_id AS VARCHAR), 9, '0')) END AS source_reference,
    CASE WHEN source IN ('blocks', 'signup') THEN concat('rir', event_id % 3) END AS source_registry,
    event_id, value
  FROM obs1)"""


OBS = RAW + ",\n" + _obs_sql()
FRESH = f"fresh AS (SELECT * FROM obs WHERE last_seen >= TIMESTAMP '{CUT}')"
PRIOR = f"prior AS (SELECT * FROM obs WHERE last_seen < TIMESTAMP '{CUT}')"


def scored_sql(
    obs: str = "obs", as_of: str = AS_OF, out: str = "scored", keys: str = "", extra_filter: str = "TRUE"
) -> str:
    """Common table expressions ending in ``out``: one row per (keys, tier, indicator)."""
    p = out
    k = "".join(f"{c}, " for c in keys.split(",") if c)
    jk = "".join(f" AND a.{c.strip()} = r.{c.strip()}" for c in keys.split(",") if c)
    return f"""{p}_j AS (
  SELECT o.* EXCLUDE (categories), o.categories, s.ord, s.independence_class, s.vote, s.redistribute, s.redistribute_noncommercial,
    s.explicit_grant, s.noncommercial_compatible, s.tag_only,
    NOT o.evidence_stale AND NOT s.dormant AS vouched,
    s.weight
      * CASE WHEN s.ttl_days <= 0 THEN 1.0 ELSE greatest(0.2, 1.0 - greatest(0.0, epoch(TIMESTAMP '{as_of}' - o.last_seen) / 86400.0) / s.ttl_days) END
      * list_max(list_transform(CASE WHEN len(o.categories) = 0 THEN [''] ELSE o.categories END, lambda c: CASE
          WHEN c IN ('botnet-c2', 'malware-infrastructure', 'hijacked-netblock', 'criminal-hosting') THEN 1.0
          WHEN c = 'malicious-tls' THEN 0.9 WHEN c = 'web-attack' THEN 0.8
          WHEN c IN ('brute-force', 'ssh-attack', 'reported-abuse') THEN 0.7
          WHEN c IN ('spam-source', 'abuse') THEN 0.5 ELSE 0.6 END))::DOUBLE
      * CASE WHEN o.evidence_stale OR s.dormant THEN 0.2 ELSE 1.0 END AS contribution,
    s.vote AND NOT o.carried AND NOT o.evidence_stale AND NOT s.dormant AND s.redistribute
      AND (o.source = 'blocks' OR (s.independence_class = 'abusech' AND NOT list_contains(o.tags, 'compromised-host'))) AS promotes,
    coalesce(list_max(list_transform(o.tags, lambda t: CASE WHEN t LIKE 'ipsum-level-%' THEN CAST(regexp_extract(t, '(\\d+)$', 1) AS INTEGER) ELSE 0 END)), 0) AS lvl
  FROM {obs} o JOIN src s ON o.source = s.name WHERE {extra_filter}),
{p}_t AS (
  SELECT j.*, tier, CASE tier WHEN 'primary' THEN redistribute
      WHEN 'noncommercial' THEN (redistribute OR redistribute_noncommercial) AND noncommercial_compatible
      ELSE redistribute AND explicit_grant END AS mine
  FROM {p}_j j CROSS JOIN (VALUES ('primary'), ('noncommercial'), ('permissive')) tiers(tier)),
{p}_c AS (
  SELECT {k}tier, indicator, independence_class, max(contribution) AS best, bool_or(mine AND vouched) AS is_open
  FROM {p}_t WHERE vote GROUP BY ALL),
{p}_a AS (
  SELECT {k}tier, indicator, sum(best) AS raw, count(*) FILTER (is_open) AS n_open, count(*) FILTER (NOT is_open) AS n_restricted,
    list_sort(coalesce(list(independence_class) FILTER (is_open), [])) AS classes
  FROM {p}_c GROUP BY ALL),
{p}_r AS (
  SELECT {k}tier, indicator, family, is_net, prefix, lo, hi,
    coalesce(min(first_seen) FILTER (mine), min(first_seen)) AS first_seen,
    coalesce(max(last_seen) FILTER (mine), max(last_seen)) AS last_seen,
    list_sort(coalesce(list(DISTINCT source) FILTER (mine), [])) AS sources,
    list_sort(list_distinct(flatten(coalesce(list(categories) FILTER (mine), [])))) AS categories,
    list_sort(list_distinct(flatten(coalesce(list(tags) FILTER (mine), [])))) AS tags,
    max(lvl) AS lvl, arg_max(source, ord) FILTER (promotes) AS promoted_by,
    split_part(min(concat(source, '!', source_reference)) FILTER (mine AND source_reference IS NOT NULL), '!', 2) AS source_reference,
    split_part(min(concat(source, '!', source_registry)) FILTER (mine AND source_registry IS NOT NULL), '!', 2) AS source_registry,
    coalesce(bool_and(tag_only) FILTER (mine), TRUE) AS only_tagging
  FROM {p}_t GROUP BY ALL),
{p}_s AS (
  SELECT r.*, coalesce(a.classes, []) AS classes, coalesce(a.n_open, 0) AS n_open, coalesce(a.n_restricted, 0) AS restricted,
    100.0 * (1.0 - exp(-(coalesce(a.raw, 0.0) + CASE WHEN lvl >= 5 THEN 0.15 ELSE 0.0 END))) AS s0
  FROM {p}_r r LEFT JOIN {p}_a a ON a.tier = r.tier AND a.indicator = r.indicator{jk}),
{p}_b AS (
  SELECT *, CASE WHEN promoted_by IS NOT NULL THEN greatest(s0, 90.0) ELSE s0 END AS s1,
    CASE WHEN promoted_by IS NOT NULL OR n_open >= 3 OR (n_open >= 2 AND n_open + restricted >= 3) THEN 'high'
         WHEN n_open >= 2 THEN 'medium' ELSE 'withheld' END AS b1,
    list_contains(tags, 'tor-exit') AS is_exit
  FROM {p}_s),
{out} AS (
  SELECT * EXCLUDE (s0, s1, b1, is_exit, lvl, n_open),
    round(CASE WHEN is_exit AND b1 = 'high' THEN least(s1, 89.9) ELSE s1 END, 2) AS score,
    CASE WHEN is_exit AND b1 = 'high' THEN 'medium' ELSE b1 END AS band
  FROM {p}_b)"""


# ------------------------------------------------------------------ allowlist, ranges, labels


def allow_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as allowlist lines: IPv4 networks of many widths, every fifth one IPv6."""
    n = table(spark, sf, "nation")
    key = F.col("n_nationkey").cast("bigint")
    v4 = F.concat(
        A.v4_text(v4_of(key * 97 + 1)), F.lit("/"), (F.lit(14) + key * 7 % 18).cast("string")
    )
    v6 = F.concat(F.lit("2a00:1:"), _hex(F.lit(4096) + key * 150 % 4096), F.lit("::/44"))
    return n.select(
        F.concat(F.lit("region"), F.col("n_regionkey")).alias("allow_source"),
        F.concat(F.when(key % 5 == 4, v6).otherwise(v4), F.lit("  # "), F.col("n_name")).alias("line"),
    )


ALLOW = f"""allow AS (
  SELECT concat('region', n_regionkey) AS allow_source, family, prefix, lo, lo + size - 1 AS hi, text FROM (
    SELECT *, CASE WHEN family = 4 THEN n // size * size ELSE n // size * size END AS lo,
      CASE WHEN family = 4 THEN concat({v4_text_sql('n // size * size')}, '/', prefix)
           ELSE concat('2a00:1:', printf('%x', (4096 + n_nationkey * 150 % 4096) // 16 * 16), '::/44') END AS text
    FROM (
      SELECT *, CASE WHEN family = 4 THEN CAST(1 AS HUGEINT) << (32 - prefix) ELSE CAST(1 AS HUGEINT) << 84 END AS size
      FROM (
        SELECT n_nationkey, n_regionkey, CASE WHEN n_nationkey % 5 = 4 THEN 6 ELSE 4 END AS family,
          CASE WHEN n_nationkey % 5 = 4 THEN 44 ELSE 14 + n_nationkey * 7 % 18 END AS prefix,
          CASE WHEN n_nationkey % 5 = 4
            THEN CAST(10752 AS HUGEINT) * CAST('{2**112}' AS HUGEINT) + CAST('{2**96}' AS HUGEINT)
                 + CAST(4096 + n_nationkey * 150 % 4096 AS HUGEINT) * CAST('{2**80}' AS HUGEINT)
            ELSE CAST({V4_OF.format(slot='(CAST(n_nationkey AS BIGINT) * 97 + 1)')} AS HUGEINT) END AS n
        FROM nation))))"""


def allowed(spark: SparkSession, sf: str) -> DataFrame:
    from quorumlens.sources.reference_tables import allow_text

    return allow_text(allow_lines(spark, sf))


def range_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as tab-separated range rows with gaps; a few ASNs hold a single range.

    Ranges of 512 addresses lie in layers, so that seven million customers have ranges of their own.
    """
    key = F.col("c_custkey")
    c = table(spark, sf, "customer").withColumn(
        "lo", F.lit(16777216) + key % 27648 * 131072 + F.floor(key / 27648) * 512
    )
    asn = F.when(F.col("c_custkey") % 97 == 0, F.col("c_custkey") + 50000).otherwise(
        F.col("c_nationkey").cast("bigint") + 1000
    )
    country = F.when(F.col("c_nationkey") == 7, "").otherwise(
        F.concat(F.char(F.col("c_nationkey") + 65), F.lit("X"))
    )
    return c.select(
        F.concat_ws(
            "\t",
            F.col("lo").cast("string"),
            (F.col("lo") + 511 - F.col("c_custkey") % 3 * 80).cast("string"),
            asn.cast("string"),
            country,
            F.concat(F.lit("NET "), F.col("c_mktsegment")),
        ).alias("line")
    )


def ranges(spark: SparkSession, sf: str) -> DataFrame:
    from quorumlens.sources.reference_tables import range_table

    return range_table(range_lines(spark, sf))


RANGES = """ranges AS (
  SELECT lo, lo + 511 - c_custkey % 3 * 80 AS hi,
    CASE WHEN c_custkey % 97 = 0 THEN c_custkey + 50000 ELSE c_nationkey + 1000 END AS asn,
    CASE WHEN c_nationkey = 7 THEN '??' ELSE concat(chr(c_nationkey + 65), 'X') END AS country,
    concat('NET ', c_mktsegment) AS name
  FROM (SELECT *, 16777216 + c_custkey % 27648 * 131072 + c_custkey // 27648 * 512 AS lo FROM customer))"""


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Document labels as classifications of addresses."""
    d = table(spark, sf, "labels")
    label = (
        F.when(F.col("toxic") == 1, "malicious").when(F.col("quality") == 1, "benign").otherwise("suspicious")
    )
    return d.select(A.v4_text(v4_of(F.col("doc_id") * 2 + 1)).alias("address"), label.alias("label"))


LABELS = f"""lab AS (
  SELECT {v4_text_sql(V4_OF.format(slot='(doc_id * 2 + 1)'))} AS address,
    CASE WHEN toxic = 1 THEN 'malicious' WHEN quality = 1 THEN 'benign' ELSE 'suspicious' END AS label
  FROM labels)"""


def with_sql(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


# Judged rows in SQL: allowlist overlap both ways, first failing rule.
JUDGED = """hit AS (
  SELECT DISTINCT o.indicator FROM (SELECT DISTINCT indicator, family, lo, hi FROM {scored}) o
  JOIN allow a ON a.family = o.family AND a.lo <= o.hi AND a.hi >= o.lo),
judged AS (
  SELECT s.*, h.indicator IS NOT NULL AS allowlisted, CASE
    WHEN family = 4 AND (hi <= 16777215 OR (lo >= 167772160 AND hi <= 184549375) OR (lo >= 2130706432 AND hi <= 2147483647)
      OR (lo >= 2851995648 AND hi <= 2852061183) OR (lo >= 2886729728 AND hi <= 2887778303) OR (lo >= 3221225472 AND hi <= 3221225727)
      OR (lo >= 3221225984 AND hi <= 3221226239) OR (lo >= 3232235520 AND hi <= 3232301055) OR (lo >= 3323068416 AND hi <= 3323199487)
      OR (lo >= 3325256704 AND hi <= 3325256959) OR (lo >= 3405803776 AND hi <= 3405804031) OR lo >= 3758096384) THEN 'non_global'
    WHEN is_net AND prefix < (CASE WHEN family = 4 THEN 22 ELSE 48 END) AND NOT list_contains(sources, 'blocks') THEN 'too_wide'
    WHEN h.indicator IS NOT NULL THEN 'allowlisted'
    WHEN len(sources) = 0 THEN 'not_redistributable'
    WHEN only_tagging THEN 'tag_only' END AS drop_reason
  FROM {scored} s LEFT JOIN hit h USING (indicator))"""
