"""Address and text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorumlens.catalog import adapters as D
from quorumlens.catalog.registry import query
from quorumlens.functions import addresses as A
from quorumlens.functions import text as X
from quorumlens.operators.ordered import ranked

QUAD = r"[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+"
H = {k: f"CAST('{2**k}' AS HUGEINT)" for k in (12, 32, 40, 48, 80, 84, 96, 112, 116)}
DISTINCT = "ent AS (SELECT DISTINCT indicator, family, is_net, prefix, lo, hi FROM obs)"


def entries(spark, sf):
    return D.observations(spark, sf).select(*A.ADDRESS_COLUMNS).distinct()


def ent_sql(select: str, *more: str) -> str:
    return D.with_sql(D.OBS, DISTINCT, *more, select=select)


def found_quads(spark, sf):
    """Every dotted quad in the documents' texts, with the document."""
    docs = D.table(spark, sf, "documents")
    return docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(QUAD), 0)).alias("q"))


QUADS = f"""quads AS (SELECT doc_id, q, [CAST(x AS BIGINT) FOR x IN string_split(q, '.')] AS o
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{QUAD}')) AS q FROM documents)),
good AS (SELECT doc_id, q, o[1] * 16777216 + o[2] * 65536 + o[3] * 256 + o[4] AS num FROM quads
  WHERE list_max(o) <= 255 AND q NOT SIMILAR TO '.*(^|[.])0[0-9].*' AND q NOT SIMILAR TO '0[0-9].*')"""


@query(
    "fn01_v4_in_documents",
    D.with_sql(QUADS, select="SELECT doc_id, q, num FROM good"),
)
def fn01(spark, sf):
    """Dotted quads in running text as numbers; bad ones fall out."""
    return (
        found_quads(spark, sf).withColumn("num", A.v4_number("q")).filter("num is not null")
    )


@query(
    "fn02_v6_text_and_bytes",
    ent_sql(
        f"SELECT indicator, printf('%016x%016x', CAST(lo // CAST('{2**64}' AS HUGEINT) AS BIGINT), CAST(lo % CAST('{2**64}' AS HUGEINT) AS BIGINT)) AS bytes "
        "FROM ent WHERE family = 6"
    ),
)
def fn02(spark, sf):
    """IPv6 text to bytes and back to canonical text."""
    return entries(spark, sf).filter("family = 6").select(
        A.v6_text("lo6").alias("_t"), "indicator", "prefix", F.col("lo6").alias("bytes")
    ).select(
        F.concat("_t", F.when(F.col("prefix").isNotNull(), F.concat(F.lit("/"), F.col("prefix"))).otherwise("")).alias(
            "indicator"
        ),
        "bytes",
    )


@query(
    "fn03_networks_masked",
    ent_sql(
        "SELECT indicator, prefix::BIGINT AS prefix, CAST(lo AS VARCHAR) AS lo, CAST(hi AS VARCHAR) AS hi FROM ent WHERE is_net"
    ),
)
def fn03(spark, sf):
    """Networks with host bits cleared, both families."""
    four = F.col("family") == 4
    return entries(spark, sf).filter("is_net").select(
        "indicator",
        "prefix",
        F.when(four, F.col("lo").cast("string")).otherwise(A.v6_decimal_text(F.col("lo6"))).alias("lo"),
        F.when(four, F.col("hi").cast("string")).otherwise(A.v6_decimal_text(F.col("hi6"))).alias("hi"),
    )


def _order_ranges(spark, sf):
    """Orders as inclusive ranges of numbers."""
    a = (F.col("o_orderkey") * 7919 + 16777216) % F.lit(3758096384)
    return D.table(spark, sf, "orders").select(
        "o_orderkey", a.alias("a"), (a + F.col("o_custkey") * 37 % 5000).alias("b")
    )


@query(
    "fn04_range_cover",
    "SELECT o_orderkey, CAST(sum(size) AS BIGINT) AS covered FROM (SELECT o_orderkey, o_custkey * 37 % 5000 + 1 AS size FROM orders) GROUP BY 1",
)
def fn04(spark, sf):
    """Minimal network cover of ranges: the blocks add up to the range exactly (the cover itself is
    compared with the standard library in the tests)."""
    blocks = A.cover_v4_range(_order_ranges(spark, sf), "a", "b")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - F.col("block_prefix"))
    inside = (F.col("block_lo") >= F.col("a")) & (F.col("block_lo") + size - 1 <= F.col("b"))
    return blocks.groupBy("o_orderkey").agg(F.sum(F.when(inside, size)).alias("covered"))


@query(
    "fn04_cover_blocks",
    D.with_sql(
        "rng AS (SELECT o_orderkey, a, a + o_custkey * 37 % 5000 AS b FROM (SELECT *, (o_orderkey * 7919 + 16777216) % 3758096384 AS a FROM orders))",
        # Every aligned block inside the range, then those whose parent is not inside.
        "blk AS (SELECT o_orderkey, a, b, p, s, unnest(generate_series((a + s - 1) // s, (b + 1) // s - 1)) * s AS lo FROM (SELECT *, 1 << p AS s FROM rng, (SELECT unnest(generate_series(0, 13)) AS p)))",
        select="SELECT o_orderkey, lo AS block_lo, (32 - p)::BIGINT AS block_prefix FROM blk WHERE NOT (lo - lo % (2 * s) >= a AND lo - lo % (2 * s) + 2 * s - 1 <= b)",
    ),
)
def fn04_blocks(spark, sf):
    """The blocks of every range."""
    return A.cover_v4_range(_order_ranges(spark, sf), "a", "b").select(
        "o_orderkey", "block_lo", "block_prefix"
    )


@query(
    "fn05_address_family",
    D.with_sql(D.OBS, select="SELECT concat('v', family) AS address_family, count(*) AS n FROM obs GROUP BY ALL"),
)
def fn05(spark, sf):
    """v4 or v6."""
    return (
        D.observations(spark, sf).groupBy(A.address_family().alias("address_family")).agg(F.count("*").alias("n"))
    )


@query(
    "fn06_numeric_bounds",
    ent_sql("SELECT indicator, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM ent WHERE family = 4"),
)
def fn06(spark, sf):
    """Network and broadcast address as numbers."""
    return entries(spark, sf).filter("family = 4").select("indicator", "lo", "hi")


@query(
    "fn07_entry_as_network",
    ent_sql(
        "SELECT family::BIGINT AS family, coalesce(prefix, CASE WHEN family = 4 THEN 32 ELSE 128 END)::BIGINT AS prefix, count(*) AS n FROM ent GROUP BY ALL"
    ),
)
def fn07(spark, sf):
    """Entries by the prefix they have as networks."""
    return entries(spark, sf).groupBy("family", A.network_prefix().alias("prefix")).agg(F.count("*").alias("n"))


_SIZE = "(hi - lo + 1)"


@query(
    "fn08_entry_weight",
    ent_sql(
        f"SELECT indicator, CAST(CASE WHEN is_net THEN least({_SIZE}, 16777216) ELSE 1 END AS BIGINT) AS weight FROM ent"
    ),
)
def fn08(spark, sf):
    """Addresses covered, capped."""
    return entries(spark, sf).select("indicator", A.entry_weight().alias("weight"))


@query(
    "fn09_network_weight",
    ent_sql(
        f"SELECT indicator, CAST(CASE WHEN is_net THEN least({_SIZE}, 1024) ELSE 1 END AS BIGINT) AS weight FROM ent"
    ),
)
def fn09(spark, sf):
    """Addresses covered, capped for per-network rollups."""
    return entries(spark, sf).select("indicator", A.network_weight().alias("weight"))


@query(
    "fn10_subnets_64",
    ent_sql(
        f"SELECT indicator, CAST(CASE WHEN NOT is_net THEN 1 WHEN family = 4 THEN {_SIZE} ELSE greatest({_SIZE} // CAST('{2**64}' AS HUGEINT), 1) END AS VARCHAR) AS subnets FROM ent"
    ),
)
def fn10(spark, sf):
    """Scope in addresses or /64 subnets."""
    return entries(spark, sf).select("indicator", A.subnets_64().alias("subnets"))


@query(
    "fn11_sites_48",
    ent_sql(
        f"SELECT indicator, CAST(greatest({_SIZE} // {H[80]}, 1) AS BIGINT) AS sites FROM ent WHERE family = 6"
    ),
)
def fn11(spark, sf):
    """Scope in /48 sites."""
    return entries(spark, sf).filter("family = 6").select("indicator", A.sites_48().alias("sites"))


@query(
    "fn12_is_global",
    "SELECT o_orderkey, NOT ((n >> 24) IN (0, 10, 127) OR (n >> 24) >= 224 OR (n >> 16) IN (43518, 49320) OR (n >> 20) = 2753 "
    "OR ((n >> 8) = 12582912 AND (n & 255) NOT IN (9, 10)) OR (n >> 8) IN (12582914, 12989284, 13303921) OR (n >> 17) = 25353) AS is_global "
    "FROM (SELECT o_orderkey, (o_orderkey * 2654435761) % 4294967296 AS n FROM orders)",
)
def fn12(spark, sf):
    """Addresses spread over the whole IPv4 space, judged global or not."""
    n = (F.col("o_orderkey") * F.lit(2654435761)) % F.lit(1 << 32)
    rows = D.table(spark, sf, "orders").select("o_orderkey", A.v4_text(n).alias("t"))
    return A.with_address(rows, "t", "address").select("o_orderkey", A.is_global().alias("is_global"))


@query(
    "fn13_address_order",
    ent_sql(
        "SELECT indicator, row_number() OVER (PARTITION BY lo // CASE WHEN family = 4 THEN 16777216::HUGEINT ELSE "
        + H[96]
        + " END ORDER BY family, lo, coalesce(prefix, 128)) AS position FROM ent"
    ),
)
def fn13(spark, sf):
    """Position of each entry within its top block, by number and never by text."""
    block = F.when(F.col("family") == 4, F.shiftright("lo", 24)).otherwise(
        F.conv(F.hex(F.substring("lo6", 1, 4)), 16, 10).cast("bigint") + (1 << 32)
    )
    keys = entries(spark, sf).select("indicator", "family", "lo", "lo6", "prefix", block.alias("block"))
    return ranked(keys, "block", A.sort_key(), "position").select("indicator", "position")


@query(
    "fn14_unicast_block",
    ent_sql(
        f"SELECT concat(printf('%x', CAST(lo // {H[116]} AS BIGINT) * 16), '::/12') AS block, count(*) AS n FROM ent WHERE family = 6 GROUP BY ALL"
    ),
)
def fn14(spark, sf):
    """IPv6 entries per /12 of unicast space."""
    return (
        entries(spark, sf).filter("family = 6").groupBy(A.unicast_block().alias("block")).agg(F.count("*").alias("n"))
    )


@query(
    "fn15_allocation_key",
    ent_sql(
        f"SELECT family::BIGINT AS family, CAST(CASE WHEN family = 4 THEN lo // 65536 ELSE lo // {H[96]} END AS BIGINT) AS allocation, count(*) AS n FROM ent GROUP BY ALL"
    ),
)
def fn15(spark, sf):
    """Entries per IPv4 /16 or IPv6 /32."""
    return entries(spark, sf).groupBy("family", A.allocation_key().alias("allocation")).agg(F.count("*").alias("n"))


@query(
    "fn16_spectrum_buckets",
    ent_sql(
        "SELECT bucket, count(*) AS n FROM (SELECT unnest(generate_series(CAST(lo // 8388608 AS BIGINT), CAST(hi // 8388608 AS BIGINT))) AS bucket FROM ent WHERE family = 4) GROUP BY ALL"
    ),
)
def fn16(spark, sf):
    """Slices of IPv4 space an entry touches."""
    return (
        entries(spark, sf)
        .filter("family = 4")
        .select(F.explode(A.spectrum_buckets()).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
    )


# ------------------------------------------------------------------ text


@query(
    "fn24_reported_day",
    r"""SELECT doc_id, CAST(TRY_CAST(d AS DATE) AS VARCHAR) AS day FROM (
      SELECT doc_id, regexp_extract(concat(source, ' ', doc_id, ' # ', 2000 + doc_id % 30, '-', lpad(CAST(doc_id % 14 AS VARCHAR), 2, '0'), '-',
        lpad(CAST(doc_id % 33 AS VARCHAR), 2, '0'), ' 01:02:03 ', text), '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) AS d FROM documents)""",
)
def fn24(spark, sf):
    """First date in a comment; impossible days give none."""
    two = lambda c, n: F.lpad((F.col(c) % n).cast("string"), 2, "0")
    line = F.concat_ws(
        "",
        "source",
        F.lit(" "),
        "doc_id",
        F.lit(" # "),
        (F.lit(2000) + F.col("doc_id") % 30).cast("string"),
        F.lit("-"),
        two("doc_id", 14),
        F.lit("-"),
        two("doc_id", 33),
        F.lit(" 01:02:03 "),
        "text",
    )
    return D.table(spark, sf, "documents").select("doc_id", X.reported_day(line).alias("day"))


@query(
    "fn25_http_date",
    "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS modified FROM events",
)
def fn25(spark, sf):
    """Date header of every event's instant, written and read back."""
    header = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return D.table(spark, sf, "events").select("event_id", X.http_date(header).alias("modified"))


@query(
    "fn27_host_of",
    D.with_sql(
        D.OBS,
        select="SELECT event_id, indicator AS host FROM obs WHERE NOT is_net",
    ),
)
def fn27(spark, sf):
    """Host out of ip:port and [v6]:port."""
    port = (F.col("event_id") % 65536).cast("string")
    joined = F.when(F.col("family") == 4, F.concat("indicator", F.lit(":"), port)).otherwise(
        F.concat(F.lit("["), "indicator", F.lit("]:"), port)
    )
    return D.observations(spark, sf).filter("not is_net").select("event_id", X.host_of(joined).alias("host"))


@query(
    "fn28_tag_categories",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'brute-force|ssh-attack' WHEN 1 THEN 'web-attack' WHEN 2 THEN 'scanning|spam-source' ELSE '' END AS categories FROM orders",
)
def fn28(spark, sf):
    """Multi-valued tag fields to sorted categories."""
    k = F.col("o_orderkey") % 4
    raw = (
        F.when(k == 0, ' SSH,"telnet" ,ftp')
        .when(k == 1, "http,HTTPS\nunknown")
        .when(k == 2, "smtp, portscan,")
        .otherwise(F.lower(F.concat(F.lit("other-"), "o_orderpriority")))
    )
    return D.table(spark, sf, "orders").select(
        "o_orderkey", X.tag_categories(X.normalised_tags(raw)).alias("categories")
    )


@query(
    "fn32_record_uuid",
    ent_sql(
        "SELECT indicator, concat(h[1:8], '-', h[9:12], '-', h[13:16], '-', h[17:20], '-', h[21:32]) AS id FROM (SELECT indicator, sha256(indicator) AS h FROM ent)"
    ),
)
def fn32(spark, sf):
    """Deterministic record ids."""
    return entries(spark, sf).select("indicator", X.record_uuid(F.col("indicator")).alias("id"))


@query(
    "fn33_joined_lists",
    D.with_sql(
        D.OBS,
        select="SELECT indicator, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM obs GROUP BY 1",
    ),
)
def fn33(spark, sf):
    """List columns as one delimited text."""
    grouped = D.observations(spark, sf).groupBy("indicator").agg(
        F.sort_array(F.collect_set("source")).alias("s")
    )
    return grouped.select("indicator", X.joined(F.col("s")).alias("sources"))
