"""Statistics over address space and networks.  No output names an indicator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.functions import measures as M
from quorumlens.functions import scoring as S
from quorumlens.operators.ordered import as_of


def _counted_entries(observations: DataFrame, *extra: str) -> DataFrame:
    """One row per distinct entry (and extra columns) with its number of observations."""
    return observations.groupBy(*A.ADDRESS_COLUMNS, *extra).agg(F.count("*").alias("n"))


def enrich(entries: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add asn, country and network name of the first address; 0 / ?? where unknown or IPv6.

    The range with the greatest start at or before the address answers, if it reaches the address.
    """
    return as_of(entries, ranges, ["asn", "country", "name"], "_net").select(
        *entries.columns,
        F.coalesce("_net.asn", F.lit(0).cast("bigint")).alias("asn"),
        F.coalesce("_net.country", F.lit(K.UNKNOWN_COUNTRY)).alias("country"),
        F.coalesce("_net.name", F.lit(K.UNKNOWN_NETWORK)).alias("name"),
    )


def network_names(ranges: DataFrame) -> DataFrame:
    """Label of an ASN: the name in its first range."""
    return ranges.groupBy("asn").agg(F.min_by("name", "lo").alias("name"))


def announced_sizes(ranges: DataFrame) -> DataFrame:
    """Addresses announced per ASN over all its ranges."""
    return ranges.groupBy("asn").agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("announced"))


def enriched_observations(observations: DataFrame, ranges: DataFrame) -> DataFrame:
    """Observations folded to (entry, source, count) and enriched."""
    return enrich(_counted_entries(observations, "source"), ranges)


def network_rollup(enriched: DataFrame, ranges: DataFrame) -> DataFrame:
    """Weighted addresses and distinct sources per ASN."""
    weight = A.network_weight() * F.col("n")
    per_source = (
        enriched.filter("family = 4 and asn <> 0")
        .groupBy("asn", "source")
        .agg(F.sum(weight).alias("_w"))
    )
    rolled = per_source.groupBy("asn").agg(
        F.sum("_w").alias("addresses"), F.count("source").alias("sources_reporting")
    )
    return rolled.join(network_names(ranges), "asn", "left").select(
        "asn", "name", "addresses", "sources_reporting"
    )


def top_networks(rollup: DataFrame, limit: int = K.TOP_NETWORKS) -> DataFrame:
    return (
        rollup.filter(F.col("addresses") >= K.MIN_CELL)
        .orderBy(F.desc("addresses"), "asn")
        .limit(limit)
    )


def suppressed_networks(rollup: DataFrame, enriched: DataFrame) -> DataFrame:
    """Disclosure totals: ASNs and countries below the minimum cell, addresses folded away."""
    small = F.col("addresses") < K.MIN_CELL
    asns = rollup.agg(
        F.count("*").alias("distinct_asns"),
        F.count_if(small).alias("asns_below_threshold"),
        F.coalesce(F.sum(F.when(small, F.col("addresses"))), F.lit(0)).alias(
            "addresses_in_suppressed_asns"
        ),
    )
    return asns.withColumn("countries_below_threshold", small_countries(enriched).scalar())


def small_countries(enriched: DataFrame) -> DataFrame:
    """Number of countries below the minimum cell; no country is ever named."""
    weight = A.network_weight() * F.col("n")
    return (
        enriched.filter("family = 4 and asn <> 0")
        .groupBy("country")
        .agg(F.sum(weight).alias("addresses"))
        .agg(F.count_if(F.col("addresses") < K.MIN_CELL).alias("countries_below_threshold"))
    )


def unenriched(enriched: DataFrame) -> DataFrame:
    """Observations without a network: those the table does not know, and IPv6."""
    n = F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    no_asn = total((F.col("family") == 4) & (F.col("asn") == 0))
    ipv6 = total(F.col("family") == 6)
    return enriched.agg(
        no_asn.alias("unenriched_no_asn"),
        ipv6.alias("unenriched_ipv6"),
        (no_asn + ipv6).alias("unenriched_observations"),
    )


# ------------------------------------------------------------------ address-space density


def spectrum(observations: DataFrame) -> DataFrame:
    """Observations per equal slice of IPv4 space, empty slices included."""
    spark = observations.sparkSession
    hits = (
        observations.filter("family = 4")
        .groupBy("lo", "hi")
        .agg(F.count("*").alias("n"))
        .select(F.explode(A.spectrum_buckets()).alias("bucket"), "n")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    slots = spark.range(K.SPECTRUM_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return slots.join(hits, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0)).alias("observations")
    )


def spectrum_summary(buckets: DataFrame) -> DataFrame:
    return buckets.agg(
        F.count_if(F.col("observations") > 0).alias("occupied_buckets"),
        F.count_if(F.col("observations") == 0).alias("empty_buckets"),
        F.max("observations").alias("peak"),
    )


def grid(buckets: DataFrame) -> DataFrame:
    """One cell per /8 with its logarithmic shade."""
    cells = buckets.groupBy((F.col("bucket") / 2).cast("int").alias("octet")).agg(
        F.sum("observations").alias("observations")
    )
    peak = cells.agg(F.max("observations").alias("peak")).scalar()
    return cells.withColumn("_peak", peak).select(
        "octet",
        "observations",
        F.round(M.log_shade(F.col("observations"), F.col("_peak")), 3).alias("shade"),
        (F.col("octet") >= 224).alias("reserved"),
    )


def grid_summary(cells: DataFrame) -> DataFrame:
    """Occupied /8s and the busiest one (the lowest among equals)."""
    best = F.max(F.struct("observations", (-F.col("octet")).alias("neg")))
    return cells.agg(
        F.count_if(F.col("observations") > 0).alias("occupied"),
        (-best.getField("neg")).alias("busiest"),
        best.getField("observations").alias("busiest_observations"),
    )


# ------------------------------------------------------------------ network history


def daily_networks(observations: DataFrame, ranges: DataFrame, as_of) -> DataFrame:
    """Distinct IPv4 entries per (day, asn); the day is the upstream's where it gives one."""
    day = F.coalesce(F.col("source_last_reported"), F.to_date(S.moment(as_of)))
    entries = (
        observations.filter("family = 4")
        .select(*A.ADDRESS_COLUMNS, day.alias("day"))
        .distinct()
    )
    return (
        enrich(entries, ranges)
        .filter("asn <> 0")
        .groupBy("day", "asn")
        .agg(F.count("*").alias("addresses"))
    )


def merge_history(history: DataFrame | None, today: DataFrame, as_of) -> DataFrame:
    """Fold a run into the history with the maximum per (day, asn), keep 90 days."""
    rows = today if history is None else history.unionByName(today)
    oldest = F.date_sub(F.to_date(S.moment(as_of)), K.HISTORY_DAYS)
    return (
        rows.filter(F.col("day") >= oldest)
        .groupBy("day", "asn")
        .agg(F.max("addresses").alias("addresses"))
    )


def history_span(history: DataFrame, as_of) -> DataFrame:
    """Days recorded, calendar span, and whether each window is complete."""
    span = F.datediff(F.to_date(S.moment(as_of)), F.min("day")) + 1
    return history.agg(
        F.count_distinct("day").alias("days_recorded"),
        span.alias("span_days"),
        F.min("day").alias("oldest"),
        F.max("day").alias("newest"),
        *[(span >= n).alias(f"last_{n}_complete") for n in K.WINDOW_DAYS],
    )


def window_totals(history: DataFrame, as_of) -> DataFrame:
    """Per window and ASN: address-days, active days, peak day; small cells left out."""
    day = F.to_date(S.moment(as_of))
    windows = F.array_compact(
        F.array(
            F.lit("all_time"),
            *[
                F.when(F.col("day") >= F.date_sub(day, n - 1), F.lit(f"last_{n}_days"))
                for n in K.WINDOW_DAYS
            ],
        )
    )
    return (
        history.select(F.explode(windows).alias("window"), "asn", "addresses")
        .groupBy("window", "asn")
        .agg(
            F.sum("addresses").alias("address_days"),
            F.count("*").alias("days_active"),
            F.max("addresses").alias("peak_day"),
        )
        .filter(F.col("address_days") >= K.MIN_CELL)
    )


def persistence(
    history: DataFrame, ranges: DataFrame, as_of, limit: int = K.TOP_PER_WINDOW
) -> DataFrame:
    """Most persistent networks per window: active days first, then volume."""
    order = Window.partitionBy("window").orderBy(
        F.desc("days_active"), F.desc("address_days"), "asn"
    )
    ranked = (
        window_totals(history, as_of)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
    )
    return (
        ranked.join(network_names(ranges), "asn", "left")
        .join(announced_sizes(ranges), "asn", "left")
        .select(
            "window",
            "rank",
            "asn",
            F.coalesce("name", F.lit("unknown")).alias("name"),
            "address_days",
            "days_active",
            "peak_day",
            F.coalesce("announced", F.lit(0)).alias("announced"),
            M.per_million(F.col("address_days"), F.coalesce("announced", F.lit(0))).alias(
                "per_million"
            ),
        )
    )
