"""The source registry as a dimension table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import constants as K

REGISTRY_SCHEMA = (
    "name string, ord int, parser string, url string, independence_class string, weight double, "
    "categories array<string>, ttl_days int, enabled boolean, vote boolean, redistribute boolean, "
    "redistribute_noncommercial boolean, explicit_grant boolean, "
    "noncommercial_compatible boolean, dormant boolean, tag_only boolean, levels array<int>, "
    "min_score int, license string, license_url string, credit string"
)

# What a missing registry field means.
DEFAULTS = {
    "ttl_days": K.DEFAULT_TTL_DAYS,
    "enabled": True,
    "vote": True,
    "redistribute": True,
    "redistribute_noncommercial": False,
    "explicit_grant": False,
    "noncommercial_compatible": True,
    "dormant": False,
    "tag_only": False,
}

TIERS = ("primary", "noncommercial", "permissive")

BROADCAST_ROWS = 10_000
"""Registries up to this many rows are broadcast; larger ones take an ordinary join."""


def dimension(table: DataFrame, *columns, within: DataFrame | None = None) -> DataFrame:
    """``columns`` of a small table for a join that must not move the observations.

    The table's size is checked (one limited count, remembered on the object).  Beyond the bound the
    join is left to Spark, which shuffles and splits skewed sources at run time.  ``within`` is a stored table with at
    least as many rows: where ``table`` is computed, that one is counted, and nothing is computed twice.
    """
    counted = table if within is None else within
    small = getattr(counted, "_quorumlens_small", None)
    if small is None:
        small = counted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        counted._quorumlens_small = small
    picked = table.select(*columns)
    return F.broadcast(picked) if small else picked


def overlay_defaults(raw: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill missing registry fields; an explicit value always wins."""
    values = {**DEFAULTS, **(defaults or {})}
    return raw.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in raw.columns}
    )


def violations(registry: DataFrame, known_parsers: tuple[str, ...]) -> DataFrame:
    """Rows (name, problem): duplicate names, weights outside 0..1, unknown parsers, and voters
    without weight."""
    duplicated = (
        registry.groupBy("name")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("name", F.lit("duplicate name").alias("problem"))
    )
    checks = F.array_compact(
        F.array(
            F.when(~F.col("weight").between(0.0, 1.0), F.lit("weight out of range")),
            F.when(~F.col("parser").isin(*known_parsers), F.lit("unknown parser")),
            F.when(F.col("vote") & (F.col("weight") == 0.0), F.lit("votes without weight")),
        )
    )
    single = registry.select("name", F.explode(checks).alias("problem"))
    return duplicated.unionByName(single)


def in_tier(tier: str) -> Column:
    """Whether a source may be published in a licence tier."""
    free, nc = F.col("redistribute"), F.col("redistribute_noncommercial")
    if tier == "primary":
        return free
    if tier == "noncommercial":
        return (free | nc) & F.col("noncommercial_compatible")
    if tier == "permissive":
        return free & F.col("explicit_grant")
    raise ValueError(f"unknown tier: {tier}")


def tier_sources(registry: DataFrame, tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """(tier, source) membership."""
    named = F.array_compact(F.array(*[F.when(in_tier(t), F.lit(t)) for t in tiers]))
    return registry.select(F.explode(named).alias("tier"), F.col("name").alias("source"))


def selected_sources(registry: DataFrame, only: str | None = None) -> DataFrame:
    """Enabled sources, or the single enabled source asked for."""
    chosen = registry.filter("enabled")
    return chosen.filter(F.col("name") == only) if only else chosen


def expand_levels(registry: DataFrame) -> DataFrame:
    """One row per file of a source: levelled sources fan their URL template out."""
    return registry.select(
        "*", F.explode_outer("levels").alias("level")
    ).withColumn(
        "url",
        F.when(
            F.col("level").isNotNull(),
            F.replace(F.col("url"), F.lit("{level}"), F.col("level").cast("string")),
        ).otherwise(F.col("url")),
    )


def active_voting_classes(registry: DataFrame, need_weight: bool = True) -> DataFrame:
    """Distinct classes of enabled voting sources."""
    rows = registry.filter("enabled and vote")
    if need_weight:
        rows = rows.filter("weight > 0")
    return rows.select("independence_class").distinct()


def by_class(registry: DataFrame) -> DataFrame:
    """Registry grouped by class with its members and flags."""
    return registry.groupBy("independence_class").agg(
        F.count("*").alias("sources"),
        F.array_sort(F.collect_list("name")).alias("names"),
        F.count_if("enabled").alias("enabled"),
        F.count_if("vote").alias("voting"),
        F.count_if("redistribute").alias("redistributed"),
    )
