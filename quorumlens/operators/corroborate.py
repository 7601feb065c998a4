"""Independence-weighted corroboration.

Evidence is collapsed in two steps.  First per (indicator, source, labels): only fixed-width
aggregates, so it is a hash aggregation whose map side already folds a hot indicator or a hot source
down to a handful of rows.  Then per indicator: what is gathered there is bounded by the number of
sources in the registry, and every licence tier is computed from that one array, without another
scan or shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import constants as K
from quorumlens.functions import scoring as S
from quorumlens.functions.addresses import ADDRESS_COLUMNS
from quorumlens.sources.registry import TIERS, dimension, in_tier


@dataclass(frozen=True)
class Rules:
    """Names the scoring and safety rules refer to."""

    netblock_sources: tuple[str, ...] = field(default=K.NETBLOCK_SOURCES)
    promoting_class: str = K.PROMOTING_CLASS
    compromised_tag: str = K.COMPROMISED_TAG
    exit_tag: str = K.EXIT_TAG


OBSERVATION_DEFAULTS = {
    "tags": "array()",
    "categories": "array()",
    "carried": "false",
    "evidence_stale": "false",
    "source_reference": "cast(null as string)",
    "source_registry": "cast(null as string)",
    "source_last_reported": "cast(null as date)",
}


def complete(observations: DataFrame) -> DataFrame:
    """Add the optional observation columns that are missing."""
    missing = {
        c: F.expr(e) if not c in ("tags", "categories") else F.expr(e).cast("array<string>")
        for c, e in OBSERVATION_DEFAULTS.items()
        if c not in observations.columns
    }
    return observations.withColumns(missing) if missing else observations


def evidence(
    observations: DataFrame, sources: DataFrame, as_of, rules: Rules = Rules(), keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row per (indicator, source) with the strongest evidence found there.

    References are unique per listing, so they are folded here and never gathered; labels come from a fixed
    vocabulary.  What is left of a hot indicator is one row for each source that lists it.
    """
    now = S.moment(as_of)
    dim = dimension(
        sources,
        F.col("name").alias("source"),
        F.col("ttl_days").alias("_ttl"),
        F.col("dormant").alias("_dormant"),
        "ord",
        "independence_class",
        "weight",
        "vote",
        "redistribute",
        "tag_only",
        *[in_tier(t).alias(f"in_{t}") for t in TIERS],
    )
    ok = S.vouched(F.col("evidence_stale"), F.col("_dormant"))
    obs = complete(observations).join(dim, "source", "left").withColumn("_ok", ok)
    fresh = S.freshness(F.col("last_seen"), now, F.coalesce(F.col("_ttl"), F.lit(0)), F.col("_ok"))
    promotes = (
        F.col("vote")
        & F.col("_ok")
        & ~F.col("carried")
        & F.col("redistribute")
        & (
            F.col("source").isin(*rules.netblock_sources)
            | (
                (F.col("independence_class") == rules.promoting_class)
                & ~F.array_contains(F.col("tags"), rules.compromised_tag)
            )
        )
    )
    known = F.col("independence_class").isNotNull()

    def all_of(name: str) -> Column:
        return F.array_distinct(F.flatten(F.collect_set(name))).alias(name)

    return obs.groupBy(*keys, *ADDRESS_COLUMNS, "source").agg(
        F.max(F.when(F.col("vote"), F.col("weight") * fresh * S.severity(F.col("categories")))).alias("_vote"),
        F.max("_ok").alias("vouched"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max(F.when(known, S.prior_level(F.col("tags"))).otherwise(0)).alias("prior_level"),
        F.max(F.when(promotes, F.col("ord"))).alias("promotes"),
        F.min(F.nullif("source_reference", F.lit(""))).alias("reference"),
        F.min(F.nullif("source_registry", F.lit(""))).alias("registry"),
        all_of("categories"),
        all_of("tags"),
        *[F.any_value(c).alias(c) for c in ("independence_class", "tag_only", *(f"in_{t}" for t in TIERS))],
    )


def profiles(
    observations: DataFrame,
    sources: DataFrame,
    as_of,
    rules: Rules = Rules(),
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """One row per indicator holding one element for each of its sources (array ``rows``) and what no tier changes."""
    return profiles_of(evidence(observations, sources, as_of, rules, keys), keys)


def profiles_of(ev: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Profiles of ``evidence`` rows; several rows of one source say together what one would."""

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False)).alias(name)

    row = F.struct(
        "source",
        F.col("independence_class").alias("class"),
        F.col("_vote").alias("vote"),
        "vouched",
        flag("tag_only"),
        *[flag(f"in_{t}") for t in TIERS],
        "categories",
        "tags",
        "reference",
        "registry",
        "first_seen",
        "last_seen",
    )
    # Grouped by the indicator alone, which names its address: a later join by indicator needs no shuffle.
    grouped = ev.groupBy(*keys, "indicator").agg(
        *[F.any_value(c).alias(c) for c in ADDRESS_COLUMNS if c != "indicator"],
        F.collect_list(row).alias("rows"),
        F.max("prior_level").alias("prior_level"),
        F.max(F.when(F.col("promotes").isNotNull(), F.struct("promotes", "source")))
        .getField("source")
        .alias("promoted_by"),
    )
    voters = grouped.withColumn("voting", F.expr("filter(rows, r -> r.vote is not null)"))
    classed = voters.withColumn(
        "classes", F.expr("array_sort(array_distinct(transform(voting, r -> r.class)))")
    )
    # Best contribution per class, then the sum over classes in class order.
    raw = F.expr(
        "aggregate(classes, 0D, (total, c) -> total + "
        "array_max(transform(filter(voting, r -> r.class = c), r -> r.vote)))"
    )
    bonus = F.when(F.col("prior_level") >= K.PRIOR_LEVEL, K.PRIOR_BONUS).otherwise(0.0)
    return classed.withColumn("raw", raw + bonus)


def _tier_columns(tier: str) -> Column:
    mine = f"filter(rows, r -> r.in_{tier})"

    def labels(name: str) -> Column:
        return F.expr(f"array_sort(array_distinct(flatten(transform({mine}, r -> r.{name}))))")

    def cited(name: str) -> Column:
        pairs = f"transform(filter(rows, r -> r.in_{tier} and r.{name} is not null), "
        return F.expr(f"array_min({pairs} r -> struct(r.source, r.{name}))).{name}")

    return F.struct(
        F.lit(tier).alias("tier"),
        F.expr(
            "array_sort(array_distinct(transform("
            f"filter(voting, r -> r.in_{tier} and r.vouched), r -> r.class)))"
        ).alias("independence_classes"),
        F.expr(f"array_sort(array_distinct(transform({mine}, r -> r.source)))").alias("sources"),
        labels("categories").alias("categories"),
        labels("tags").alias("tags"),
        F.expr(
            f"coalesce(array_min(transform({mine}, r -> r.first_seen)), "
            "array_min(transform(rows, r -> r.first_seen)))"
        ).alias("first_seen"),
        F.expr(
            f"coalesce(array_max(transform({mine}, r -> r.last_seen)), "
            "array_max(transform(rows, r -> r.last_seen)))"
        ).alias("last_seen"),
        cited("reference").alias("source_reference"),
        cited("registry").alias("source_registry"),
        F.expr(f"forall({mine}, r -> r.tag_only)").alias("only_tagging"),
    )


def score(
    profile: DataFrame, tiers: tuple[str, ...] = TIERS, rules: Rules = Rules(), keys: tuple[str, ...] = ()
) -> DataFrame:
    """Band and score per (tier, indicator).  Columns added to the profiles on the way are kept."""
    inner = {"rows", "voting", "classes", "raw", "prior_level", "promoted_by"}
    extra = [c for c in profile.columns if c not in inner and c not in keys + ADDRESS_COLUMNS]
    tiered = profile.select(
        *keys,
        *ADDRESS_COLUMNS,
        *extra,
        "raw",
        "promoted_by",
        F.size("classes").alias("_n"),
        F.inline(F.array(*[_tier_columns(t) for t in tiers])),
    )
    n_open = F.size("independence_classes")
    tiered = tiered.withColumns(
        {
            "restricted_corroboration": F.col("_n") - n_open,
            "_promoted": F.col("promoted_by").isNotNull(),
            "_exit": F.array_contains(F.col("tags"), rules.exit_tag),
        }
    )
    base = S.saturate(F.col("raw"))
    lifted = F.when(F.col("_promoted"), F.greatest(base, F.lit(K.HIGH_SCORE_FLOOR))).otherwise(base)
    first = F.when(F.col("_promoted"), F.lit("high")).otherwise(
        S.band(n_open, F.col("restricted_corroboration"))
    )
    tiered = tiered.withColumns({"_score": lifted, "_band": first})
    capped = F.col("_exit") & (F.col("_band") == "high")
    return tiered.select(
        *keys,
        "tier",
        *ADDRESS_COLUMNS,
        F.round(
            F.when(capped, F.least(F.col("_score"), F.lit(K.HIGH_SCORE_FLOOR - 0.1))).otherwise(
                F.col("_score")
            ),
            2,
        ).alias("score"),
        F.when(capped, "medium").otherwise(F.col("_band")).alias("band"),
        "independence_classes",
        "sources",
        "categories",
        "tags",
        "first_seen",
        "last_seen",
        "promoted_by",
        "restricted_corroboration",
        "source_reference",
        "source_registry",
        "only_tagging",
        *extra,
    )


def corroborate(
    observations: DataFrame,
    sources: DataFrame,
    as_of,
    tiers: tuple[str, ...] = TIERS,
    rules: Rules = Rules(),
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Observations to scored indicators; ``keys`` are extra grouping columns (scenarios)."""
    return score(profiles(observations, sources, as_of, rules, keys), tiers, rules, keys)


def corroborate_scenarios(
    observations: DataFrame,
    sources: DataFrame,
    as_of,
    scenarios: dict[str, str],
    tiers: tuple[str, ...] = TIERS,
    rules: Rules = Rules(),
) -> DataFrame:
    """Scored indicators of every scenario, a SQL predicate over observations (at most 62), with column ``scenario``.

    An observation carries the scenarios it belongs to as a bit mask, which is a key of the first aggregate; only what that
    leaves of an (indicator, source), one row for each mask that occurs there, is repeated per scenario.
    """
    if len(scenarios) > 62:
        raise ValueError("at most 62 scenarios")
    bits = [F.when(F.expr(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(scenarios.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    ev = evidence(observations.withColumn("mask", mask).filter("mask <> 0"), sources, as_of, rules, ("mask",))
    names = F.array_compact(
        F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(scenarios)])
    )
    each = ev.withColumn("scenario", F.explode(names)).drop("mask")
    return score(profiles_of(each, ("scenario",)), tiers, rules, ("scenario",))
