"""Run counters, provenance and what-if analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quorumlens.functions import measures as M
from quorumlens.sources.registry import TIERS, dimension, tier_sources


def run_counts(judged: DataFrame) -> DataFrame:
    """Per tier: scored, kept, published by band, withheld, promoted, capped.

    ``judged`` are scored rows with ``drop_reason`` and, after the benign cap, ``benign_capped``.
    """
    kept = F.col("drop_reason").isNull()
    shown = kept & (F.col("band") != "withheld")
    return judged.groupBy("tier").agg(
        F.count("*").alias("indicators"),
        F.count_if(shown).alias("published"),
        F.count_if(shown & (F.col("band") == "high")).alias("high"),
        F.count_if(shown & (F.col("band") == "medium")).alias("medium"),
        F.count_if(kept & (F.col("band") == "withheld")).alias("withheld"),
        F.count_if(shown & F.col("promoted_by").isNotNull()).alias("promoted"),
        F.count_if(shown & F.col("benign_capped")).alias("benign_capped"),
    )


def watched(observations: DataFrame) -> tuple[DataFrame, Observation]:
    """``observations`` that count themselves (collected, carried) while a job reads them, without a scan of their own.

    The counts are there once a job over the returned rows has ended: ``watch.get``.
    """
    watch = Observation()
    counted = observations.observe(
        watch,
        F.count_if(~F.col("carried")).alias("collected"),
        F.count_if("carried").alias("carried"),
    )
    return counted, watch


def corroboration_histogram(published: DataFrame) -> DataFrame:
    return published.groupBy("tier", F.size("independence_classes").alias("classes")).agg(
        F.count("*").alias("indicators")
    )


def provenance(published: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per (entry, source) with class, weight and flags of the source."""
    dim = dimension(
        sources, F.col("name").alias("source"), "independence_class", "weight", "vote", "redistribute"
    )
    return published.select(
        "tier", "indicator", "band", "score", F.explode("sources").alias("source")
    ).join(dim, "source", "left")


def contributing_sources(
    published: DataFrame, sources: DataFrame, tiers: tuple[str, ...] = TIERS
) -> DataFrame:
    """Sources behind each tier's list, split into contributing and scoring-only."""
    members = tier_sources(sources, tiers).withColumn("_member", F.lit(True))
    return (
        published.select("tier", F.explode("sources").alias("source"))
        .distinct()
        .join(members, ["tier", "source"], "left")
        .select(
            "tier",
            "source",
            F.when(F.col("_member"), "contributing").otherwise("scoring_only").alias("role"),
        )
    )


def attribution(contributing: DataFrame, sources: DataFrame, declared: DataFrame) -> DataFrame:
    """Credit and terms of every contributing source.

    Credit: curated line, else what the payload declares, else the licence.  ``declared`` holds
    (source, copyright, terms) harvested from payloads.
    """
    dim = sources.select(
        F.col("name").alias("source"),
        F.nullif("credit", F.lit("")).alias("_credit"),
        F.nullif("license", F.lit("")).alias("_license"),
        F.nullif("license_url", F.lit("")).alias("_url"),
    )
    return (
        contributing.filter("role = 'contributing'")
        .join(dim, "source")
        .join(declared, "source", "left")
        .select(
            "tier",
            "source",
            F.coalesce("_credit", "copyright", "_license").alias("credit"),
            F.coalesce("terms", "_url").alias("terms"),
            F.when(F.col("_credit").isNotNull(), F.coalesce("copyright", "_license")).alias("detail"),
        )
    )


def source_block(status: DataFrame, sources: DataFrame) -> DataFrame:
    """Source status joined with what the registry says about the source."""
    dim = sources.select(
        F.col("name").alias("source"),
        "independence_class",
        "weight",
        (F.col("vote") & F.col("enabled")).alias("votes"),
        F.col("redistribute").alias("redistributable"),
        "license",
        "license_url",
    )
    return (
        status.join(dim, "source", "left")
        .withColumn("votes", F.coalesce("votes", F.lit(False)))
        .withColumn("redistributable", F.coalesce("redistributable", F.lit(False)))
    )


def corpus_counts(observations: DataFrame, scored: DataFrame, sources: DataFrame) -> DataFrame:
    """Indicators observed, published (before filters), registered sources and voting classes."""
    dim = sources.select(
        F.col("name").alias("source"),
        F.when(F.col("vote"), F.col("independence_class")).alias("_class"),
    )
    seen = observations.select("indicator", "source").distinct()
    by_source = seen.groupBy("source").agg(F.count("*").alias("_n")).join(dim, "source")
    published = scored.filter("tier = 'primary' and band <> 'withheld'")
    return (
        by_source.agg(
            F.count("*").alias("sources_contributing"),
            F.count_distinct("_class").alias("independence_classes"),
        )
        .withColumn(
            "addresses_observed",
            observations.select("indicator").distinct().agg(F.count("*").alias("n")).scalar(),
        )
        .withColumn(
            "addresses_published_primary", published.agg(F.count("*").alias("n")).scalar()
        )
    )


def funnel(judged: DataFrame) -> DataFrame:
    """Publication funnel of the primary tier, in step order, with the share of the first step."""
    steps = [
        ("observed", F.lit(True)),
        ("restricted", F.col("drop_reason") == "not_redistributable"),
        ("allowlisted", F.col("drop_reason") == "allowlisted"),
        ("tag_only", F.col("drop_reason") == "tag_only"),
        ("withheld", F.col("drop_reason").isNull() & (F.col("band") == "withheld")),
        ("published", F.col("drop_reason").isNull() & (F.col("band") != "withheld")),
    ]
    wide = judged.filter("tier = 'primary'").agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in steps]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("label"), F.col(n).alias("indicators"))
            for i, (n, _) in enumerate(steps)
        ]
    )
    return wide.select(F.col("observed").alias("_peak"), F.inline(rows)).select(
        "step",
        "label",
        "indicators",
        M.share(F.col("indicators"), F.greatest("_peak", F.lit(1))).alias("percent"),
    )


def corroboration_shares(counts: DataFrame, single_class_seen: DataFrame) -> DataFrame:
    """Promoted share of published and of high, and indicators seen by exactly one class."""
    return counts.filter("tier = 'primary'").select(
        M.share(F.col("promoted"), F.col("published")).alias("promoted_of_published"),
        M.share(F.col("promoted"), F.col("high")).alias("promoted_of_high"),
        F.coalesce(single_class_seen.scalar(), F.lit(0).cast("bigint")).alias("single_class_seen"),
    )


def run_health(history: DataFrame) -> DataFrame:
    """State of each run from its source counts, and the sources that were not ok where they are known."""
    missing = F.greatest(F.col("sources_total") - F.col("sources_ok"), F.lit(0))
    named = [F.col("not_ok")] if "not_ok" in history.columns else []
    return history.select(
        "generated_at",
        missing.alias("missing"),
        F.when(missing >= 2, "severe").when(missing >= 1, "partial").otherwise("ok").alias("state"),
        *named,
    )


def not_ok(status: DataFrame) -> DataFrame:
    """Sources of a run that were not ok, in order."""
    return status.filter("status <> 'ok'").select("source", "status", "records").orderBy("source")


def label_shares(published: DataFrame, labels: DataFrame) -> DataFrame:
    """Published bare addresses per classification label."""
    known = labels.select(F.col("address").alias("indicator"), "label").distinct()
    return (
        published.filter("not is_net")
        .join(known, "indicator", "left")
        .groupBy("tier", F.coalesce("label", F.lit("unknown")).alias("label"))
        .agg(F.count("*").alias("addresses"))
    )


def band_counts(scored: DataFrame, *keys: str) -> DataFrame:
    return scored.groupBy(*keys, "tier").agg(
        F.count_if(F.col("band") != "withheld").alias("published"),
        F.count_if(F.col("band") == "high").alias("high"),
        F.count_if(F.col("band") == "medium").alias("medium"),
        F.count_if(F.col("band") == "withheld").alias("withheld"),
    )
