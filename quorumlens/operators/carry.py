"""State across runs: sightings, carried votes, ageing, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import constants as K
from quorumlens.functions import scoring as S
from quorumlens.functions.addresses import ADDRESS_COLUMNS
from quorumlens.sources.registry import dimension


def latest_sightings(observations: DataFrame) -> DataFrame:
    """Latest sighting per (indicator, source)."""
    return observations.groupBy("indicator", "source").agg(F.max("last_seen").alias("last_seen"))


def build_state(kept: DataFrame, observations: DataFrame) -> DataFrame:
    """State to save: surviving indicators of the primary tier with the latest sightings of every
    source, carried ones included at their old date."""
    seen = (
        latest_sightings(observations)
        .groupBy("indicator")
        .agg(F.sort_array(F.collect_list(F.struct("source", "last_seen"))).alias("sightings"))
    )
    primary = kept.filter("tier = 'primary'").select(
        "indicator",
        "first_seen",
        "last_seen",
        "band",
        F.size("independence_classes").alias("class_count"),
    )
    empty = F.array().cast("array<struct<source:string,last_seen:timestamp>>")
    return primary.join(seen, "indicator", "left").withColumn(
        "sightings", F.coalesce("sightings", empty)
    )


def seed_state(published: DataFrame) -> DataFrame:
    """State rebuilt from the last published table; without sightings nothing is carried."""
    empty = F.array().cast("array<struct<source:string,last_seen:timestamp>>")
    return published.select(
        "indicator",
        "first_seen",
        "last_seen",
        "band",
        F.size("independence_classes").alias("class_count"),
        empty.alias("sightings"),
    )


def carried_observations(
    fresh: DataFrame, state: DataFrame, sources: DataFrame, as_of
) -> DataFrame:
    """Votes of sources that missed this run, for indicators somebody reports now.

    Fresh rows are folded to one row per indicator first (the sources reporting it), so the join
    with the state is one to one.
    """
    now = S.moment(as_of)
    reported = fresh.groupBy(*ADDRESS_COLUMNS).agg(F.collect_set("source").alias("_reporting"))
    prior = state.select(
        "indicator", F.col("first_seen").alias("_first"), F.explode("sightings").alias("_s")
    ).select("indicator", "_first", "_s.source", F.col("_s.last_seen").alias("_last"))
    dim = dimension(
        sources.filter("enabled and vote and ttl_days > 0"),
        F.col("name").alias("source"),
        "independence_class",
        "categories",
        "ttl_days",
    )
    age = S.age_days(F.col("_last"), now)
    missed = (
        prior.join(dim, "source")
        .filter((age > 0.0) & (age <= F.col("ttl_days")))
        .join(reported, "indicator")
        .filter(~F.array_contains(F.col("_reporting"), F.col("source")))
    )
    return missed.select(
        *ADDRESS_COLUMNS,
        "source",
        F.col("_first").alias("first_seen"),
        F.col("_last").alias("last_seen"),
        "categories",
        F.array().cast("array<string>").alias("tags"),
        F.lit(True).alias("carried"),
        F.lit(False).alias("evidence_stale"),
        F.lit(None).cast("string").alias("source_reference"),
        F.lit(None).cast("string").alias("source_registry"),
        F.lit(None).cast("date").alias("source_last_reported"),
    )


def merge_first_seen(scored: DataFrame, state: DataFrame) -> DataFrame:
    """Keep the earliest first_seen; ``is_new`` marks indicators the state does not know."""
    prior = state.select("indicator", F.col("first_seen").alias("_prior"))
    return (
        scored.join(prior, "indicator", "left")
        .withColumn("is_new", F.col("_prior").isNull())
        .withColumn("first_seen", F.least("first_seen", "_prior"))
        .drop("_prior")
    )


def longest_ttl(sources: DataFrame):
    """Longest time to live among enabled sources, 14 days without any (scalar column)."""
    return F.coalesce(
        sources.filter("enabled").agg(F.max("ttl_days").alias("ttl")).scalar(),
        F.lit(K.DEFAULT_TTL_DAYS),
    )


def ageing(state: DataFrame, scored: DataFrame, sources: DataFrame, as_of) -> DataFrame:
    """State rows nobody reports any more, labelled ``retained`` or ``aged_out``."""
    gone = state.join(scored.select("indicator").distinct(), "indicator", "left_anti")
    oldest = F.unix_micros(S.moment(as_of)) - longest_ttl(sources) * F.lit(86_400_000_000)
    return gone.withColumn(
        "fate", F.when(F.unix_micros("last_seen") >= oldest, "retained").otherwise("aged_out")
    )


def published_delta(now_published: DataFrame, before: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, indicator, change) rows between two publications."""
    on = [*keys, "indicator"]
    new, old = now_published.select(*on).distinct(), before.select(*on).distinct()
    added = new.join(old, on, "left_anti").withColumn("change", F.lit("added"))
    removed = old.join(new, on, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def append_run(history: DataFrame, entry: DataFrame, keep: int = K.HISTORY_RUNS) -> DataFrame:
    """Run history with this run's entry replaced or added, the newest ``keep`` runs kept."""
    others = history.join(entry.select("generated_at"), "generated_at", "left_anti")
    return others.unionByName(entry).orderBy(F.desc("generated_at")).limit(keep)
