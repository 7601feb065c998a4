"""The two documents of a run, as nested rows put together from small tables.

Every part is bounded before it is gathered: tiers, bands, drop rules, classes, registry sources, top-k lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import constants as K
from quorumlens.operators import carry, families, membership, networks, reports, safety
from quorumlens.sources.registry import active_voting_classes


def _map_of(df: DataFrame, group: str, key: str, value: Column, out: str) -> DataFrame:
    """One map column a group, keys in order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return df.groupBy(group).agg(F.map_from_entries(entries).alias(out))


def deltas(published: DataFrame, before: DataFrame | None, limit: int = K.DELTA_EXAMPLES) -> DataFrame:
    """Per tier: how many indicators came and went since ``before``, and the first of each by text."""
    old = published.limit(0) if before is None else before
    changed = carry.published_delta(published, old, ("tier",))
    counts = changed.groupBy("tier").agg(
        F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "removed").alias("removed")
    )
    first = safety.first_per_group(changed, ["tier", "change"], [F.col("indicator").asc()], limit)
    listed = lambda c: F.array_sort(F.collect_list(F.when(F.col("change") == c, F.col("indicator"))))
    examples = first.groupBy("tier").agg(
        listed("added").alias("added_examples"), listed("removed").alias("removed_examples")
    )
    return counts.join(examples, "tier")


def manifest(
    judged: DataFrame,
    sources: DataFrame,
    as_of: str,
    status: DataFrame | None = None,
    before: DataFrame | None = None,
    tiers: tuple[str, ...] = (),
) -> DataFrame:
    """One document a tier: counts, histogram, deltas, filters, sources and active voting classes.

    ``status`` holds (source, status, records) as of ``reference_tables.source_status``; ``before`` the tier's last
    publication (tier, indicator).  ``tiers`` names tiers that get a document even if no row was judged for them.
    """
    spark = judged.sparkSession
    published = safety.publishable(safety.kept(judged))
    counts = reports.run_counts(judged)
    numbers = [c for c in counts.columns if c not in ("tier", "indicators")]
    if tiers:
        every = spark.createDataFrame([(t,) for t in tiers], "tier string")
        counts = every.join(counts, "tier", "left").fillna(0)
    histogram = reports.corroboration_histogram(published).withColumn("classes", F.col("classes").cast("string"))
    histogram = _map_of(histogram, "tier", "classes", F.col("indicators"), "corroboration_histogram")
    drops = _map_of(safety.drop_counts(judged), "tier", "drop_reason", F.col("dropped"), "dropped")
    shown = safety.drop_examples(judged).groupBy("tier", "drop_reason").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "indicator"))), lambda x: x["indicator"]).alias("x")
    )
    shown = _map_of(shown, "tier", "drop_reason", F.col("x"), "examples")
    doc = counts
    for part in (histogram, deltas(published, before), drops, shown):
        doc = doc.join(part, "tier", "left")
    if status is None:
        status = sources.select(F.col("name").alias("source"), F.lit(None).cast("string").alias("status"), F.lit(0).cast("bigint").alias("records"))
    block = reports.source_block(status, sources)
    facts = [c for c in block.columns if c != "source"]
    listed = _map_of(block.withColumn("all", F.lit(1)), "all", "source", F.struct(*facts), "sources").select("sources")
    voting = active_voting_classes(sources).agg(F.array_sort(F.collect_list("independence_class")))
    none, zero = F.array().cast("array<string>"), F.lit(0).cast("bigint")
    return doc.select(
        "tier",
        F.lit(str(as_of)).alias("generated_at"),
        F.struct(*numbers).alias("counts"),
        F.coalesce("corroboration_histogram", F.create_map().cast("map<string,bigint>")).alias("corroboration_histogram"),
        F.struct(
            *[F.coalesce(c, zero).alias(c) for c in ("added", "removed")],
            *[F.coalesce(c, none).alias(c) for c in ("added_examples", "removed_examples")],
        ).alias("deltas"),
        F.struct(
            F.coalesce("dropped", F.create_map().cast("map<string,bigint>")).alias("dropped"),
            F.coalesce("examples", F.create_map().cast("map<string,array<string>>")).alias("examples"),
        ).alias("filters"),
        listed.scalar().alias("sources"),
        voting.scalar().alias("active_voting_classes"),
    )


def history_line(manifests: DataFrame) -> DataFrame:
    """The line a run leaves in the history, from the primary tier's document."""
    ok = F.filter(F.map_values("sources"), lambda s: s["status"] == "ok")
    bad = F.filter(F.map_entries("sources"), lambda e: ~F.equal_null(e["value"]["status"], F.lit("ok")))
    seen = F.map_filter("sources", lambda _, s: s["records"] > 0)
    return manifests.filter("tier = 'primary'").select(
        "generated_at",
        "counts.published",
        "counts.high",
        "counts.medium",
        "deltas.added",
        "deltas.removed",
        F.size(ok).cast("bigint").alias("sources_ok"),
        F.size("sources").cast("bigint").alias("sources_total"),
        F.transform_values(seen, lambda _, s: s["records"]).alias("by_source"),
        F.transform(bad, lambda e: e["key"]).alias("not_ok"),
    )


def _rows(df: DataFrame, *order: Column | str) -> Column:
    """All rows of a bounded table as an array in order, as a scalar."""
    keyed = F.struct(F.struct(*order).alias("o"), F.struct(*df.columns).alias("r"))
    return df.agg(F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["r"])).scalar()


def insights(
    observations: DataFrame,
    judged: DataFrame,
    sources: DataFrame,
    as_of: str,
    ranges: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One document of statistics over all sources; no indicator appears in it.

    With ``ranges``, networks are named down to the smallest cell shown; with ``history`` too, their persistence.
    """
    spark = observations.sparkSession
    patterns = membership.class_patterns(observations, sources)
    shown = safety.publishable(judged.filter("tier = 'primary'"))
    agreement = membership.agreement(patterns).select(F.col("classes").cast("string").alias("k"), "indicators")
    agreement = agreement.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "indicators")))))
    corpus = reports.corpus_counts(observations, judged, sources)
    parts = {
        "corpus": corpus.select(F.struct(*corpus.columns)).scalar(),
        "agreement": agreement.scalar(),
        "sources": _rows(membership.source_contribution(membership.source_patterns(observations), sources), "source"),
        "class_overlap": _rows(membership.top_overlaps(patterns), (-F.col("jaccard")).alias("j"), "a", "b"),
        "family_coverage": _rows(families.observation_coverage(observations, sources), "source"),
        "families": _rows(families.family_stats(shown), "family"),
        "prefixes": _rows(families.prefix_histogram(shown), "family", "key"),
        "suppressed": _rows(families.flat_dimensions(shown.filter("family = 6")), "analysis"),
    }
    spectrum = networks.spectrum_summary(networks.spectrum(observations))
    parts["spectrum"] = spectrum.select(F.struct(*spectrum.columns)).scalar()
    if ranges is not None:
        enriched = networks.enriched_observations(observations, ranges)
        rolled = networks.network_rollup(enriched, ranges)
        parts["networks"] = _rows(networks.top_networks(rolled), (-F.col("addresses")).alias("n"), "asn")
        if history is not None:
            parts["persistence"] = _rows(networks.persistence(history, ranges, as_of), "window", "rank")
    return spark.range(1).select(
        F.lit(str(as_of)).alias("generated_at"), *[value.alias(name) for name, value in parts.items()]
    )
