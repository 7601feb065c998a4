"""Which sources (or classes) report which indicator, as membership patterns.

One aggregation turns the corpus into "pattern of members -> number of indicators".  There are few
distinct patterns, so agreement, exclusive counts and all pairwise overlaps come from that small
table; no indicator is ever joined with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import constants as K
from quorumlens.functions import measures as M
from quorumlens.sources.registry import dimension


def patterns(observations: DataFrame, member: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """(members, indicators): how many indicators exactly that set of members reports.

    Rows whose member is NULL still count their indicator.
    """
    sets = observations.groupBy(*keys, "indicator").agg(
        F.sort_array(F.collect_set(member)).alias("members")
    )
    return sets.groupBy(*keys, "members").agg(F.count("*").alias("indicators"))


def class_patterns(observations: DataFrame, sources: DataFrame) -> DataFrame:
    """Patterns of voting classes."""
    dim = dimension(
        sources,
        F.col("name").alias("source"),
        F.when(F.col("vote"), F.col("independence_class")).alias("_class"),
    )
    rows = observations.select("indicator", "source").join(dim, "source", "left")
    return patterns(rows, F.col("_class"))


def source_patterns(observations: DataFrame) -> DataFrame:
    return patterns(observations, F.col("source"))


def totals(pattern: DataFrame) -> DataFrame:
    """Indicators per member."""
    return (
        pattern.select(F.explode("members").alias("member"), "indicators")
        .groupBy("member")
        .agg(F.sum("indicators").alias("indicators"))
    )


def pair_counts(pattern: DataFrame) -> DataFrame:
    """Shared indicators per unordered pair (a < b)."""
    return (
        pattern.select("members", "indicators", F.explode("members").alias("a"))
        .select("a", "indicators", F.explode("members").alias("b"))
        .filter("a < b")
        .groupBy("a", "b")
        .agg(F.sum("indicators").alias("shared"))
    )


def overlap(pattern: DataFrame) -> DataFrame:
    """(a, b, shared, jaccard) for every pair of members, disjoint pairs included."""
    size = totals(pattern)
    left = size.select(F.col("member").alias("a"), F.col("indicators").alias("n_a"))
    right = size.select(F.col("member").alias("b"), F.col("indicators").alias("n_b"))
    every = size.agg(F.sort_array(F.collect_list("member")).alias("_all")).scalar()
    pairs = (
        left.withColumn("_all", every)
        .withColumn("b", F.explode("_all"))
        .filter("a < b")
        .drop("_all")
        .join(right, "b")
    )
    return pairs.join(pair_counts(pattern), ["a", "b"], "left").select(
        "a",
        "b",
        F.coalesce("shared", F.lit(0)).alias("shared"),
        M.jaccard(F.coalesce("shared", F.lit(0)), F.col("n_a"), F.col("n_b")).alias("jaccard"),
    )


def top_overlaps(pattern: DataFrame, limit: int = K.TOP_OVERLAPS) -> DataFrame:
    return overlap(pattern).orderBy(F.desc("jaccard"), "a", "b").limit(limit)


def containment(pattern: DataFrame) -> DataFrame:
    """Share of the row member's indicators that the column member has too."""
    size = totals(pattern).withColumnRenamed("member", "row_source")
    both = pair_counts(pattern)
    either = both.select(F.col("a").alias("row_source"), F.col("b").alias("col_source"), "shared").unionByName(
        both.select(F.col("b").alias("row_source"), F.col("a").alias("col_source"), "shared")
    )
    return either.join(size, "row_source").select(
        "row_source",
        "col_source",
        "shared",
        F.round(F.col("shared") * F.lit(100.0) / F.col("indicators"), 1).alias("percent"),
    )


def agreement(pattern: DataFrame) -> DataFrame:
    """Indicators by number of members, zero included."""
    return pattern.groupBy(F.size("members").alias("classes")).agg(
        F.sum("indicators").alias("indicators")
    )


def source_contribution(pattern: DataFrame, sources: DataFrame) -> DataFrame:
    """Per registered source: indicators reported, and those nobody else reports."""
    counted = (
        pattern.select(
            F.explode("members").alias("source"), "indicators", F.size("members").alias("_n")
        )
        .groupBy("source")
        .agg(
            F.sum("indicators").alias("addresses_reported"),
            F.sum(F.when(F.col("_n") == 1, F.col("indicators")).otherwise(0)).alias(
                "reported_only_by_this_source"
            ),
        )
    )
    dim = sources.select(
        F.col("name").alias("source"),
        F.coalesce(F.nullif("credit", F.lit("")), "license").alias("credit"),
        "independence_class",
        F.col("redistribute").alias("republished"),
        (F.col("redistribute") | F.col("redistribute_noncommercial")).alias(
            "republished_noncommercial_tier"
        ),
    )
    return counted.join(dim, "source")


def candidate_overlap(
    candidate: DataFrame, observations: DataFrame, published: DataFrame
) -> DataFrame:
    """Jaccard of a candidate list with every source and with the published table; above one half
    the candidate belongs to that source's class."""
    base = observations.select("indicator", "source").unionByName(
        published.select("indicator", F.lit("(published)").alias("source"))
    )
    cand = candidate.select("indicator", F.lit(True).alias("_cand")).distinct()
    marked = base.distinct().join(cand, "indicator", "left")
    per = marked.groupBy("source").agg(
        F.count("*").alias("n_source"), F.count("_cand").alias("shared")
    )
    size = cand.agg(F.count("*").alias("n")).scalar()
    scored = per.withColumn("n_candidate", size)
    value = M.jaccard(F.col("shared"), F.col("n_source"), F.col("n_candidate"))
    return scored.select(
        "source",
        "shared",
        value.alias("jaccard"),
        (F.col("shared") / (F.col("n_source") + F.col("n_candidate") - F.col("shared")) > 0.5).alias(
            "same_class"
        ),
    )
