"""Structure per address family, with small cells folded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K


def observation_coverage(observations: DataFrame, sources: DataFrame) -> DataFrame:
    """Observations per source and family, for sources that report any IPv6."""
    dim = sources.select(
        F.col("name").alias("source"),
        "independence_class",
        F.col("redistribute").alias("redistributable"),
    )
    return (
        observations.groupBy("source")
        .agg(
            F.count_if(F.col("family") == 6).alias("ipv6_observations"),
            F.count_if(F.col("family") == 4).alias("ipv4_observations"),
        )
        .filter("ipv6_observations > 0")
        .join(dim, "source", "left")
    )


def by_coverage(coverage: DataFrame) -> DataFrame:
    """Rows of ``observation_coverage`` (one a registered source) with their place: most IPv6 first, then by name."""
    order = Window.orderBy(F.desc("ipv6_observations"), "source")
    return coverage.withColumn("place", F.row_number().over(order))


def _distinct_items(rows: DataFrame, *columns: str) -> DataFrame:
    """Per family: the number of distinct elements of array ``columns``.

    Elements are folded one by one before they are counted, so nothing is gathered, whatever the arrays are.
    """

    def named(c: str) -> Column:
        return F.transform(c, lambda x: F.struct(F.lit(c).alias("c"), x.alias("x")))

    tagged = F.concat(*[named(c) for c in columns])
    each = rows.select("family", F.inline(tagged)).groupBy("family", "c", "x").count()
    return each.groupBy("family").agg(*[F.count_if(F.col("c") == c).alias(c) for c in columns])


def family_stats(published: DataFrame) -> DataFrame:
    """Counts, scope and breadth per family."""
    numbers = published.groupBy("family").agg(
        F.count("*").alias("published"),
        F.count_if(F.col("band") == "high").alias("high"),
        F.count_if(F.col("band") == "medium").alias("medium"),
        F.sum(A.subnets_64()).alias("blast_radius_64"),
        F.count_distinct(A.allocation_key()).alias("distinct_allocations"),
    )
    items = _distinct_items(published, "independence_classes", "sources")
    return numbers.join(items, "family", "left").fillna(0, ["independence_classes", "sources"]).withColumn(
        "address_family", A.address_family()
    )


def cell_counts(published: DataFrame, key: Column, group: str = "family") -> DataFrame:
    return published.groupBy(group, key.alias("key")).agg(F.count("*").alias("entries"))


def fold_small_cells(cells: DataFrame, group: str = "family") -> DataFrame:
    """Cells of at least five entries keep their key; the rest become one unnamed row."""
    named = F.when(F.col("entries") >= K.MIN_CELL, F.col("key"))
    return cells.groupBy(group, named.alias("key")).agg(
        F.sum("entries").alias("entries"), F.count("*").alias("cells")
    )


def prefix_key() -> Column:
    return F.concat(F.lit("/"), A.network_prefix().cast("string"))


def prefix_histogram(published: DataFrame) -> DataFrame:
    return fold_small_cells(cell_counts(published, prefix_key()))


def scope_by_prefix(published: DataFrame) -> DataFrame:
    """Per family and prefix length: entries, their scope, and the scope of a single entry."""
    width = A.network_prefix()
    return (
        published.withColumn("_p", width)
        .groupBy("family", "_p")
        .agg(
            F.count("*").alias("entries"),
            F.sum(A.subnets_64()).alias("blast_radius_64"),
            F.max(A.subnets_64()).alias("one_entry_64"),
        )
        .select(
            "family",
            F.concat(F.lit("/"), F.col("_p").cast("string")).alias("prefix"),
            "entries",
            "blast_radius_64",
            "one_entry_64",
        )
    )


def unicast_blocks(published: DataFrame) -> DataFrame:
    """Entries per /12 of IPv6 space, small cells folded."""
    return fold_small_cells(cell_counts(published.filter("family = 6"), A.unicast_block()))


def ipv6_totals(published: DataFrame) -> DataFrame:
    """IPv6 entries, /48 sites and distinct /32 allocations."""
    six = published.filter("family = 6")
    return six.agg(
        F.count("*").alias("entries"),
        F.coalesce(F.sum(A.sites_48()), F.lit(0)).alias("sites_48"),
        F.count_distinct(A.allocation_key()).alias("distinct_allocations_32"),
    )


def flat_dimensions(published: DataFrame) -> DataFrame:
    """Analyses without signal per family: those whose dimension has fewer than two values, and why.

    A dimension comes back by itself once a second value appears.  Persistence of networks needs a range that names
    them; no range names an IPv6 network, so it is without signal wherever there are IPv6 entries.
    """
    wide = published.groupBy("family").agg(
        F.count("*").alias("entries"),
        F.count_distinct("score").alias("scores"),
        F.min("score").alias("score"),
        F.count_distinct("band").alias("bands"),
        F.min("band").alias("band"),
        F.count_distinct(F.array_sort("categories")).alias("categories"),
    )
    items = _distinct_items(published, "independence_classes", "sources")
    wide = wide.join(items, "family", "left").fillna(0, ["independence_classes", "sources"])
    known = F.when(F.col("family") == 6, F.lit(0).cast("bigint"))
    rows = [
        (K.FLAT_CLASSES, F.col("independence_classes"), F.concat(F.col("independence_classes").cast("string"), F.lit(" class in all"))),
        (K.FLAT_SCORES, F.col("scores"), F.concat(F.lit("all scores are "), F.round("score", 1).cast("string"))),
        (K.FLAT_BANDS, F.col("bands"), F.concat(F.lit("all entries are "), F.col("band"))),
        (K.FLAT_CHANGES, F.col("sources"), F.lit("one source, so all entries come and go together")),
        (K.FLAT_CATEGORIES, F.col("categories"), F.lit("all entries have one set of categories")),
        (K.FLAT_NETWORKS, known, F.lit("no range names an IPv6 network")),
    ]
    each = [F.struct(F.lit(n).alias("analysis"), v.alias("distinct_values"), r.alias("reason")) for n, v, r in rows]
    return wide.select("family", F.inline(F.array(*each))).filter("distinct_values < 2")


def concentration(published: DataFrame) -> DataFrame:
    """Families resting on fewer than two classes."""
    entries = published.groupBy("family").agg(F.count("*").alias("entries"))
    classes = _distinct_items(published, "independence_classes").withColumnRenamed("independence_classes", "classes")
    return entries.join(classes, "family", "left").fillna(0, ["classes"]).withColumn("single_class", F.col("classes") < 2)
