"""Published forms of the scored table.  Each is a projection; writing it is Spark's own writer."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import text as X
from quorumlens.operators.ordered import ranked


def iso_time(ts: Column) -> Column:
    """Timestamp as ISO 8601 with offset, microseconds only where there are any."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")).otherwise(""),
        F.lit("+00:00"),
    )


#: Files a writing task may hold open at once: over the tiers x bands x lists of any form.
OPEN_FILES = 64


@contextmanager
def in_address_order(published: DataFrame):
    """The published rows range-partitioned and sorted by (tier, address), once for all forms that are written from them.

    Partition columns are never null here, and rows keep their order within every partition value: the writer holds one file
    open for each instead of sorting by it.  So the parts of every list, read by name, are in address order.
    """
    spark = published.sparkSession
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    order = [F.col("tier"), *A.sort_key()]
    rows = published.repartitionByRange(*order).sortWithinPartitions(*order).persist(StorageLevel.DISK_ONLY)
    spark.conf.set(setting, str(OPEN_FILES))
    try:
        yield rows
    finally:
        rows.unpersist()
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def blockable(published: DataFrame) -> DataFrame:
    """What may be blocked or alerted on without a look: the high band alone."""
    return published.filter(F.col("band") == "high")


def positions(published: DataFrame) -> DataFrame:
    """(tier, indicator, position): place in the address order of its tier's whole list, counted over range partitions."""
    keys = published.select("tier", "indicator", "family", "lo", "lo6", "prefix")
    return ranked(keys, "tier", A.sort_key(), "position").select("tier", "indicator", "position")


def csv_rows(published: DataFrame, *keep: str) -> DataFrame:
    """Flat table: two-decimal score, list columns joined by ``|``; ``keep`` names columns that go before."""
    return published.select(
        *keep,
        "indicator",
        A.address_family().alias("address_family"),
        F.col("score").cast("decimal(5,2)").cast("string").alias("score"),
        "band",
        *[X.joined(F.col(c)).alias(c) for c in ("independence_classes", "sources", "categories", "tags")],
        iso_time(F.col("first_seen")).alias("first_seen"),
        iso_time(F.col("last_seen")).alias("last_seen"),
        F.coalesce("source_reference", F.lit("")).alias("source_reference"),
    )


def full_rows(published: DataFrame) -> DataFrame:
    """Everything publishable about a record."""
    return published.select(
        "tier",
        F.col("indicator").alias("ip_or_cidr"),
        A.address_family().alias("address_family"),
        "score",
        "band",
        "independence_classes",
        "sources",
        "categories",
        "tags",
        iso_time(F.col("first_seen")).alias("first_seen"),
        iso_time(F.col("last_seen")).alias("last_seen"),
        "promoted_by",
        "restricted_corroboration",
        "source_reference",
        "source_registry",
    )


def list_rows(published: DataFrame) -> DataFrame:
    """(tier, band, list, indicator): every text list an entry appears on, combined and by family."""
    lists = F.array(F.lit("all"), A.address_family())
    return published.select("tier", "band", F.explode(lists).alias("list"), "indicator")


def ipset_rows(published: DataFrame, set_name: str = "quorum") -> DataFrame:
    """One ``add`` line per high entry; one set per family."""
    name = F.when(F.col("family") == 4, set_name).otherwise(set_name + "6")
    return blockable(published).select(
        "tier", "family", F.concat(F.lit("add "), name, F.lit(" "), F.col("indicator")).alias("line")
    )


def nft_rows(published: DataFrame) -> DataFrame:
    """One set element line per high entry."""
    name = F.when(F.col("family") == 4, "blocklist4").otherwise("blocklist6")
    return blockable(published).select(
        "tier",
        "family",
        F.concat(F.lit("add element inet quorum "), name, F.lit(" { "), F.col("indicator"), F.lit(" }")).alias(
            "line"
        ),
    )


def excluded_counts(published: DataFrame) -> DataFrame:
    """Per family's set: how many high records of the other family it leaves out."""
    per = blockable(published).groupBy("tier").agg(
        F.count_if(F.col("family") == 4).alias("_v4"), F.count_if(F.col("family") == 6).alias("_v6")
    )
    return per.select(
        "tier",
        F.inline(
            F.array(
                F.struct(F.lit(4).alias("family"), F.col("_v4").alias("included"), F.col("_v6").alias("excluded")),
                F.struct(F.lit(6).alias("family"), F.col("_v6").alias("included"), F.col("_v4").alias("excluded")),
            )
        ),
    )


def stix_rows(published: DataFrame) -> DataFrame:
    """STIX 2.1 indicator objects of the high entries, one row each."""
    kind = F.when(F.col("family") == 4, "ipv4-addr").otherwise("ipv6-addr")
    zulu = lambda c: F.replace(iso_time(F.col(c)), F.lit("+00:00"), F.lit("Z"))
    return blockable(published).select(
        "tier",
        F.lit("indicator").alias("type"),
        F.lit("2.1").alias("spec_version"),
        F.concat(F.lit("indicator--"), X.record_uuid(F.col("indicator"))).alias("id"),
        zulu("first_seen").alias("created"),
        zulu("last_seen").alias("modified"),
        F.concat(F.lit("Malicious IP "), F.col("indicator")).alias("name"),
        F.array(F.lit("malicious-activity")).alias("indicator_types"),
        F.concat(F.lit("["), kind, F.lit(":value = '"), F.col("indicator"), F.lit("']")).alias(
            "pattern"
        ),
        F.lit("stix").alias("pattern_type"),
        zulu("first_seen").alias("valid_from"),
        F.col("score").cast("int").alias("confidence"),
        F.when(F.size("categories") > 0, F.col("categories"))
        .otherwise(F.array(F.lit("malicious-activity")))
        .alias("labels"),
        F.transform("sources", lambda s: F.struct(s.alias("description"))).alias("external_references"),
    )


def misp_rows(published: DataFrame) -> DataFrame:
    """MISP attributes of the high entries, one row each."""
    return blockable(published).select(
        "tier",
        F.lit("ip-dst").alias("type"),
        F.lit("Network activity").alias("category"),
        F.lit(True).alias("to_ids"),
        F.col("indicator").alias("value"),
        F.concat(
            F.lit("score="),
            F.bround("score", 0).cast("int").cast("string"),
            F.lit(" classes="),
            X.joined(F.col("independence_classes"), ","),
        ).alias("comment"),
    )


def lookup_rows(published: DataFrame) -> DataFrame:
    """Range table for lookups: numeric bounds as text, exact for 128 bits."""
    four = F.col("family") == 4
    low = F.when(four, F.col("lo").cast("string")).otherwise(A.v6_decimal_text(F.col("lo6")))
    high = F.when(four, F.col("hi").cast("string")).otherwise(A.v6_decimal_text(F.col("hi6")))
    return published.select(
        "tier",
        "family",
        low.alias("low"),
        high.alias("high"),
        F.bround("score", 0).cast("int").alias("score"),
        "band",
        F.size("independence_classes").alias("classes"),
        "indicator",
        X.joined(F.col("sources"), ", ").alias("sources"),
        "restricted_corroboration",
        F.coalesce("source_reference", F.lit("")).alias("source_reference"),
    )


def published_schema(published: DataFrame) -> str:
    """Schema of the full record table as JSON text."""
    return full_rows(published).schema.json()


def write_schema(published: DataFrame, folder: str) -> None:
    """The record table's schema as one JSON text beside the forms."""
    spark = published.sparkSession
    text = spark.createDataFrame([(published_schema(published),)], "value string")
    text.coalesce(1).write.text(f"{folder}/schema")


def write_document(document: DataFrame, folder: str, *parts: str) -> DataFrame:
    """Write a document of few rows as JSON, by ``parts``, and read it back."""
    schema = document.schema
    document.coalesce(1).write.partitionBy(*parts).json(folder)
    return document.sparkSession.read.schema(schema).json(folder)


def write_all(published: DataFrame, folder: str) -> None:
    """Write every published form under the new folder ``folder``, partitioned by tier, from one sort."""
    with in_address_order(published) as rows:
        full_rows(rows).write.partitionBy("tier").json(f"{folder}/records")
        csv_rows(rows, "tier").write.partitionBy("tier").option("header", True).csv(f"{folder}/table")
        list_rows(rows).write.partitionBy("tier", "band", "list").text(f"{folder}/lists")
        ipset_rows(rows).write.partitionBy("tier", "family").text(f"{folder}/ipset")
        nft_rows(rows).write.partitionBy("tier", "family").text(f"{folder}/nft")
        stix_rows(rows).write.partitionBy("tier").json(f"{folder}/stix")
        misp_rows(rows).write.partitionBy("tier").json(f"{folder}/misp")
        lookup_rows(rows).write.partitionBy("tier", "family").json(f"{folder}/lookup")
