"""Runs below one folder: written aside, then published by one small file; histories by partition.

    judged/run=...  state/run=...  forms/run=...   what a run wrote, under a name of its own
    history/generated_at=...                       one partition a run, replaced if the run is repeated
    networks/day=...                               one partition a day of the networks' history
    published/                                     one row a run that was published, with its name

A run's name is in ``published`` only after all it wrote is complete, so a failed run leaves the last one readable, and
nothing that is being read is ever overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.functions import constants as K
from quorumlens.session import written


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a store that Spark can read holds ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def publish(spark: SparkSession, folder: str, name: str) -> None:
    """Make run ``name`` the published one: the committed append of one row."""
    row = spark.createDataFrame([(name,)], "name string").withColumn("published_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").json(f"{folder}/published")


def published_run(spark: SparkSession, folder: str) -> str | None:
    """Name of the run that was published last; None before the first."""
    if not exists(spark, f"{folder}/published"):
        return None
    runs = spark.read.schema("name string, published_at timestamp").json(f"{folder}/published")
    return runs.agg(F.max_by("name", F.struct("published_at", "name"))).first()[0]


def of_run(spark: SparkSession, folder: str, part: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{part}/run={name}")


def upsert(rows: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions of the table at ``path`` that ``rows`` have rows of; others stay."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def record_run(entry: DataFrame, folder: str) -> None:
    """Add the run's line (generated_at and what the manifest says) to the history, or replace it."""
    upsert(entry, f"{folder}/history", "generated_at")


def run_history(spark: SparkSession, folder: str, keep: int = K.HISTORY_RUNS) -> DataFrame:
    """The newest ``keep`` lines of the history."""
    rows = spark.read.option("basePath", f"{folder}/history").parquet(f"{folder}/history")
    rows = rows.withColumn("generated_at", F.col("generated_at").cast("string"))
    return rows.orderBy(F.desc("generated_at")).limit(keep)


_DAYS = "asn bigint, addresses bigint, day date"


def network_history(spark: SparkSession, folder: str) -> DataFrame | None:
    """(day, asn, addresses) so far; None before the first run with ranges."""
    path = f"{folder}/networks"
    if not exists(spark, path):
        return None
    return spark.read.schema(_DAYS).parquet(path).select("day", "asn", "addresses")


def record_networks(today: DataFrame, folder: str) -> None:
    """Fold a run's (day, asn, addresses) into the history by maximum; only days that the run has rows of are rewritten."""
    spark = today.sparkSession
    today = written(today.select("day", "asn", "addresses"), "networks-today")
    before = network_history(spark, folder)
    if before is not None:
        today = today.unionByName(before.join(today.select("day").distinct(), "day", "left_semi"))
    merged = today.groupBy("day", "asn").agg(F.max("addresses").alias("addresses"))
    # Written aside first: a partition is not read while it is replaced.
    upsert(written(merged, "networks-merged").repartition("day"), f"{folder}/networks", "day")
