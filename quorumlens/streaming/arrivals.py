"""Newly arrived payload files, in the same batch jobs.

The engine has no event-time windows: it is a recurring batch.  What recurs is "read the files that
came since last time", which Structured Streaming's file source tracks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.sources.ingest import FORMATS, OBSERVATION_COLUMNS


def ingest_new_files(
    spark: SparkSession,
    source: str,
    folder: str,
    format_name: str,
    sources: DataFrame,
    fetched,
    table_path: str,
    progress_path: str,
) -> None:
    """Append the observations in files not read before to the table at ``table_path``."""
    lines = spark.readStream.format("text").load(folder).select(
        F.lit(source).alias("source"), F.col("value").alias("line")
    )
    parsed = FORMATS[format_name](lines, sources, fetched)
    query = (
        parsed.filter("status = 'ok'")
        .select(*OBSERVATION_COLUMNS)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
