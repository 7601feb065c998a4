"""A training corpus in five stages: toxicity, line dedup, near-duplicate documents, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs``, and its result is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of ``docs``; extra columns pass through.

Null texts pass the first four stages like empty ones and are not changed; null ids, repeated rows and empty tables
are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.llm import bpe, decontaminate, lines, near, toxicity
from quorumlens.llm.common import settled
from quorumlens.llm.queries import tokenizer

#: A document with at least this score goes.
TOXIC = 0.5
#: Words of a shingle and Jaccard similarity of the shingles from which documents are near duplicates.
WORDS, SIMILARITY = 5, 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under TOXIC by a model of the labelled rows."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out_col="__toxic").where(F.col("__toxic") < TOXIC).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that resemble an earlier line; ``n_chars`` follows the text."""
    cut = lines.dedup_lines(docs, lines_col="__lines", removed_col="__removed")
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("__removed") > 0, size).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash and MinHash candidates, compared on their shingles."""
    return near.keep_one(docs, words=WORDS, similarity=SIMILARITY)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids; the text is what the ids decode to."""
    path = tokenizer("byte_bpe_50k.json")
    step, _ = bpe.encoder(docs, path)
    back = bpe.decoder(path, out_col="text")
    names = [*(c for c in docs.columns if c not in ("text", "ids")), "ids", "text"]
    schema = docs.withColumn("ids", F.expr("cast(null as array<int>)")).select(*names).schema
    return docs.mapInArrow(lambda batches: back(step(batches)), schema)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: Compression lengths and fingerprints are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
