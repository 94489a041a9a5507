"""The corpus pipeline: documents in five stages, each an operator of lamina.llm.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept, and but for the last gives
the columns of `documents`. SQL cannot state the first stage's model, so there is no ORACLE_SQL: tests
hold the stages against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, langid, line_dedup, mixing, simhash
from lamina.llm.common import shared_folder

ORACLE_SQL = None

# Cosines of unrelated vectors scatter by 1/sqrt(dimensions), here 0.016, and the least is seven times that. On sf0.1,
# 99 % of random letters of any script are at 0.10 or below (Latin ones, which meet known n-grams by chance, come
# nearest), and whole documents at 0.15 or above, however short.
DIMENSIONS = 4096
LEAST_COSINE = 0.11


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without text or letters, and those unlike every language; sets lang of the others."""
    profiles = langid.train(docs, F.lit(True), dimensions=DIMENSIONS)
    found = langid.predict(docs, profiles).where(F.col("lang_pred") != langid.UNKNOWN)
    kept = found.where(F.col("score") >= LEAST_COSINE).withColumn("lang", F.col("lang_pred"))
    return kept.select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of line runs; a document of which nothing but blank lines is left goes."""
    found = line_dedup.drop_repeated_lines(docs)
    left = found.where((F.size("removed_lines") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.keep_one(docs).select(*docs.columns)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark).where("n_hit = 0").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics have their target shares of the tokens."""
    described = docs.withColumn("topic", mixing.topic_of(F.col("text"))).withColumn("n_tokens", mixing.n_tokens(F.col("text")))
    return mixing.mix(described).where("sampled").drop("sampled")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", remove_benchmarks),
    ("source_mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what each gives is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
