"""From raw documents to shards: language, near duplicates, benchmark passages, source mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.llm import decontamination, language, mixing, neardup, sharding
from installarc.llm.common import WORD, stage_for, with_keys

WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
SHARDS = 24


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without letters, or between two languages, go.

    Where no document has both a language and a letter, nothing can be learnt, and only those without letters go.
    """
    lettered = docs.filter(F.col("text").rlike("\\p{L}"))
    model = language.train(lettered)
    if not model.languages:
        return lettered
    told = language.predict(docs, model)
    return told.filter(~F.col("ambiguous")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (80 % of five-word shingles): that with the smallest id."""
    kept = neardup.representatives(neardup.near_duplicates(docs))
    return with_keys(docs, kept, "left_semi").dropDuplicates(["_content_key"]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words of a benchmark item occur."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, items)
    hit = found.filter("contaminated").select("key").distinct()
    return with_keys(docs, hit, "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the weights of the mix; a document comes as often as the mix takes it."""
    words = F.regexp_count(F.col("text"), F.lit(WORD))
    return mixing.repeated(mixing.mix(docs, words, WEIGHTS, SHARE, MOST), docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, its slot there and the shard it would have with one shard more."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]

#: Classifier and sketches have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = stage_for(docs)
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
