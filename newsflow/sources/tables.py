"""Stories as a projection of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Corpus language codes of the two-letter tags.
LANGUAGES = {"en": "ENG", "fr": "FRE", "de": "GER", "es": "SPA"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stories_of(documents: DataFrame) -> DataFrame:
    """The shared story projection of ``documents``."""
    language = F.coalesce(*[
        F.when(F.col("lang") == tag, F.lit(code)) for tag, code in LANGUAGES.items()
    ])
    key = F.col("doc_id").cast("string")
    date = F.date_add(F.lit("1994-01-01").cast("date"), F.pmod("doc_id", F.lit(5000)).cast("int"))
    padded = F.lpad(key, F.greatest(F.length(key), F.lit(4)), "0")
    external = F.concat(
        F.lit("SRC_"), language, F.lit("_"), F.date_format(date, "yyyyMMdd"), F.lit("."), padded
    )
    return documents.select(
        F.col("doc_id").alias("ingest_seq"),
        key.alias("doc_key"),
        external.alias("doc_id"),
        language.alias("language"),
        F.col("source").alias("news_source"),
        date.alias("publication_date"),
        F.date_format(date, "yyyyMMdd").alias("date"),
        F.col("text").alias("article_body"),
        F.floor(F.col("doc_id") / 100).alias("batch_id"),
    )


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stories_of(table(spark, sf_dir, "documents"))


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Give CPU-heavy work on a small input every core.

    A table with a single file or row group is one task however many cores wait.
    Inputs that already have a partition per core - any large one - are returned
    as they are, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(per_core * cores) if df.rdd.getNumPartitions() < cores else df


def spread_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stories_of(spread(table(spark, sf_dir, "documents")))
