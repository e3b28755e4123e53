"""XML export of stories.

Rows come from ``extract.xml_image``: columns with an underscore become
attributes of ``<Article>``, ``Text`` its only element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators import extract, maintain

ROOT, ROW = "Articles", "Article"


def write_articles(stories: DataFrame, path: str, batch_size: int, language: str = "ARB") -> None:
    """Export a language as files of at most ``batch_size`` articles each.

    The writer cuts files inside each task, so nothing is shuffled; the last
    file of a task holds the remainder, which is always written.
    """
    _write(extract.xml_image(stories, language), path, batch_size)


def write_chunks(
    stories: DataFrame, path: str, batch_size: int, language: str = "ARB", order: list[Column] | None = None,
) -> None:
    """Export a language as chunks numbered 1 to n, each of exactly ``batch_size`` articles but the last.

    Articles are numbered in ``order`` (the sequence number by default) by
    :func:`maintain.ranked`, without a window over one task; article ``r`` goes
    to chunk ``(r - 1) div batch_size + 1``. Each chunk is one file, written by
    one task, in the folder ``chunk=<number>``, which records its index.
    """
    order = order or [F.col("ingest_seq"), F.col("doc_key")]
    wanted = stories.where(stories["language"] == language)
    numbered = maintain.ranked(wanted, order, "_rank")
    chunk = ((F.col("_rank") - 1) / F.lit(batch_size)).cast("bigint") + 1
    images = extract.xml_image(numbered.withColumn("chunk", chunk), language, extra=("chunk",))
    count = images.agg(F.max("chunk")).first()[0] or 0
    (images.repartitionByRange(max(int(count), 1), "chunk").sortWithinPartitions("chunk")
     .write.mode("overwrite").format("xml").option("rootTag", ROOT).option("rowTag", ROW)
     .partitionBy("chunk").save(path))


def read_chunks(spark, path: str) -> DataFrame:
    """Exported chunks: ``chunk, rows, files``."""
    schema = "_date string, _id string, _mongoId string, _source string, _sentence string, Text string, chunk bigint"
    articles = spark.read.format("xml").option("rowTag", ROW).schema(schema).load(path)
    files = articles.select("chunk", F.col("_metadata.file_path").alias("file"))
    return files.groupBy("chunk").agg(F.count("*").alias("rows"), F.countDistinct("file").alias("files"))


def write_first_articles(stories: DataFrame, path: str, n: int = 500, language: str = "ARB", key: str = "doc_key") -> None:
    """Export the first ``n`` articles of a language by key as one file."""
    wanted = maintain.first_n(stories.where(stories["language"] == language), n, key)
    _write(extract.xml_image(wanted, language).coalesce(1), path, n)


def _write(image: DataFrame, path: str, per_file: int) -> None:
    (image.write.mode("overwrite").format("xml")
     .option("rootTag", ROOT).option("rowTag", ROW)
     .option("maxRecordsPerFile", per_file).save(path))


def read_articles(spark, path: str) -> DataFrame:
    """Exported articles, as ``extract.xml_image`` rows."""
    schema = "_date string, _id string, _mongoId string, _source string, _sentence string, Text string"
    return spark.read.format("xml").option("rowTag", ROW).option("ignoreSurroundingSpaces", "false").schema(schema).load(path)
