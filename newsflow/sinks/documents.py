"""JSON, parquet and batch-directory sinks. Every write is one distributed job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import messages
from newsflow.operators import extract


def publish_stories(stories: DataFrame, path: str, key: str | None = None) -> None:
    """One extended-JSON message per story and line."""
    stories.select(messages.story_message(stories, key).alias("value")).write.mode("append").text(path)


def publish_rows(stored: DataFrame, path: str) -> None:
    """One JSON array ``[id, date, output, mongo_id]`` per stored row and line."""
    value = messages.row_message("id", "date", "output", "mongo_id")
    stored.select(value.alias("value")).write.mode("append").text(path)


def publish_to_kafka(values: DataFrame, servers: str, topic: str) -> None:
    """The same ``value`` rows to a topic (needs the Kafka connector on the class path)."""
    (values.select("value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def insert_stories(articles: DataFrame, path: str) -> None:
    """Append articles as stories, stamped with the load time."""
    extract.story_record(articles, F.current_timestamp()).write.mode("append").parquet(path)


def write_coded(coded: DataFrame, path: str, batch_size: int | None = None) -> None:
    """Append coded documents; files hold at most ``batch_size`` of them."""
    writer = coded.write.mode("append")
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.parquet(path)


def insert_phrases(phrases: DataFrame, path: str) -> None:
    """Append ``doc_id, phrases`` documents as JSON."""
    phrases.select("doc_id", "phrases").write.mode("append").json(path)


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write one batch to its own directory; a retried batch replaces itself."""
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
