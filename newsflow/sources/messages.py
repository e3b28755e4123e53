"""Story messages as a batch table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Published messages, one JSON text per line, as ``value``."""
    return spark.read.text(path)


def stream_messages(
    spark: SparkSession, path: str | None = None, files_per_trigger: int | None = None,
    kafka: dict[str, str] | None = None, offsets_per_trigger: int | None = None, arrival: bool = False,
) -> DataFrame:
    """A stream of messages as ``value``: new files of a folder, or a Kafka topic.

    The per-trigger bounds play the part of the worker's batch size. With
    ``arrival``, a timestamp ``arrival`` is added: the record's time in Kafka,
    or the modification time of the file that brought the message.
    """
    if kafka is not None:
        reader = spark.readStream.format("kafka").options(**kafka)
        if offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
        loaded = reader.load()
        return loaded.select(F.col("value").cast("string").alias("value"), *(
            [F.col("timestamp").alias("arrival")] if arrival else []))
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    loaded = reader.load(path)
    return loaded.select("value", *([F.col("_metadata.file_modification_time").alias("arrival")] if arrival else []))
