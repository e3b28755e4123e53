"""The annotation worker as one restartable Structured Streaming job.

Layout below the output folder, one directory per micro-batch each:

    annotated/batch_id=<n>     annotated documents
    quarantine/batch_id=<n>    messages that could not be decoded, with the reason
    batch_stats/batch_id=<n>   one row of counters

Every directory is written with ``overwrite``. A batch that is replayed after a
crash between its write and its commit replaces itself, so the checkpointed
offsets and the idempotent writes together store each message once. An output
folder belongs to one checkpoint.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow import schemas
from newsflow.functions import messages, text
from newsflow.operators import annotate, maintain
from newsflow.sinks.documents import write_batch
from newsflow.sources.tables import spread

STORED_KEYS = "doc_key string, batch_id bigint"
STATS = (
    "threads int, batch_size bigint, docs_size bigint, sentences bigint, "
    "io_operations bigint, time_taken double"
)


def stream_annotate(
    incoming: DataFrame,
    out: str,
    checkpoint: str,
    annotator: annotate.Annotator | None = None,
    look_back: int | None = None,
    every: str | None = "60 seconds",
    expiry: str | None = None,
) -> StreamingQuery:
    """Annotate a stream of messages (``value``).

    Redeliveries are dropped in one of two ways. With ``expiry`` (a delay such
    as ``"1 day"``; the stream needs an ``arrival`` timestamp) the streaming
    state store remembers every key until the watermark of arrivals has passed
    it by ``expiry``; within that time a key is stored once, in whichever batch
    and order its copies come, and the state stays bounded by the keys of one
    expiry. Without it, a message whose key is among the ``look_back`` most
    recently stored documents is skipped; ``None``, the default, looks at the
    whole store. With ``every=None`` everything available is processed and the
    query ends; otherwise a micro-batch starts at that interval.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        _process(batch.select("value"), batch_id, out, annotator, None if expiry else look_back, expiry is None)

    if expiry is not None:
        incoming = first_deliveries(incoming, expiry)
    writer = incoming.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def first_deliveries(incoming: DataFrame, expiry: str) -> DataFrame:
    """The first delivery of each message key within ``expiry`` of the watermark of arrivals.

    The key is the document's; a message without one is known by its text, so
    that a bad message sent twice is quarantined once.
    """
    key = messages.decode(incoming).select(
        "value", "arrival", F.coalesce(F.col("doc_key"), F.sha2(F.col("value"), 256)).alias("_delivery"))
    return key.withWatermark("arrival", expiry).dropDuplicatesWithinWatermark(["_delivery"])


def _process(
    batch: DataFrame, batch_id: int, out: str,
    annotator: annotate.Annotator | None, look_back: int | None, look: bool = True,
) -> None:
    started = time.monotonic()
    spark = batch.sparkSession
    decoded = messages.decode(spread(batch)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_batch(
            decoded.where(F.col("error").isNotNull()).select("value", "error"),
            f"{out}/quarantine", batch_id,
        )
        good = decoded.where(F.col("error").isNull())
        stored = _recently_stored(spark, f"{out}/annotated", batch_id, look_back) if look else None
        fresh = good if stored is None else maintain.skip_processed(good, stored, look_back, seq="batch_id")
        write_batch(annotate.annotate(fresh, annotator), f"{out}/annotated", batch_id)
        written = spark.read.schema(schemas.ANNOTATED).parquet(f"{out}/annotated/batch_id={batch_id}")
        stats = _stats(good, written, time.monotonic() - started)
        write_batch(stats, f"{out}/batch_stats", batch_id)
    finally:
        decoded.unpersist()


def _stats(good: DataFrame, written: DataFrame, seconds: float) -> DataFrame:
    """One row: bytes of all decoded messages, documents and sentences of the stored ones."""
    spark = good.sparkSession
    size = good.agg(F.coalesce(F.sum(text.byte_length(F.col("article_body"))), F.lit(0))).first()[0]
    stored = written.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.size("sentences")), F.lit(0)).alias("sentences")
    ).first()
    threads = spark.sparkContext.defaultParallelism
    return spark.createDataFrame(
        [(threads, stored["n"], size, stored["sentences"], stored["n"], seconds)], STATS
    ).coalesce(1)


def _recently_stored(spark: SparkSession, folder: str, batch_id: int, look_back: int | None) -> DataFrame | None:
    """Keys stored by other batches, reaching back just far enough.

    The directory of the batch itself is never read: a batch retried after its
    write would otherwise find its own rows and replace them with nothing.
    """
    if look_back is None:
        stored = _read_keys(spark, folder, None)
        return None if stored is None else stored.where(F.col("batch_id") != batch_id)
    reach = 1
    while batch_id > 0:
        first = max(0, batch_id - reach)
        stored = _read_keys(spark, folder, range(first, batch_id))
        if stored is None:
            # Older directories were moved away: read what is left.
            everything = _read_keys(spark, folder, None)
            return None if everything is None else everything.where(F.col("batch_id") < batch_id)
        if first == 0 or stored.count() >= look_back:
            return stored
        reach *= 2
    return None


def _read_keys(spark: SparkSession, folder: str, batches: range | None) -> DataFrame | None:
    paths = [folder] if batches is None else [f"{folder}/batch_id={b}" for b in batches]
    try:
        return spark.read.schema(STORED_KEYS).option("basePath", folder).parquet(*paths)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_annotated(spark: SparkSession, out: str) -> DataFrame:
    """Everything the job has stored, with its batch."""
    schema = schemas.ANNOTATED.jsonValue()
    schema["fields"].append({"name": "batch_id", "type": "long", "nullable": True, "metadata": {}})
    return spark.read.schema(type(schemas.ANNOTATED).fromJson(schema)).parquet(f"{out}/annotated")


def read_batch_stats(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"batch_id bigint, {STATS}").parquet(f"{out}/batch_stats")


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("value string, error string, batch_id bigint").parquet(f"{out}/quarantine")
