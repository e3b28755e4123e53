"""A stored table kept in hash buckets of its key and updated in place, bucket by bucket.

The bulk keyed update sets a value on every stored row whose key an update
names. At scale rewriting the whole table for a few updates is the cost to
avoid, so the store is a Parquet folder partitioned by ``bucket = pmod(xxhash64(key), buckets)``:

* updates are reduced to one row per key on the map side, then routed to
  their buckets;
* only the touched buckets are read (partition pruning) and joined with the
  updates, which AQE broadcasts when small and splits when a key is hot;
* the rewritten buckets are written whole to a staging folder first, then
  swapped in by dynamic partition overwrite. A run that fails before the swap
  leaves the old store as it was; untouched buckets keep their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.maintain import latest_per_key
from newsflow.session import shared_folder

BUCKET = "bucket"
# Buckets of a store: the unit that an update rewrites.
BUCKETS = 64


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a key; NULL keys share one bucket and never match an update."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, key: str = "doc_key", buckets: int = BUCKETS) -> None:
    """Write ``df`` as a new store at ``path``; each task writes one file per bucket it holds, sorted by key."""
    df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).sortWithinPartitions(BUCKET, key) \
        .write.mode("errorifexists").partitionBy(BUCKET).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows, without the bucket."""
    return spark.read.parquet(path).drop(BUCKET)


def update(
    spark: SparkSession, path: str, updates: DataFrame, value: str,
    key: str = "doc_key", seq: str = "ingest_seq", buckets: int = BUCKETS,
) -> list[int]:
    """Set ``value`` on the stored rows whose key an update names; returns the buckets rewritten.

    Of several updates to one key the one with the largest ``seq`` wins. Updates
    without a stored row change nothing; NULL keys match nothing; stored rows
    repeated under one key all take the value. No update: nothing is written.
    """
    latest = latest_per_key(updates.where(F.col(key).isNotNull()), value, key, seq)
    routed = latest.select(bucket_of(F.col(key), buckets).alias(BUCKET), key, F.col(value).alias("_new"))
    # At most ``buckets`` numbers reach the driver.
    touched = sorted(r[BUCKET] for r in routed.select(BUCKET).distinct().collect())
    if not touched:
        return []
    stored = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
    merged = stored.join(routed, [BUCKET, key], "left").withColumn(
        value, F.coalesce(F.col("_new"), F.col(value))).drop("_new").select(*stored.columns)
    staging = shared_folder(spark, "store-staging")
    merged.sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(staging)
    spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(BUCKET).parquet(path)
    return touched
