"""Keyed maintenance of stored tables: look-back, merge, caps and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.functions import dates
from newsflow.operators.joins import join_unique
from newsflow.session import shared_folder

# Key lists up to this many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_KEYS = 100_000
# The histogram of a rank has about 2 to this power buckets.
BUCKET_BITS = 16


def recent_ids(stored: DataFrame, n: int, key: str = "doc_key", seq: str = "ingest_seq") -> DataFrame:
    """The ``n`` most recently stored keys, newest first (only two columns are read)."""
    return (
        stored.select(key, seq).orderBy(F.desc(seq), F.desc(key)).limit(n)
    )


def newest_first(stored: DataFrame, key: str = "doc_key", seq: str = "ingest_seq") -> DataFrame:
    """The whole store, newest first, with each row's place in that order as ``rank`` (from 1)."""
    order = [F.desc(seq), F.desc(key)]
    return ranked(stored, order).orderBy(*order)


def ranked(df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place in ``order`` (from 1) as ``name``, without a window over one task.

    The rows are range-partitioned by ``order`` and written once, so that the
    cut does not move between the two passes. Rows per partition are counted
    (one number per partition reaches the driver); a partition's offset is the
    sum of the counts before it, and a row's rank is that offset plus its place
    inside its partition, numbered by a window partitioned by the partition.
    Rows equal in ``order`` share a partition and get distinct ranks in an
    arbitrary but written order.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = materialised(
        df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = {r["_part"]: r["count"] for r in parts.groupBy("_part").count().collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    offset = spark.createDataFrame(offsets or [(0, 0)], "_part int, _offset bigint")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(offset), "_part").withColumn(name, F.col("_offset") + place).drop("_part", "_offset")


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark_processed(
    incoming: DataFrame, stored: DataFrame, n: int | None = None,
    key: str = "doc_key", seq: str = "ingest_seq",
) -> DataFrame:
    """Add ``skipped``: whether the key is among the last ``n`` stored (all when None)."""
    seen, small = _seen(stored, n, key, seq)
    seen = seen.withColumn("_seen", F.lit(True))
    joined = incoming.join(F.broadcast(seen), key, "left") if small else join_unique(incoming, seen, key, "left")
    return joined.withColumn("skipped", F.col("_seen").isNotNull()).drop("_seen")


def skip_processed(
    incoming: DataFrame, stored: DataFrame, n: int | None = None,
    key: str = "doc_key", seq: str = "ingest_seq",
) -> DataFrame:
    """Drop incoming rows whose key is among the last ``n`` stored (all when None)."""
    seen, small = _seen(stored, n, key, seq)
    if small:
        return incoming.join(F.broadcast(seen), key, "left_anti")
    return join_unique(incoming, seen, key, "left_anti")


def _seen(stored: DataFrame, n: int | None, key: str, seq: str) -> tuple[DataFrame, bool]:
    if n is None:
        return stored.select(key).distinct(), False
    return recent_ids(stored, n, key, seq).select(key).distinct(), n <= BROADCAST_KEYS


def latest_per_key(updates: DataFrame, value: str, key: str = "doc_key", seq: str = "ingest_seq") -> DataFrame:
    """One row per key holding its latest value; combined map-side, so a hot key is cheap."""
    return updates.groupBy(key).agg(F.max_by(value, seq).alias(value))


def merge_annotations(
    stories: DataFrame, updates: DataFrame, value: str = "corenlp_output",
    key: str = "doc_key", seq: str = "ingest_seq",
) -> DataFrame:
    """Set ``value`` on the stories an update matches.

    Unmatched updates change nothing, unmatched stories keep what they had. The
    update side is unique per key after the reduction, so story rows are neither
    multiplied nor lost, and a hot story key is spread over many tasks.
    """
    latest = latest_per_key(updates, value, key, seq).withColumnRenamed(value, "_new")
    old = F.col(value) if value in stories.columns else F.lit(None).cast("string")
    return join_unique(stories, latest, key, "left").withColumn(
        value, F.coalesce(F.col("_new"), old)
    ).drop("_new")


def write_back_date(stories: DataFrame, raw: str = "publication_date_raw", max_year: int | None = None) -> DataFrame:
    """Add ``date_int``: a keyed update of each row by itself is a derived column, not a join."""
    dated = dates.robust_date(stories, raw, "_date", max_year)
    return dated.withColumn("date_int", dates.date_int(F.col("_date"))).drop("_date")


def date_range(stories: DataFrame, date_int: str = "date_int") -> DataFrame:
    """Smallest and largest parsed date; sentinels when nothing parsed."""
    parsed = F.when(F.col(date_int) != 0, F.col(date_int))
    return stories.agg(
        F.coalesce(F.min(parsed), F.lit(dates.EMPTY_MIN).cast("bigint")).alias("min_date"),
        F.coalesce(F.max(parsed), F.lit(dates.EMPTY_MAX).cast("bigint")).alias("max_date"),
    )


def first_n(df: DataFrame, n: int, key: str = "doc_key") -> DataFrame:
    """The ``n`` first rows by key.

    The keys are chosen first on a one-column scan, so only the chosen rows ever
    carry their bodies into the single sorted partition.
    """
    chosen = df.select(F.col(key).alias("_chosen")).orderBy("_chosen").limit(n).distinct()
    chosen = F.broadcast(chosen) if n <= BROADCAST_KEYS else chosen
    # NULL keys sort first and count, so they must be found again too.
    return df.join(chosen, F.col(key).eqNullSafe(F.col("_chosen")), "left_semi").orderBy(key).limit(n)


def shuffle_rank(key: str = "doc_key", seed: int = 42) -> Column:
    """A reproducible random 64-bit rank of a key."""
    return F.xxhash64(F.col(key), F.lit(seed))


def capped_shuffle(
    df: DataFrame, n: int, rank: Column | None = None, key: str = "doc_key",
) -> DataFrame:
    """The first ``n`` rows of a random permutation, exactly.

    Sorting whole rows for a large cap would send ``n`` of them from every task
    to one. A histogram of the rank (its highest bits, about 65,536 buckets over
    the range that occurs) tells which buckets the first ``n`` rows can lie in; only
    those rows are sorted. Rows without a rank come first.
    """
    rank = shuffle_rank(key) if rank is None else rank
    ranked = df.withColumn("_rank", rank.cast("bigint"))
    low, high = ranked.agg(F.min("_rank"), F.max("_rank")).first()
    bits = max(0, (high - low).bit_length() - BUCKET_BITS) if low is not None else 0
    before_all = (low >> bits) - 1 if low is not None else 0
    bucket = F.coalesce(F.shiftright(F.col("_rank"), bits), F.lit(before_all))
    counts = ranked.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(_ordered("_bucket")) - F.col("_n")
    last = (
        counts.withColumn("_before", before)
        .where(F.col("_before") < n)
        .agg(F.max("_bucket"))
        .scalar()
    )
    return (
        ranked.where(bucket <= last)
        .orderBy("_rank", key).limit(n).drop("_rank")
    )


def _ordered(column: str):
    from pyspark.sql import Window

    return Window.orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
