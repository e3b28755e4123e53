"""Joins of a large table with a key-unique one that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot, and each of its salts takes about so many.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more than ``rows`` rows and the salts each needs: ``key, _salts``.

    Counts are combined map-side on a one-column scan. There is at most one such
    key per ``rows`` rows of the table, so the result is small whatever its size.
    """
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > rows)
        .select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))
    )


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left.join(right, key, how)`` for a left or left-anti join; ``right`` is unique per key.

    Rows of a hot key are dealt over as many salts as its size asks for, and only
    for those keys the one right row is copied once per salt. Rows with a NULL key
    match nothing and are spread freely. All other keys join as they are, so the
    right side hardly grows.
    """
    hot = F.broadcast(hot_keys(left, key, hot_rows))
    # A number per row that a repeated task computes again: its content and partition.
    number = F.xxhash64(F.spark_partition_id(), *[c for c, kind in left.dtypes if not kind.startswith(("map", "variant"))])
    # It is read before any join can move the row.
    salted = left.withColumn("_number", number).join(hot, key, "left").withColumn(
        "_salt", F.when(F.col(key).isNull(), F.col("_number"))
        .when(F.col("_salts").isNotNull(), F.pmod("_number", F.col("_salts"))).otherwise(F.lit(0)))
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
    copies = right.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return salted.join(copies, [key, "_salt"], how).drop("_number", "_salts", "_salt")
