"""Per-batch statistics, averages and running progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import text


def batch_stats(
    documents: DataFrame, batch: str = "batch_id", body: str = "article_body",
    sentences: str | None = None, skipped: str | None = None,
) -> DataFrame:
    """One row per batch: documents, body bytes, sentences and stored rows.

    Bytes count every delivered document; documents, sentences and stored rows
    leave out the skipped duplicates.
    """
    done = ~F.col(skipped) if skipped else F.lit(True)
    n_sentences = F.size(sentences) if sentences else F.size(text.sentences(F.col(body)))
    return documents.groupBy(batch).agg(
        F.count_if(done).alias("batch_size"),
        F.sum(text.byte_length(F.coalesce(F.col(body), F.lit("")))).alias("docs_size"),
        F.coalesce(F.sum(F.when(done, n_sentences)), F.lit(0)).alias("sentences"),
        F.count_if(done).alias("io_operations"),
    )


def batch_averages(stats: DataFrame, size: str = "data_size", time: str = "batch_time") -> DataFrame:
    """Rounded averages over the batches."""
    return stats.agg(
        F.round(F.avg(size)).alias("avg_size"), F.round(F.avg(time)).alias("avg_time")
    )


def running_totals(df: DataFrame, order: str, buckets: int = 1024, **totals: str) -> DataFrame:
    """Running sums along an integer column, without a one-task window.

    ``totals`` maps a new column to the column it accumulates. The rows are cut
    into at most ``buckets`` slices of about equal size at quantiles of the values;
    each slice is a window partition of its own, and what precedes a slice comes
    from one row per slice.
    """
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = sorted(set(df.agg(F.percentile_approx(order, shares, F.lit(10 * buckets))).first()[0] or []))
    # Rows without a value sort first, so they form the slice before all others.
    before = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c < F.col(order)))
    slice_no = F.when(F.col(order).isNull(), F.lit(-1)).otherwise(before)
    sliced = df.withColumn("_slice", slice_no)
    per_slice = sliced.groupBy("_slice").agg(
        *[F.sum(source).alias(f"_sum_{name}") for name, source in totals.items()]
    )
    so_far = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select("_slice", *[
        F.coalesce(F.sum(f"_sum_{name}").over(so_far), F.lit(0)).alias(f"_before_{name}")
        for name in totals
    ])
    inside = (
        Window.partitionBy("_slice").orderBy(order)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(F.broadcast(offsets), "_slice").withColumns({
        name: F.col(f"_before_{name}") + F.sum(source).over(inside)
        for name, source in totals.items()
    }).drop("_slice", *[f"_before_{name}" for name in totals])


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def progress(documents: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: rows in it, total rows, inserted so far and remaining."""
    sizes = documents.groupBy(batch).agg(F.count("*").alias("batch_rows"))
    total = total_rows(documents).scalar()
    return (
        running_totals(sizes, batch, inserted_rows="batch_rows")
        .withColumn("total_rows", total)
        .withColumn("remaining_rows", F.col("total_rows") - F.col("inserted_rows"))
    )


def cumulative(stats: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batch statistics with the documents processed and the time taken so far."""
    return running_totals(stats, batch, total_docs="io_operations", total_time="time_taken")
