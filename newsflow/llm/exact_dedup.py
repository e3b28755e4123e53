"""Exact deduplication by content hash with a comparison of the bytes.

Rows are grouped by the 128-bit hash of the normalised text and, inside a hash,
by the text itself, so that the grouping compares bytes and a hash collision
makes two groups. Copies collapse in the partial aggregation, before anything
is shuffled: a text that a third of all rows share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import text_or_empty

BLANK_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """NULL as empty; each run of the six ASCII blanks as one space."""
    return F.regexp_replace(text_or_empty(text), BLANK_RUN, " ")


def duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per document: ``<key>, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are; the smallest key of equal
    texts stays. NULL and empty texts are equal to each other. A NULL key is never
    the smallest unless its group has no other. Rows repeated with the same key
    and text are all marked as kept, since the key cannot tell them apart; they
    count in ``group_size``. An empty table gives no rows, other columns are not read.

    The whole text is shuffled once, by (hash, text). The second pass moves only
    digests; frequent ones are split by the adaptive skew join.
    """
    rows = docs.select(F.col(key).alias("_key"), normalised(F.col(text)).alias("_text"))
    groups = (
        rows.groupBy(digest(F.col("_text")).alias("_hash"), "_text")
        .agg(F.min("_key").alias("keep_id"), F.count("*").alias("group_size"))
        # Unlike texts of one hash differ in the second digest, which is taken after bytes were compared.
        .select("_hash", F.sha2("_text", 256).alias("_sha"), "keep_id", "group_size")
    )
    marks = rows.select("_key", digest(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("text_sha256"))
    same = (marks["_hash"] == groups["_hash"]) & (marks["text_sha256"] == groups["_sha"])
    return marks.join(groups, same).select(
        F.col("_key").alias(key), "keep_id", "group_size",
        F.col("_key").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: exactly one per distinct normalised text.

    Same grouping as ``duplicates``; the whole first row travels with its group, so no join follows.
    """
    columns = docs.columns
    rows = docs.select(
        normalised(F.col(text)).alias("_text"), F.struct(F.col(key).isNull(), F.col(key)).alias("_order"),
        # The text is rebuilt from the group's when blanks did not change it.
        F.struct(*[
            F.when(~F.col(c).eqNullSafe(normalised(F.col(text))), F.col(c)).alias(c) if c == text else F.col(c)
            for c in columns
        ]).alias("_row"),
        F.col(text).isNull().alias("_null"),
    )
    first = rows.groupBy(F.md5("_text").alias("_hash"), "_text").agg(
        F.min_by(F.struct("_row", "_null"), "_order").alias("_first"))
    return first.select(*[
        F.when(~F.col("_first._null"), F.coalesce(F.col("_first._row")[c], F.col("_text"))).alias(c) if c == text
        else F.col("_first._row")[c].alias(c)
        for c in columns
    ])
