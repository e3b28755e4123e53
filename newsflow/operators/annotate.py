"""Sentence and token annotation, and the annotated-document store form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import text

Annotator = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _exploded(df: DataFrame, keep: tuple[str, ...], items: Column, name: str) -> DataFrame:
    # The outer form, then a filter: for the inner form the planner infers an
    # emptiness filter and computes the array a second time for it.
    rows = df.select(*keep, F.posexplode_outer(items).alias("_pos", name))
    return rows.where(F.col("_pos").isNotNull())


def split_sentences(df: DataFrame, *keep: str, body: str = "article_body") -> DataFrame:
    """One row per sentence with its 1-based ordinal. Narrow: no shuffle."""
    return _exploded(df, keep, text.sentences(F.col(body)), "sentence").select(*keep, (F.col("_pos") + 1).alias("sen_id"), "sentence")


def explode_tokens(sentences: DataFrame, *keep: str) -> DataFrame:
    """One row per token with its 1-based position in the sentence.

    Part-of-speech and entity tags belong to an external annotator and stay NULL.
    """
    return _exploded(sentences, keep, text.tokens(F.col("sentence")), "word").select(
        *keep, (F.col("_pos") + 1).alias("pos"), "word",
        F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("ne"),
    )


def annotate(documents: DataFrame, annotator: Annotator | None = None, trees: bool = True) -> DataFrame:
    """Documents (``doc_key, doc_id, date, article_body``) to annotated documents.

    Without an annotator the sentences are split by column expressions and carry
    a flat tree, or NULL without ``trees``. A given annotator receives Arrow batches of those four columns
    and yields batches of the annotated schema; it is created once per Python
    worker by its own generator. In both cases a document stays one row, so
    neither a shuffle nor a regrouping is needed.
    """
    docs = documents.select("doc_key", "doc_id", "date", "article_body")
    if annotator is not None:
        return docs.mapInPandas(annotator, schemas.ANNOTATED)
    built = F.transform(
        text.sentences(F.col("article_body")),
        lambda s, i: F.struct(
            (i + 1).alias("sen_id"),
            s.alias("sentence"),
            (text.flat_tree(text.tokens(s)) if trees else F.lit(None).cast("string")).alias("tree"),
        ),
    )
    return docs.select("doc_key", "doc_id", "date", built.alias("sentences"))


def to_stored(annotated: DataFrame) -> DataFrame:
    """The stored row ``id, date, output, mongo_id``; ordinals become strings in the JSON."""
    output = F.to_json(F.struct(
        "doc_id",
        F.transform("sentences", lambda s: F.struct(
            s["sen_id"].cast("string").alias("sen_id"),
            s["sentence"].alias("sentence"),
            s["tree"].alias("tree"),
        )).alias("sentences"),
    ))
    return annotated.select(
        F.col("doc_id").alias("id"), "date", output.alias("output"),
        F.col("doc_key").alias("mongo_id"),
    )


def from_stored(stored: DataFrame) -> DataFrame:
    """Inverse of ``to_stored``; reads only the four columns it needs."""
    return stored.select(
        F.col("mongo_id").alias("doc_key"),
        F.col("id").alias("doc_id"),
        "date",
        F.transform(
            F.from_json("output", schemas.OUTPUT_JSON)["sentences"],
            lambda s: F.struct(
                s["sen_id"].cast("int").alias("sen_id"),
                s["sentence"].alias("sentence"),
                s["tree"].alias("tree"),
            ),
        ).alias("sentences"),
    )


def explode_sentences(annotated: DataFrame) -> DataFrame:
    """One row per sentence of annotated documents."""
    rows = annotated.select("doc_key", "doc_id", "date", F.inline_outer("sentences"))
    return rows.where(F.col("sen_id").isNotNull())
