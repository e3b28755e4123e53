"""Articles out of corpus markup, and the story records built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import identifiers, markup, text

ARTICLE_COLUMNS = (
    "article_title", "dateline", "article_body", "doc_id", "publication_date",
    "news_source", "language", "doc_type", "word_count", "type",
)
STORY_COLUMNS = (
    "news_source", "article_title", "publication_date", "article_body",
    "stanford", "language", "doc_id", "word_count", "dateline", "type",
)

# Everything outside the characters of XML 1.0.
NOT_XML = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def decode_ids(df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add language, source, date and ``reject_reason`` read from the document id."""
    c = F.col(doc_id)
    return df.withColumns({
        "language": identifiers.language(c),
        "news_source": identifiers.news_source(c),
        "publication_date": identifiers.publication_date(c),
        "reject_reason": identifiers.reject_reason(c),
    })


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())


def parse_articles(df: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per markup document with every article field and ``reject_reason``.

    Narrow: the markup is scanned once and never shuffled. The parsed fields pass
    a generator, so a filter on them cannot repeat the parsing below it.
    """
    fields = markup.read_fields(
        df, doc,
        elements={"article_title": "headline", "dateline": "dateline", "article_body": "text"},
        attributes={"doc_id": ("doc", "id"), "doc_type": ("doc", "type")},
    )
    parsed = ("article_title", "dateline", "article_body", "doc_id", "doc_type")
    others = [c for c in fields.columns if c not in parsed]
    fields = fields.select(*others, F.inline(F.array(F.struct(*parsed)))).withColumns({
        "type": F.col("doc_type"),
        "word_count": text.word_count(F.col("article_body")),
    })
    return decode_ids(fields)


def extract_articles(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Articles whose id decodes; the rest is ``quarantined(parse_articles(df))``."""
    return accepted(parse_articles(df, doc)).select(*ARTICLE_COLUMNS)


def story_record(articles: DataFrame, added: Column | None = None) -> DataFrame:
    """Stored form of an article: no ``doc_type``, plus bookkeeping columns.

    ``added`` is the clock column of a load, normally ``F.current_timestamp()``.
    """
    story = articles.withColumn("stanford", F.lit(0)).select(*STORY_COLUMNS)
    return story if added is None else story.withColumn("date_added", added)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, language attribute, article text and word count of web pages."""
    return markup.read_fields(
        pages, html,
        elements={"title": "title", "article_text": "article"},
        attributes={"language": ("html", "lang")},
    ).withColumn("word_count", text.word_count(F.col("article_text"))).drop(html)


def xml_image(stories: DataFrame, language: str = "ARB", key: str = "doc_key", extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the XML export: attributes carry an underscore, the text does not.

    A character that XML 1.0 cannot hold becomes U+FFFD. ``extra`` columns pass as they are.
    """
    def held(c: Column) -> Column:
        return F.regexp_replace(c, NOT_XML, "\uFFFD")

    return stories.where(F.col("language") == language).select(
        identifiers.format_yyyymmdd(F.col("publication_date")).alias("_date"),
        held(F.col("doc_id")).alias("_id"),
        held(F.col(key)).alias("_mongoId"),
        held(F.col("news_source")).alias("_source"),
        F.lit("true").alias("_sentence"),
        held(F.col("article_body")).alias("Text"),
        *extra,
    )


def count_by_language(stories: DataFrame) -> DataFrame:
    return stories.groupBy("language").agg(F.count("*").alias("n_stories"))
