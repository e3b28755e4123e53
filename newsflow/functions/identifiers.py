"""Fields carried inside a publisher's document id, e.g. ``AFP_ENG_19940512.0001``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the id layout.
LANGUAGE = r"_([A-Z]{3})_"
NEWS_SOURCE = r"^([A-Z]{3})_"
DATE = r"_([0-9]{8})"


def _first(doc_id: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(doc_id, pattern, 1), F.lit(""))


def language(doc_id: Column) -> Column:
    return _first(doc_id, LANGUAGE)


def news_source(doc_id: Column) -> Column:
    return _first(doc_id, NEWS_SOURCE)


def parse_yyyymmdd(c: Column) -> Column:
    """An eight-digit date as DATE; an impossible one as NULL."""
    return F.try_to_timestamp(c, F.lit("yyyyMMdd")).cast("date")


def publication_date(doc_id: Column) -> Column:
    return parse_yyyymmdd(_first(doc_id, DATE))


def format_yyyymmdd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def reject_reason(doc_id: Column) -> Column:
    """Why a record must not be emitted; NULL for a well-formed id."""
    return (
        F.when(doc_id.isNull() | (doc_id == ""), F.lit("no id"))
        .when(language(doc_id).isNull(), F.lit("no language"))
        .when(news_source(doc_id).isNull(), F.lit("no source"))
        .when(_first(doc_id, DATE).isNull(), F.lit("no date"))
        .when(publication_date(doc_id).isNull(), F.lit("bad date"))
    )
