"""Queue messages: stories as extended JSON, stored rows as JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow import schemas


DAY_MILLIS = 86_400_000


def _extended_date(c: Column, kind: str) -> Column:
    """A date or timestamp as ``{"$date": milliseconds since 1970 UTC}``."""
    if kind == "date":
        millis = F.unix_date(c).cast("bigint") * DAY_MILLIS
    else:
        millis = F.unix_millis(c.cast("timestamp"))
    return F.when(c.isNotNull(), F.struct(millis.alias("$date")))


def story_message(stories: DataFrame, key: str | None = None) -> Column:
    """One story as an extended-JSON object; ``key`` becomes ``_id.$oid``."""
    fields = []
    if key:
        fields.append(F.struct(F.col(key).alias("$oid")).alias("_id"))
    for field in stories.schema.fields:
        if field.name == key:
            continue
        c = F.col(field.name)
        kind = field.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = _extended_date(c, kind)
        fields.append(c.alias(field.name))
    return F.to_json(F.struct(*fields))


def row_message(*columns: str) -> Column:
    """A row as a JSON array; NULL stays ``null``."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def _unwrapped(c: Column, schema, name: str) -> Column:
    """The text inside a one-field object; any other text as it is."""
    inner = F.from_json(c, schema)[name]
    return F.when(F.ltrim(c).startswith("{"), inner).otherwise(c)


def _day(value: Column) -> Column:
    """Year + month + day of a date in any form: milliseconds, ISO text, or text kept as it is.

    ISO text without an offset is a UTC date.
    """
    millis = F.when(value.rlike("^-?[0-9]+$") & ~value.rlike("^[0-9]{8}$"), value.try_cast("bigint"))
    iso = value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    shifted = iso & value.rlike("[+-](?!00:?00$)[0-9]{2}:?[0-9]{2}$") & value.contains("T")
    instant = F.unix_millis(F.try_to_timestamp(value))
    utc = F.date_format(F.date_from_unix_date(
        F.floor(F.when(shifted, instant).otherwise(millis) / DAY_MILLIS).cast("int")), "yyyyMMdd")
    return F.coalesce(utc, F.when(iso, F.translate(F.substring(value, 1, 10), "-", "")), value)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages to documents, keeping the raw text and why a message is bad.

    ``doc_key`` is the object id, wrapped or plain, or the publisher's id for
    messages sent straight by a loader. The date is the printed one, or else the
    parsed one as yyyymmdd. Fields not needed are not looked at, and a number or
    text in place of another form is read as text: only broken JSON and a missing
    key or body make a message bad.
    """
    parsed = F.from_json(
        value, schemas.MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    # A filter on the result cannot cross a generator, so a message is parsed once.
    rows = messages.select("*", F.inline(F.array(F.struct(parsed.alias("_message")))))
    m = F.col("_message")
    wrapped = _unwrapped(m["publication_date"], schemas.EXTENDED_DATE, "$date")
    rows = rows.withColumn("_wrapped", wrapped)
    day = _day(_unwrapped(F.col("_wrapped"), schemas.LONG_NUMBER, "$numberLong"))
    key = F.coalesce(_unwrapped(m["_id"], schemas.OBJECT_ID, "$oid"), m["doc_id"])
    return rows.withColumns({
        "doc_key": key,
        "doc_id": m["doc_id"],
        "date": F.coalesce(m["publication_date_raw"], day),
        "article_body": m["article_body"],
    }).withColumn(
        "error", F.when(m.isNull() | m[schemas.CORRUPT].isNotNull(), F.lit("malformed message"))
        .when(F.col("doc_key").isNull(), F.lit("no document id"))
        .when(F.col("article_body").isNull(), F.lit("no article body")),
    ).drop("_message", "_wrapped")
