"""Explicit schemas of the records that cross a job boundary."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Extended JSON wraps object ids, dates and long numbers in one-field objects.
OBJECT_ID = T.StructType(_strings("$oid"))
EXTENDED_DATE = T.StructType(_strings("$date"))
LONG_NUMBER = T.StructType(_strings("$numberLong"))

CORRUPT = "_corrupt_record"

# The fields read from a queue message, a story in extended JSON. Producers spell
# them differently, so all are read as text; only broken JSON is corrupt. Both the
# date parsed at load time and the raw printed date are carried.
MESSAGE = T.StructType(
    _strings("_id", "doc_id", "article_body", "publication_date_raw", "publication_date", CORRUPT)
)

# An annotated document with its sentences as a real array.
SENTENCE = T.StructType([T.StructField("sen_id", T.IntegerType())] + _strings("sentence", "tree"))
ANNOTATED = T.StructType(
    _strings("doc_key", "doc_id", "date")
    + [T.StructField("sentences", T.ArrayType(SENTENCE))]
)

# The same document as stored: the sentences are JSON text with string ids.
SENTENCE_JSON = T.StructType(_strings("sen_id", "sentence", "tree"))
OUTPUT_JSON = T.StructType(
    _strings("doc_id") + [T.StructField("sentences", T.ArrayType(SENTENCE_JSON))]
)

# What a coder returns for one sentence.
STRINGS = T.ArrayType(T.StringType())
CODED_SENTENCE = T.StructType(
    [T.StructField("sen_id", T.IntegerType())]
    + _strings("sentence", "tree")
    + [
        T.StructField("nouns", STRINGS),
        T.StructField("noun_coding", STRINGS),
        T.StructField("verbs", T.StringType()),
        T.StructField("verb_coding", T.StringType()),
        T.StructField("events", T.ArrayType(STRINGS)),
        T.StructField("error", T.StringType()),
    ]
)
CODED = T.StructType(
    _strings("doc_key", "doc_id", "date")
    + [T.StructField("coded", T.ArrayType(CODED_SENTENCE))]
)

# Coder result as stored per sentence: {doc key: {"sents": {id: {...}}}}.
CODER_SENTENCE = T.StructType(
    _strings("content", "parsed") + [T.StructField("events", T.ArrayType(STRINGS))]
)
CODER_RESULT = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("sents", T.MapType(T.StringType(), CODER_SENTENCE))]),
)
MAIN_OUTPUT = T.StructType(_strings("main_output"))
