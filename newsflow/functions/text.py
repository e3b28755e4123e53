"""Whitespace, length, sentence and token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace means the ASCII blanks below, in every function of this module.
BLANKS = " \t\n\r\f\v"
NON_BLANK_RUN = r"[^ \t\n\r\f\x0B]+"
# A sentence ends after . ! or ? when blanks follow.
SENTENCE_BREAK = r"(?<=[.!?])[ \t\n\r\f\x0B]+"
# A token is a run of letters, marks and digits, or one other visible character.
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^ \t\n\r\f\x0B\p{L}\p{M}\p{N}]"


def strip(c: Column) -> Column:
    """Drop leading and trailing blanks (linear, unlike an anchored regex)."""
    return F.btrim(c, F.lit(BLANKS))


def word_count(c: Column) -> Column:
    """Number of blank-separated words."""
    return F.regexp_count(c, F.lit(NON_BLANK_RUN))


def byte_length(c: Column) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(c)


def sentences(body: Column) -> Column:
    """The sentences of a text as an array; an empty text has none."""
    parts = F.split(strip(F.coalesce(body, F.lit(""))), SENTENCE_BREAK)
    return F.filter(parts, lambda s: F.length(s) > 0)


def tokens(sentence: Column) -> Column:
    """The tokens of a sentence as an array, in order."""
    return F.regexp_extract_all(sentence, F.lit(TOKEN), F.lit(0))


def flat_tree(words: Column) -> Column:
    """A one-level bracketed tree over the tokens."""
    return F.concat(F.lit("(ROOT "), F.array_join(words, " "), F.lit(")"))
