"""Printed-date normalisation in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month names in calendar order, English weekday names.
MONTHS = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY",
    "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
)
WEEKDAYS = ("SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY")

UNPARSEABLE = "-1"
EMPTY_MIN = 99999999
EMPTY_MAX = 0


def month_number(name: Column) -> Column:
    """Two-digit month of a full English name; anything else counts as 01."""
    position = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.upper(name))
    return F.when(position > 0, F.lpad(position.cast("string"), 2, "0")).otherwise(F.lit("01"))


def simple_date(raw: Column) -> Column:
    """``Month d, yyyy`` to year + month + day without padding the day.

    The last character of the second word is dropped whatever it is. Fewer than
    three words give NULL.
    """
    words = F.split(raw, " ")
    day = F.get(words, F.lit(1))
    return F.concat(
        F.get(words, F.lit(2)),
        month_number(F.get(words, F.lit(0))),
        F.substring(day, F.lit(1), F.length(day) - 1),
    )


def _alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]+", "")


def robust_date(df: DataFrame, raw: str, name: str = "date", max_year: int | None = 2016) -> DataFrame:
    """Add the tolerant normalisation to year + month + day; failures give ``-1``.

    The month is always read from the first word, so a day-first date comes out
    as January. ``robust_date_fixed`` is the corrected reading.
    """
    return _normalised(df, raw, name, F.col("_first"), max_year)


def robust_date_fixed(df: DataFrame, raw: str, name: str = "date", max_year: int | None = None) -> DataFrame:
    """As ``robust_date`` but day-first dates keep their month and years are not capped."""
    day_first = F.col("_first").rlike("[0-9]") & ~F.col("_second").rlike("[0-9]")
    month_word = F.when(day_first, F.col("_second")).otherwise(F.col("_first"))
    return _normalised(df, raw, name, month_word, max_year)


def _normalised(df: DataFrame, raw: str, name: str, month_word: Column, max_year: int | None) -> DataFrame:
    # One projection per step: each step names what the next one uses repeatedly,
    # so no expression is expanded twice and the generated code stays small.
    words = F.split(raw, " ")
    first, second, third = (F.col(c) for c in ("_first", "_second", "_third"))
    day, year = F.col("_day"), F.col("_year")
    # A leading weekday moves behind the other words.
    turned = F.when(
        F.upper("_head").isin(*WEEKDAYS), F.concat("_tail", F.array("_head"))
    ).otherwise(F.concat(F.array("_head"), "_tail"))
    steps = [
        {"_words": words},
        {"_head": _alphanumeric(F.get("_words", F.lit(0))), "_tail": F.slice("_words", F.lit(2), F.size("_words"))},
        {"_turned": turned},
        {c: F.get("_turned", F.lit(i)) for i, c in enumerate(("_first", "_second", "_third"))},
        {
            "_day": F.regexp_extract(
                F.when(second.rlike("[0-9]"), second).when(first.rlike("[0-9]"), first), "[0-9]+", 0),
            "_year": F.regexp_extract(third, "[0-9]+", 0),
            "_month": F.upper(_alphanumeric(month_word)),
        },
    ]
    for step in steps:
        df = df.withColumns(step)
    parsed = second.isNotNull() & (day != "") & (year != "")
    if max_year is not None:
        # A digit run too long for a number is later than any year.
        parsed = parsed & F.coalesce(year.try_cast("bigint") <= max_year, F.lit(False))
    padded = F.when(F.length(day) < 2, F.concat(F.lit("0"), day)).otherwise(day)
    result = F.when(parsed, F.concat(year, month_number(F.col("_month")), padded))
    used = [c for step in steps for c in step]
    return df.withColumn(name, F.coalesce(result, F.lit(UNPARSEABLE))).drop(*used)


def date_int(normalised: Column) -> Column:
    """The normalised date as a number, 0 when it could not be parsed."""
    number = F.when(normalised != UNPARSEABLE, normalised.try_cast("bigint"))
    return F.coalesce(number, F.lit(0).cast("bigint"))
