import pytest
from pyspark.sql import functions as F

from newsflow.functions import dates
from newsflow.operators import maintain

ROBUST = {
    "March 5, 2010": 20100305, "Tuesday, March 5, 2010": 20100305, "5 March 2010": 20100105,
    "March 5, 2017": 0, "garbage": 0, "Foo 12, 1999": 19990112, "12 13 1999": 19990113,
    "March April 2010": 0, "May 7, 20XX": 200507, "Tuesday March": 0,
    # Derived from the same rules: a day override, double blanks, long digit runs.
    "3rd 14 2001": 20010114, "March  5, 2010": 0, "June 123, 1999": 199906123,
    "June 1, 99999999999999999999": 0, "": 0, "March": 0, "march 5, 2010": 20100305,
    "Sunday 4 May 2003": 20030104,
}
SIMPLE = {
    "January 15, 2009": "20090115", "March 5, 2010": "2010035", "March 5 2010": "201003",
    "Foo 12, 1999": "19990112", "March 2010": None, "May  2010": "201005",
}


def test_robust(spark):
    df = spark.createDataFrame([(r,) for r in ROBUST] + [(None,)], "raw string")
    got = {r.raw: r.date_int for r in maintain.write_back_date(df, "raw", max_year=2016).collect()}
    assert got == {**ROBUST, None: 0}


def test_fixed_keeps_the_month_of_day_first_dates(spark):
    df = spark.createDataFrame([("5 March 2010",), ("March 5, 2017",), ("12 13 1999",)], "raw string")
    got = {r.raw: r.date for r in dates.robust_date_fixed(df, "raw").collect()}
    assert got == {"5 March 2010": "20100305", "March 5, 2017": "20170305", "12 13 1999": "19990113"}


@pytest.mark.parametrize("raw,expected", SIMPLE.items())
def test_simple(spark, raw, expected):
    df = spark.range(1).select(dates.simple_date(F.lit(raw)).alias("d"))
    assert df.first().d == expected


def test_range_and_its_sentinels(spark):
    df = spark.createDataFrame([("March 5, 2010",), ("garbage",), ("May 1, 1999",)], "publication_date_raw string")
    assert tuple(maintain.date_range(maintain.write_back_date(df)).first()) == (19990501, 20100305)
    none = maintain.write_back_date(df.where("publication_date_raw = 'garbage'"))
    assert tuple(maintain.date_range(none).first()) == (99999999, 0)
