"""Inputs that once lost rows or repeated work."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from newsflow import session
from newsflow.functions import markup, messages
from newsflow.operators import coding, extract, joins, maintain, monitor
from newsflow.plans import catalog
from newsflow.sinks import xml
from newsflow.sources.corpus import read_corpus


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_spelling_of_the_tags(spark, tmp_path):
    for name, end in (("a", "</DOC>"), ("b", "</doc>"), ("c", "</DOC >"), ("d", "")):
        text = "preamble\n" + "".join(f"<{'doc' if i % 2 else 'DOC'} id='{name}{i}'><TEXT>t</TEXT>{end}\n" for i in range(10))
        (tmp_path / f"{name}.sgml").write_text(text)
    docs = read_corpus(spark, str(tmp_path)).collect()
    assert sorted(re.search(r"id='(\w+)'", r.doc)[1] for r in docs) == sorted(f"{n}{i}" for n in "abcd" for i in range(10))
    assert all(r.doc.lower().rstrip(" >").endswith("</doc") for r in docs)


@pytest.mark.parametrize("date, wanted", [
    ('{"$date": "2010-03-05T00:00:00Z"}', "20100305"), ('{"$date": {"$numberLong": "1267747200000"}}', "20100305"),
    ('{"$date": 1267747200000}', "20100305"), ('"20100305"', "20100305"), ("1267747200000", "20100305"), ('"March 5, 2010"', "March 5, 2010"),
    ('"2010-03-05T23:30:00-02:00"', "20100306"), ("null", None),
])
def test_messages_in_every_form(spark, date, wanted):
    text = '{"_id": "k", "doc_id": "d", "article_body": "b", "word_count": 12.0, "stanford": "1", "publication_date": %s}' % date
    row = messages.decode(spark.createDataFrame([(text,)], "value string")).first()
    assert (row.error, row.doc_key, row.date) == (None, "k", wanted)


def test_a_message_is_parsed_once(spark):
    assert plan_of(catalog.decode_message(spark, SMALL)).count("from_json(StructField(_id") == 1


def test_articles_are_parsed_once(spark):
    for name in ("extract_articles", "quarantine_articles"):
        filters = [line for line in plan_of(catalog.QUERIES[name](spark, SMALL)).splitlines() if re.search(r"\bFilter ", line)]
        assert not any("<headline" in line.lower() or "<text" in line.lower() for line in filters)


def test_repeated_and_missing_sentence_ids(spark):
    docs = spark.createDataFrame(
        [("1", "d1", "20100101", [(1, "the cat", "t1"), (1, "of dogs", "t2"), (None, "no id", "t3")]), ("2", "d2", "20100101", [])],
        "doc_key string, doc_id string, date string, sentences array<struct<sen_id:int,sentence:string,tree:string>>")
    coded = {r.doc_key: r.coded for r in coding.code_documents(docs, catalog._dictionary(spark)).collect()}
    assert [s.sentence for s in coded["1"]] == ["the cat", "of dogs", "no id"] and coded["2"] == []
    assert [s.nouns for s in coded["1"]] == [["the"], ["of"], []]


def test_no_text_in_the_exchange_of_counts(spark):
    for name in ("sentence_outcomes", "first_event"):
        lines = [line for line in plan_of(catalog.QUERIES[name](spark, SMALL)).splitlines() if "ObjectHashAggregate" in line or "_head_" in line]
        assert lines and not any("_head_sentence" in line or "_head_tree" in line for line in lines)


def test_null_keys_and_ranks_stay(spark):
    df = spark.createDataFrame([(None if i < 3 else f"{i:03d}", i) for i in range(20)], "doc_key string, n bigint")
    assert maintain.first_n(df, 10).count() == 10
    rank = F.when(F.col("n") >= 8, F.col("n") * (1 << 55))
    got = [r.n for r in maintain.capped_shuffle(df, 12, rank).collect()]
    assert set(got[:8]) == set(range(8)) and got[8:] == [8, 9, 10, 11]
    assert maintain.capped_shuffle(df, 100, rank).count() == 20 and maintain.capped_shuffle(df.where("false"), 5).count() == 0


def test_characters_that_xml_cannot_hold(spark, tmp_path):
    story = spark.createDataFrame([("ARB", "x", "a\u0001b￾c"), ("ARB", "y", "plain")], "language string, doc_id string, article_body string").select(
        "*", F.lit("k").alias("doc_key"), F.lit("s").alias("news_source"), F.to_date(F.lit("2010-01-01")).alias("publication_date"))
    xml.write_articles(story, str(tmp_path / "x"), 10)
    assert {r.Text for r in xml.read_articles(spark, str(tmp_path / "x")).collect()} == {"a�b�c", "plain"}


def test_null_and_hot_keys_are_spread(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id").repartition(16)
    right = spark.createDataFrame([("hot", 1), ("4", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.join_unique(left, right, "k", "left", hot_rows=500)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / len(sizes) and len(sizes) == 8
        assert joined.where("v = 1").count() == 10_000 and joined.where("v = 2").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_running_totals_with_an_outlier(spark):
    df = spark.createDataFrame([(i, 1) for i in range(500)] + [(10**15, 1)], "b bigint, n bigint")
    got = {r.b: r.total for r in monitor.running_totals(df, "b", 16, total="n").collect()}
    assert got == {**{i: i + 1 for i in range(500)}, 10**15: 501}


def test_references_with_leading_zeros_and_old_numbers(spark):
    df = spark.createDataFrame([("&#0000000038; &#x00000026; &#150; &#x80;",)], "t string")
    assert df.select(markup.decode_references(F.col("t"))).first()[0] == "& & – €"


def test_scratch_needs_a_shared_parent_off_local():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        session.shared_folder(Session(), "x")
    assert extract.NOT_XML
