import datetime
import os

from pyspark.sql import functions as F

from newsflow.functions import markup, text
from newsflow.operators import extract
from newsflow.sources.corpus import read_corpus

GOOD = """<DOC id="AFP_ENG_19940512.0001" type='story'>
<HEADLINE>
Tom &amp; Jerry &#8211; &#x41;&unknown; a < b
</HEADLINE>
<DATELINE> PARIS, May 12 (AFP) </DATELINE>
<!-- <TEXT>hidden</TEXT> -->
<TEXT>
<P>First line.</P>
<P>Second &lt;line&gt;.</P>
</TEXT>
</DOC>"""
BARE = "<doc id=XIN_ARB_19950101.0002><text>only &amp;amp; text</doc>"
BAD = '<DOC id="bad"><TEXT>x</TEXT></DOC>'
NO_ID = "<DOC><TEXT>x</TEXT></DOC>"
BAD_DATE = '<DOC id="AFP_ENG_19941301.0001"><TEXT>x</TEXT></DOC>'


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def test_all_fields(spark):
    r = extract.extract_articles(docs(spark, GOOD)).first().asDict()
    assert r == {
        "article_title": "Tom & Jerry – A&unknown; a < b",
        "dateline": "PARIS, May 12 (AFP)",
        "article_body": "First line.\nSecond <line>.",
        "doc_id": "AFP_ENG_19940512.0001",
        "publication_date": datetime.date(1994, 5, 12),
        "news_source": "AFP", "language": "ENG", "doc_type": "story", "word_count": 4, "type": "story",
    }


def test_absent_elements_are_empty_and_references_decode_once(spark):
    r = extract.extract_articles(docs(spark, BARE)).first()
    assert (r.article_title, r.dateline, r.doc_type) == ("", "", "")
    assert r.article_body == "only &amp; text"
    assert (r.language, r.news_source) == ("ARB", "XIN")


def test_bad_ids_are_quarantined_and_the_rest_goes_on(spark):
    parsed = extract.parse_articles(docs(spark, BAD, GOOD, NO_ID, BAD_DATE, BARE))
    assert extract.accepted(parsed).count() == 2
    reasons = [r.reject_reason for r in extract.quarantined(parsed).orderBy("reject_reason").collect()]
    assert reasons == ["bad date", "no id", "no language"]


def test_story_has_no_doc_type_and_a_clock(spark):
    story = extract.story_record(extract.extract_articles(docs(spark, GOOD)), F.current_timestamp())
    assert "doc_type" not in story.columns and {"date_added", "stanford"} <= set(story.columns)
    assert len(story.columns) == 11


def test_character_references(spark):
    cases = {
        "a&amp;lt;b": "a&lt;b", "&AMP;&LT;&QUOT;": '&<"', "&#128512;": "\U0001f600", "&#xe9;&eacute;": "éé",
        "&#55296;&#0;&#1114112;": "&#55296;&#0;&#1114112;", "R&D; & co": "R&D; & co", "no refs": "no refs",
        "&nosemicolon": "&nosemicolon", "&#9999999;": "&#9999999;",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, want string")
    df = df.withColumn("got", markup.decode_references(F.col("raw")))
    assert df.where("NOT got <=> want").collect() == []


def test_whitespace_rules(spark):
    r = spark.range(1).select(
        text.strip(F.lit("\t\n a b \r\f\x0b")).alias("s"), text.word_count(F.lit(" a\tb\nc ")).alias("w"),
        text.word_count(F.lit("")).alias("w0"), text.byte_length(F.lit("é")).alias("b"),
    ).first()
    assert tuple(r) == ("a b", 3, 0, 2)


def test_corpus_folder_is_read_recursively(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    os.makedirs(deep)
    (tmp_path / "one.sgm").write_text("junk before\n" + GOOD + "\n" + BAD + "\ntail")
    (deep / "two.sgm").write_text(GOOD.replace(".0001", ".0009"))
    found = read_corpus(spark, str(tmp_path))
    assert found.count() == 3
    assert found.select("path").distinct().count() == 2
    ids = {r.doc_id for r in extract.extract_articles(found).collect()}
    assert ids == {"AFP_ENG_19940512.0001", "AFP_ENG_19940512.0009"}


def test_lower_case_corpus(spark, tmp_path):
    (tmp_path / "x.txt").write_text(BARE + BARE.replace("0002", "0003"))
    found = read_corpus(spark, str(tmp_path), end_tag="</doc>", partitions=3)
    assert found.rdd.getNumPartitions() == 3
    assert extract.extract_articles(found).count() == 2
