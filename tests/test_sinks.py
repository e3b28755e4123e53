import glob
import json

from pyspark.sql import functions as F

from newsflow.operators import extract
from newsflow.sinks import documents, xml


def stories(spark, n, parts=1):
    return spark.range(0, n, 1, parts).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("doc_key"),
        F.concat(F.lit("SRC_ARB_"), F.col("id").cast("string")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "ARB").otherwise("ENG").alias("language"),
        F.lit("SRC").alias("news_source"), F.lit("1994-05-12").cast("date").alias("publication_date"),
        F.concat(F.lit('a <b> & "c"\n é '), F.col("id").cast("string")).alias("article_body"))


def test_xml_chunks_and_content(spark, tmp_path):
    df, path = stories(spark, 1240), str(tmp_path / "x")
    xml.write_articles(df, path, 200)
    files = sorted(glob.glob(f"{path}/*.xml"))
    counts = [open(f).read().count("<Article ") for f in files]
    assert sorted(counts, reverse=True) == [200, 200, 200, 20]
    first = open(files[0]).read()
    assert "<Articles>" in first and 'sentence="true"' in first and 'date="19940512"' in first
    back = xml.read_articles(spark, path)
    assert sorted(back.collect()) == sorted(extract.xml_image(df).collect())


def test_fewer_rows_than_a_batch_are_written(spark, tmp_path):
    xml.write_articles(stories(spark, 10), str(tmp_path / "x"), 200)
    assert xml.read_articles(spark, str(tmp_path / "x")).count() == 5


def test_first_articles_are_one_file(spark, tmp_path):
    path = str(tmp_path / "x")
    xml.write_first_articles(stories(spark, 1240, 8), path, n=50)
    assert len(glob.glob(f"{path}/*.xml")) == 1
    got = sorted(r._mongoId for r in xml.read_articles(spark, path).collect())
    assert got == [f"{i:05d}" for i in range(0, 100, 2)]


def test_coded_batches_bound_file_sizes(spark, tmp_path):
    path = str(tmp_path / "c")
    documents.write_coded(spark.range(0, 25, 1, 1).toDF("doc_id"), path, batch_size=10)
    assert len(glob.glob(f"{path}/*.parquet")) == 3
    documents.write_coded(spark.range(5).toDF("doc_id"), path)
    assert spark.read.parquet(path).count() == 30


def test_story_and_phrase_stores(spark, tmp_path):
    doc = '<DOC id="AFP_ENG_19940512.0001"><TEXT>x</TEXT></DOC>'
    articles = extract.extract_articles(spark.createDataFrame([(doc,)], "doc string"))
    documents.insert_stories(articles, str(tmp_path / "s"))
    documents.insert_stories(articles, str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 2 and stored.where("stanford = 0 AND date_added IS NOT NULL").count() == 2
    phrases = spark.createDataFrame([("d", "[]", "m")], "doc_id string, phrases string, mongo_id string")
    documents.insert_phrases(phrases, str(tmp_path / "p"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert [json.loads(line) for line in lines] == [{"doc_id": "d", "phrases": "[]"}]
