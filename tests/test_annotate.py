import json

import pandas as pd
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import messages
from newsflow.operators import annotate
from newsflow.sources.messages import read_messages
from newsflow.sinks import documents

BODY = "He said no.  She left!\nWhy? Mr. X went"


def document(spark, *bodies):
    rows = [(f"k{i}", f"d{i}", "20100305", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc_key string, doc_id string, date string, article_body string")


def test_sentences_and_tokens(spark):
    sentences = annotate.split_sentences(document(spark, BODY, "", None, "  "), "doc_key")
    rows = [(r.sen_id, r.sentence) for r in sentences.orderBy("sen_id").collect()]
    assert rows == [(1, "He said no."), (2, "She left!"), (3, "Why?"), (4, "Mr."), (5, "X went")]
    words = annotate.explode_tokens(sentences.where("sen_id = 1"), "doc_key", "sen_id")
    assert [(r.pos, r.word) for r in words.orderBy("pos").collect()] == [(1, "He"), (2, "said"), (3, "no"), (4, ".")]


def test_stored_form_round_trip(spark):
    annotated = annotate.annotate(document(spark, BODY, ""))
    stored = annotate.to_stored(annotated)
    assert stored.columns == ["id", "date", "output", "mongo_id"]
    output = json.loads(stored.where("id = 'd0'").first().output)
    assert output["doc_id"] == "d0" and output["sentences"][0] == {
        "sen_id": "1", "sentence": "He said no.", "tree": "(ROOT He said no .)"}
    back = annotate.from_stored(stored)
    assert sorted(back.collect()) == sorted(annotated.collect())
    assert back.where("doc_id = 'd1'").first().sentences == []
    assert annotate.explode_sentences(back).count() == 5


def test_exploding_then_reassembling_is_the_identity(spark):
    annotated = annotate.annotate(document(spark, BODY, "One. Two. Three."))
    regrouped = annotate.explode_sentences(annotated).groupBy("doc_key", "doc_id", "date").agg(
        F.array_sort(F.collect_list(F.struct("sen_id", "sentence", "tree"))).alias("sentences"))
    assert sorted(regrouped.collect()) == sorted(annotated.collect())


def test_annotator_hook(spark):
    def shout(batches):
        for batch in batches:
            yield pd.DataFrame({
                "doc_key": batch.doc_key, "doc_id": batch.doc_id, "date": batch.date,
                "sentences": [[{"sen_id": 1, "sentence": b.upper(), "tree": "(T)"}] for b in batch.article_body],
            })

    got = annotate.annotate(document(spark, "quiet"), shout)
    assert got.schema == schemas.ANNOTATED
    assert got.first().sentences[0].sentence == "QUIET"


def test_messages(spark):
    values = [
        '{"_id":{"$oid":"5a"},"doc_id":"D1","article_body":"x","publication_date_raw":"March 5, 2010","extra":1}',
        '{"doc_id":"D2","article_body":"y","publication_date":{"$date":1268000000000}}',
        '{"doc_id":"D3"', '{"article_body":"z"}', '{"doc_id":"D5"}', "",
    ]
    rows = messages.decode(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [(r.doc_key, r.date) for r in rows[:2]] == [("5a", "March 5, 2010"), ("D2", "20100307")]
    assert [r.error for r in rows] == [
        None, None, "malformed message", "no document id", "no article body", "malformed message"]
    assert rows[0].value == values[0]


def test_row_arrays_keep_nulls(spark):
    df = spark.createDataFrame([("a", None, '{"x":1}', "m")], "id string, date string, output string, mongo_id string")
    value = df.select(messages.row_message("id", "date", "output", "mongo_id").alias("v")).first().v
    assert json.loads(value) == ["a", None, '{"x":1}', "m"]


def test_publishing_sinks(spark, tmp_path):
    docs = document(spark, "one\ntwo", "three")
    documents.publish_stories(docs, str(tmp_path / "m"), key="doc_key")
    back = messages.decode(read_messages(spark, str(tmp_path / "m")))
    assert sorted((r.doc_key, r.article_body) for r in back.collect()) == [("k0", "one\ntwo"), ("k1", "three")]
    documents.publish_rows(annotate.to_stored(annotate.annotate(docs)), str(tmp_path / "r"))
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert sorted(r[3] for r in rows) == ["k0", "k1"]
