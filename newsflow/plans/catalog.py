"""Registered queries. Each reads the driver tables whole; nothing is sampled."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import dates, messages, text
from newsflow.operators import annotate, coding, extract, maintain, monitor, store
from newsflow.operators.joins import join_unique
from newsflow.session import shared_folder
from newsflow.sinks import documents, xml
from newsflow.sources.corpus import read_corpus
from newsflow.sources.messages import read_messages, stream_messages
from newsflow.sources.tables import spread, spread_stories, stories, stories_of, table
from newsflow.streaming import annotate as streaming

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, shared with their SQL twins.
RECENT = 200
LAST_YEAR = 2016
FIRST = 500
CAP = 500
EXPORT_LANGUAGE = "ENG"
XML_CHUNK = 300
# How long the stream remembers a delivered key.
REPLAY_EXPIRY = "1 day"
ACTORS = {
    "the": "DET", "of": "OFX", "and": "AND", "of the": "OFTHE", "and the": "ANDTHE",
    "in": "INX", "de": "DEX", "la": "LAX", "der": "DER", "die": "DIE", "de la": "DELA",
    "the the of": "LONG", "que": "QUE", "to": "TOX",
}
VERBS = {
    "is": "010", "was": "020", "are": "030", "be": "040", "to be": "041", "is a": "011",
    "est": "050", "ist": "060", "es": "070", "with": "080", "is the": "012",
}


# --- shared inputs -------------------------------------------------------------


def _phrase_tables(spark: SparkSession) -> list[DataFrame]:
    return [
        spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, d.items()))} AS t(phrase, code)")
        for d in (ACTORS, VERBS)
    ]


def _dictionary(spark: SparkSession) -> coding.Dictionary:
    return coding.load_dictionary(*_phrase_tables(spark))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.annotate(spread_stories(spark, sf_dir))


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.split_sentences(spread_stories(spark, sf_dir), "doc_key")


def _coded(spark: SparkSession, sf_dir: str, texts: tuple[str, ...] = ("sentence", "tree")) -> DataFrame:
    annotated = _annotated(spark, sf_dir) if "tree" in texts else annotate.annotate(spread_stories(spark, sf_dir), trees=False)
    return coding.code_documents(annotated, _dictionary(spark), texts)


def _printed(df: DataFrame) -> DataFrame:
    """Dates as text, which both engines print alike."""
    return df.withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd"))


def _escaped(c: Column) -> Column:
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c


def corpus_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stories printed as corpus documents, with the usual irregularities.

    German documents have no dateline and Spanish ones no type; short documents
    carry an id without a date, and quoting and tag case vary.
    """
    s = spread_stories(spark, sf_dir)
    doc_id = F.when(
        F.length("article_body") < 200, F.regexp_replace("doc_id", r"_[0-9]{8}", "_undated")
    ).otherwise(F.col("doc_id"))
    spanish, german = F.col("language") == "SPA", F.col("language") == "GER"
    doc = F.concat(
        F.when(spanish, F.concat(F.lit("<doc id='"), doc_id, F.lit("'>\n")))
        .otherwise(F.concat(F.lit('<DOC id="'), doc_id, F.lit('" type="story">\n'))),
        F.lit("<!-- <TEXT>no</TEXT> -->"),
        F.lit("<HEADLINE>\n"), F.lit("Q&AMP;A &#8211; "), F.col("news_source"), F.lit("\n</HEADLINE>\n"),
        F.when(german, F.lit("")).otherwise(F.concat(
            F.lit("<DATELINE> "), F.col("language"), F.lit(", &lt;"), F.col("date"), F.lit("&gt; </DATELINE>\n"))),
        F.lit("<TEXT>\n<P>\n"), _escaped(F.col("article_body")), F.lit("\n</P>\n</TEXT>\n</DOC>"),
    )
    return s.select("doc_key", doc.alias("doc"))


def printed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates printed in the shapes producers use, every order once."""
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    plain = F.date_format(d, "MMMM d, yyyy")
    shapes = {
        0: plain,
        1: F.concat(F.date_format(d, "EEEE"), F.lit(", "), plain),
        2: F.date_format(d, "d MMMM yyyy"),
        3: F.lit("garbage"),
        4: F.date_format(d, "MM dd yyyy"),
        5: F.concat(F.date_format(d, "MMMM d, "), F.lit("20"), F.date_format(d, "yy"), F.lit("XX")),
        6: F.date_format(d, "MMMM yyyy"),
        7: F.concat(F.lit("Foo "), F.date_format(d, "d, yyyy")),
    }
    raw = F.coalesce(*[F.when(F.pmod(key, F.lit(8)) == i, c) for i, c in shapes.items()])
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", raw.alias("publication_date_raw"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories as queue messages: wrapped ids, printed or parsed dates, some broken texts.

    Spanish stories come without an object id, German ones with a parsed date
    only, and short ones are cut off in the middle.
    """
    s = spread_stories(spark, sf_dir)
    key = F.when(F.col("language") != "SPA", F.struct(F.concat(F.lit("oid"), F.col("doc_key")).alias("$oid")))
    german = F.col("language") == "GER"
    millis = F.unix_date("publication_date").cast("bigint") * messages.DAY_MILLIS
    value = F.to_json(F.struct(
        key.alias("_id"), "doc_id", "article_body",
        F.when(~german, F.date_format("publication_date", "MMMM d, yyyy")).alias("publication_date_raw"),
        F.when(german, F.struct(millis.alias("$date"))).alias("publication_date"),
    ))
    broken = F.length("article_body") < 200
    return s.select(
        "ingest_seq",
        F.when(broken, F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value).alias("value"),
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents play the part of those already annotated."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("doc_key"), F.col("doc_id").alias("ingest_seq"),
        F.to_json(F.struct("quality", "toxic")).alias("corenlp_output"),
    )


# --- text and documents --------------------------------------------------------


def word_count(spark, sf_dir):
    return spread_stories(spark, sf_dir).select("doc_key", text.word_count(F.col("article_body")).alias("word_count"))


def byte_length(spark, sf_dir):
    return stories(spark, sf_dir).select("doc_key", text.byte_length(F.col("article_body")).alias("byte_length"))


def language_stats(spark, sf_dir):
    """Flagship: per language documents, sentences, words and bytes in one pass."""
    body = F.col("article_body")
    return spread_stories(spark, sf_dir).groupBy("language").agg(
        F.count("*").alias("documents"),
        F.sum(F.size(text.sentences(body))).alias("sentences"),
        F.sum(text.word_count(body)).alias("words"),
        F.sum(text.byte_length(body)).alias("bytes"),
    )


def _ids(spark, sf_dir):
    s = spread_stories(spark, sf_dir)
    # Publisher codes are three letters; the last digit of a source number makes
    # some malformed, and documents of some lengths carry impossible dates.
    source = F.concat(F.lit("SR"), F.translate(F.substring("news_source", -1, 1), "0123456789", "ABCDEFGh8_"))
    date = F.when(F.length("article_body") % 10 == 0, F.lit("19941332")).otherwise(F.col("date"))
    lang = F.when(F.length("article_body") % 10 == 1, F.lower("language")).otherwise(F.col("language"))
    return s.select("doc_key", F.concat(source, F.lit("_"), lang, F.lit("_"), date, F.lit(".0001")).alias("doc_id"))


def decode_doc_id(spark, sf_dir):
    return _printed(extract.accepted(extract.decode_ids(_ids(spark, sf_dir))))


def quarantine_bad_ids(spark, sf_dir):
    return extract.quarantined(extract.decode_ids(_ids(spark, sf_dir))).select(
        "doc_key", "doc_id", "reject_reason"
    )


def extract_articles(spark, sf_dir):
    return _printed(extract.extract_articles(corpus_markup(spark, sf_dir)))


def quarantine_articles(spark, sf_dir):
    return extract.quarantined(extract.parse_articles(corpus_markup(spark, sf_dir))).select(
        "doc_key", "doc_id", "reject_reason"
    )


def extract_pages(spark, sf_dir):
    return extract.extract_pages(spread(table(spark, sf_dir, "pages")))


def story_record(spark, sf_dir):
    articles = extract.extract_articles(corpus_markup(spark, sf_dir))
    return _printed(extract.story_record(articles))


def count_by_language(spark, sf_dir):
    return extract.count_by_language(stories(spark, sf_dir))


def xml_articles(spark, sf_dir):
    return extract.xml_image(stories(spark, sf_dir), EXPORT_LANGUAGE)


def xml_first_n(spark, sf_dir):
    s = stories(spark, sf_dir).where(F.col("language") == EXPORT_LANGUAGE)
    return extract.xml_image(maintain.first_n(s, FIRST, "ingest_seq"), EXPORT_LANGUAGE)


# --- dates ---------------------------------------------------------------------


def date_simple(spark, sf_dir):
    raw = F.col("publication_date_raw")
    return printed_dates(spark, sf_dir).withColumn("date", dates.simple_date(raw))


def date_robust(spark, sf_dir):
    return dates.robust_date(printed_dates(spark, sf_dir), "publication_date_raw")


def date_robust_fixed(spark, sf_dir):
    return dates.robust_date_fixed(printed_dates(spark, sf_dir), "publication_date_raw")


def date_int_writeback(spark, sf_dir):
    return maintain.write_back_date(printed_dates(spark, sf_dir), max_year=LAST_YEAR)


def date_range(spark, sf_dir):
    return maintain.date_range(maintain.write_back_date(printed_dates(spark, sf_dir), max_year=LAST_YEAR))


# --- messages ------------------------------------------------------------------


def publish_json(spark, sf_dir):
    s = stories(spark, sf_dir).select(
        "doc_key", "doc_id", "language", "news_source", "publication_date", "article_body"
    )
    return s.select("doc_key", messages.story_message(s, key="doc_key").alias("value"))


def publish_row_array(spark, sf_dir):
    stored = annotate.to_stored(_annotated(spark, sf_dir))
    return stored.select(messages.row_message("id", "date", "output", "mongo_id").alias("value"))


def decode_message(spark, sf_dir):
    decoded = messages.decode(_messages(spark, sf_dir))
    return decoded.where(F.col("error").isNull()).select("ingest_seq", "doc_key", "doc_id", "date", "article_body")


def quarantine_messages(spark, sf_dir):
    decoded = messages.decode(_messages(spark, sf_dir))
    return decoded.where(F.col("error").isNotNull()).select("ingest_seq", "error")


# --- annotation ----------------------------------------------------------------


def split_sentences(spark, sf_dir):
    return _sentences(spark, sf_dir)


def split_turns(spark, sf_dir):
    turns = spread(table(spark, sf_dir, "conversations"))
    return annotate.split_sentences(turns, "conv_id", "turn", body="text")


def tokens(spark, sf_dir):
    return annotate.explode_tokens(_sentences(spark, sf_dir), "doc_key", "sen_id")


def annotated_documents(spark, sf_dir):
    return annotate.to_stored(_annotated(spark, sf_dir))


def explode_sentences(spark, sf_dir):
    stored = annotate.to_stored(_annotated(spark, sf_dir))
    return annotate.explode_sentences(annotate.from_stored(stored))


# --- coding --------------------------------------------------------------------


def code_actors(spark, sf_dir):
    return coding.dictionary_hits(_sentences(spark, sf_dir), _dictionary(spark), "actor", "doc_key", "sen_id")


def code_verbs(spark, sf_dir):
    return coding.dictionary_hits(_sentences(spark, sf_dir), _dictionary(spark), "verb", "doc_key", "sen_id")


def phrases_by_doc(spark, sf_dir):
    return coding.phrases_by_doc(_coded(spark, sf_dir, ("sentence",)))


def phrases_by_sentence(spark, sf_dir):
    rows = coding.explode_phrases(coding.phrases_by_sentence(_coded(spark, sf_dir, ("sentence",))))
    return rows.withColumns({
        c: F.array_join(c, "|") for c in ("nouns", "noun_coding")
    })


def sentence_outcomes(spark, sf_dir):
    return coding.sentence_outcomes(_coded(spark, sf_dir, ()))


def first_event(spark, sf_dir):
    return coding.first_event(_coded(spark, sf_dir, ()))


def flatten_events(spark, sf_dir):
    flat = coding.flatten_events(coding.events_by_doc(_coded(spark, sf_dir)))
    joined = F.array_join(F.transform("events", lambda e: F.array_join(e, ">")), "|")
    return flat.withColumn("events", joined)


def code_actors_large(spark, sf_dir):
    """``code_actors`` by the look-up for dictionaries too large to broadcast."""
    large = coding.load_dictionary(*_phrase_tables(spark), max_rows=0)
    return coding.dictionary_hits(_sentences(spark, sf_dir), large, "actor", "doc_key", "sen_id")


def annotate_hook(spark, sf_dir):
    """A user's annotator over batches: every line is a sentence."""
    def lines(batches):
        for batch in batches:
            sentences = [
                [{"sen_id": i + 1, "sentence": line, "tree": None} for i, line in enumerate(body.split("\n"))]
                for body in batch["article_body"]
            ]
            yield batch[["doc_key", "doc_id", "date"]].assign(sentences=sentences)

    annotated = annotate.annotate(spread_stories(spark, sf_dir), lines)
    return annotate.explode_sentences(annotated).select("doc_key", "sen_id", "sentence")


def code_hook(spark, sf_dir):
    """A user's coder that fails on every sentence of an odd length; its document goes on.

    The documents carry printed dates; the coder is given the normalised one.
    """
    def code(sentence, tree, date):
        if len(sentence) % 2:
            raise ValueError("odd length")
        return {"verbs": date, "verb_coding": str(len(sentence))}

    documents = _annotated(spark, sf_dir).withColumn(
        "date", F.date_format(F.to_date("date", "yyyyMMdd"), "MMMM d, yyyy"))
    coded = coding.code_with(documents, coding.per_sentence_coder(code))
    s = F.col("s")
    return coded.select("doc_key", F.explode("coded").alias("s")).select(
        "doc_key", s["sen_id"].alias("sen_id"), s["verbs"].alias("date"), s["verb_coding"].alias("code"), s["error"].alias("error"))


def stored_events_meta(spark, sf_dir):
    """The stored coder results: how many each document has, and the date in their ``meta``."""
    stored = coding.events_by_doc(_coded(spark, sf_dir))
    # A projection of its own: the texts are parsed once.
    parsed = F.from_json(F.from_json("output", schemas.MAIN_OUTPUT)["main_output"], schemas.STRINGS)
    results = F.col("_results")
    dates_of = F.array_distinct(F.transform(results, lambda r: F.regexp_extract(r, r'"meta":\{"date":"([^"]*)"\}', 1)))
    return stored.select("mongo_id", parsed.alias("_results")).select("mongo_id", F.size(results).alias("results"), F.array_join(dates_of, ",").alias("dates"))


def noun_pairs(spark, sf_dir):
    """Actors as (phrase, code) pairs, turned into two arrays."""
    pairs = code_actors(spark, sf_dir).groupBy("doc_key", "sen_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("start", F.array("phrase", "code").alias("pair")))),
                    lambda x: x["pair"]).alias("pairs"))
    nouns, codes = coding.noun_arrays(F.col("pairs"))
    return pairs.select("doc_key", "sen_id", F.array_join(nouns, "|").alias("nouns"), F.array_join(codes, "|").alias("noun_coding"))


# --- maintenance ---------------------------------------------------------------


def newest_first(spark, sf_dir):
    """The store, newest first; the rank of each row is its place in that order."""
    return maintain.newest_first(_stored(spark, sf_dir))


def merge_hot(spark, sf_dir):
    """A third of the stories under one key and some under none; old values are kept where no update matches."""
    n = F.col("ingest_seq")
    s = stories(spark, sf_dir).select(
        F.when(n % 3 == 0, F.lit("1")).when(n % 7 != 0, F.col("doc_key")).alias("doc_key"), "ingest_seq",
        F.when(n % 2 == 0, F.lit("old")).alias("corenlp_output"))
    latest = maintain.latest_per_key(_stored(spark, sf_dir), "corenlp_output").withColumnRenamed("corenlp_output", "_new")
    joined = join_unique(s, latest, "doc_key", "left", hot_rows=50)
    return joined.withColumn("corenlp_output", F.coalesce("_new", "corenlp_output")).drop("_new")


def recent_ids(spark, sf_dir):
    return maintain.recent_ids(_stored(spark, sf_dir), RECENT)


def skip_processed(spark, sf_dir):
    s = stories(spark, sf_dir).select("doc_key", "doc_id", "date", "article_body")
    return maintain.skip_processed(s, _stored(spark, sf_dir), RECENT)


def skip_all_processed(spark, sf_dir):
    s = stories(spark, sf_dir).select("doc_key", "doc_id", "date", "article_body")
    return maintain.skip_processed(s, _stored(spark, sf_dir))


def merge_annotations(spark, sf_dir):
    s = stories(spark, sf_dir).select("doc_key", "doc_id", "article_body")
    return maintain.merge_annotations(s, _stored(spark, sf_dir))


def merge_stored(spark, sf_dir):
    """The stories kept as a bucketed store and updated in place twice: even sequence numbers, then all."""
    path = shared_folder(spark, "store")
    s = stories(spark, sf_dir).select(
        "doc_key", "doc_id", "article_body", F.lit(None).cast("string").alias("corenlp_output"))
    store.create(s, path)
    updates = _stored(spark, sf_dir)
    store.update(spark, path, updates.where("ingest_seq % 2 = 0"), "corenlp_output")
    store.update(spark, path, updates, "corenlp_output")
    return store.read(spark, path).select("doc_key", "doc_id", "article_body", "corenlp_output")


def shuffled_cap(spark, sf_dir):
    s = stories(spark, sf_dir).select("ingest_seq", "doc_id", "article_body")
    rank = F.pmod(F.col("ingest_seq") * 7919, F.lit(10007))
    return maintain.capped_shuffle(s, CAP, rank, "ingest_seq")


# --- monitoring ----------------------------------------------------------------


def batch_stats(spark, sf_dir):
    marked = maintain.mark_processed(spread_stories(spark, sf_dir), _stored(spark, sf_dir), RECENT)
    stats = monitor.batch_stats(marked, skipped="skipped")
    return monitor.running_totals(stats, "batch_id", total_docs_processed="io_operations")


def batch_averages(spark, sf_dir):
    batches = (
        table(spark, sf_dir, "events")
        .withColumn("batch_id", F.floor(F.col("event_id") / 100))
        .groupBy("batch_id")
        .agg(
            F.sum(F.octet_length("props")).alias("data_size"),
            F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("batch_time"),
        )
    )
    return monitor.batch_averages(batches)


def progress(spark, sf_dir):
    return monitor.progress(stories(spark, sf_dir))


# --- sources, sinks and the streaming job --------------------------------------


def corpus_files(spark, sf_dir):
    """Print the corpus to files, then read and extract it from there."""
    folder = shared_folder(spark, "corpus")
    corpus_markup(spark, sf_dir).select("doc").write.text(f"{folder}/part-a")
    return _printed(extract.extract_articles(read_corpus(spark, folder)))


def corpus_spellings(spark, sf_dir):
    """As ``corpus_files``, with end tags spelt in three ways."""
    folder = shared_folder(spark, "spellings")
    n = F.crc32("doc_key") % 3
    tag = F.when(n == 0, F.lit("</DOC>")).when(n == 1, F.lit("</doc>")).otherwise(F.lit("</Doc >"))
    corpus_markup(spark, sf_dir).select(F.replace("doc", F.lit("</DOC>"), tag)).write.text(folder)
    return _printed(extract.extract_articles(read_corpus(spark, folder)))


def message_dialects(spark, sf_dir):
    """Messages with the date and the optional fields in the forms producers use."""
    s = spread_stories(spark, sf_dir)
    n = F.col("ingest_seq") % 5
    millis = (F.unix_date("publication_date").cast("bigint") * messages.DAY_MILLIS).cast("string")
    wrapped = lambda inner: F.concat(F.lit('{"$date":'), inner, F.lit("}"))
    iso = F.concat(F.lit('"'), F.date_format("publication_date", "yyyy-MM-dd"), F.lit('T00:00:00Z"'))
    form = (
        F.when(n == 0, wrapped(millis)).when(n == 1, wrapped(F.concat(F.lit('{"$numberLong":"'), millis, F.lit('"}'))))
        .when(n == 2, wrapped(iso)).when(n == 3, iso).otherwise(F.concat(F.lit('"'), F.col("date"), F.lit('"'))))
    head = F.to_json(F.struct("doc_id", "article_body"))
    value = F.concat(
        F.expr("substring(h, 1, length(h) - 1)"), F.lit(',"word_count":12.0,"stanford":"1","publication_date":'), F.col("form"),
        # Every eleventh message is cut off.
        F.when(F.col("ingest_seq") % 11 == 0, F.lit("")).otherwise(F.lit("}")))
    made = s.select("ingest_seq", head.alias("h"), form.alias("form")).select("ingest_seq", value.alias("value"))
    return messages.decode(made).select("ingest_seq", "doc_key", "date", "error")


def phrases_inserted(spark, sf_dir):
    """Phrase documents appended as JSON and read back."""
    folder = shared_folder(spark, "phrases")
    documents.insert_phrases(phrases_by_doc(spark, sf_dir), folder)
    return spark.read.schema("doc_id string, phrases string").json(folder)


def stories_inserted(spark, sf_dir):
    """Stories appended with their load time, read back without it."""
    folder = shared_folder(spark, "stories")
    documents.insert_stories(extract.extract_articles(corpus_markup(spark, sf_dir)), folder)
    stored = spark.read.parquet(folder)
    return _printed(stored.where(F.col("date_added").isNotNull()).drop("date_added"))


def rows_published(spark, sf_dir):
    """Stored rows published as JSON arrays and read back."""
    folder = shared_folder(spark, "rows")
    documents.publish_rows(annotate.to_stored(_annotated(spark, sf_dir)), folder)
    return read_messages(spark, folder).select("value")


def message_files(spark, sf_dir):
    """Publish the stories as messages, then read and decode them."""
    folder = shared_folder(spark, "messages")
    s = stories(spark, sf_dir).select("doc_key", "doc_id", "publication_date", "article_body")
    documents.publish_stories(s, folder, key="doc_key")
    return messages.decode(read_messages(spark, folder)).select("doc_key", "doc_id", "date", "article_body", "error")


def xml_files(spark, sf_dir):
    """Export the articles of one language as chunked XML, then read them back."""
    folder = shared_folder(spark, "xml")
    xml.write_articles(stories(spark, sf_dir), folder, FIRST, EXPORT_LANGUAGE)
    return xml.read_articles(spark, folder)


def xml_chunks(spark, sf_dir):
    """Export the articles of one language in chunks of exactly ``XML_CHUNK``, then count each chunk's rows and files."""
    folder = shared_folder(spark, "xml-chunks")
    xml.write_chunks(stories(spark, sf_dir), folder, XML_CHUNK, EXPORT_LANGUAGE)
    return xml.read_chunks(spark, folder)


def coded_files(spark, sf_dir):
    """Code the documents in one distributed write, then count what was stored."""
    folder = shared_folder(spark, "coded")
    documents.write_coded(_coded(spark, sf_dir), folder, batch_size=5000)
    return coding.sentence_outcomes(spark.read.parquet(folder))


def _run_stream(spark, sf_dir):
    folder = shared_folder(spark, "stream")
    source = table(spark, sf_dir, "documents").schema
    arriving = stories_of(spark.readStream.schema(source).parquet(f"{sf_dir}/documents*.parquet"))
    arriving = arriving.select("doc_key", "doc_id", "publication_date", "article_body")
    values = arriving.select(messages.story_message(arriving, key="doc_key").alias("value"))
    query = streaming.stream_annotate(values, f"{folder}/out", f"{folder}/checkpoint", every=None)
    query.awaitTermination()
    return f"{folder}/out"


def _enqueue(part: DataFrame, queue: str) -> int:
    """Append messages to a queue, a file per partition of their scan; the files it now holds.

    A fixed number of files would give each task that writes one a fixed share of the input.
    """
    part.write.mode("append").text(queue)
    return len(part.sparkSession.read.text(queue).inputFiles())


def stream_restart(spark, sf_dir):
    """Half of the messages, then a restart from the checkpoint with all of them sent: each document once.

    The messages lie in several files, one per trigger, so there are several micro-batches.
    """
    folder = shared_folder(spark, "restart")
    s = stories(spark, sf_dir).select("ingest_seq", "doc_key", "doc_id", "publication_date", "article_body")
    value = messages.story_message(s.drop("ingest_seq"), key="doc_key").alias("value")
    for part in (s.where("ingest_seq % 2 = 0"), s):
        part.select(value).repartition(3).write.mode("append").text(f"{folder}/queue")
        incoming = stream_messages(spark, f"{folder}/queue", files_per_trigger=1)
        streaming.stream_annotate(
            incoming, f"{folder}/out", f"{folder}/checkpoint", look_back=None, every=None,
        ).awaitTermination()
    return annotate.to_stored(streaming.read_annotated(spark, f"{folder}/out"))


def stream_replay(spark, sf_dir):
    """All messages, then two redeliveries of parts of them in new files, each run restarted from the checkpoint.

    The state store of the stream drops the copies: each document is stored once. Each
    run takes two thirds of its new files per trigger.
    """
    folder = shared_folder(spark, "replay")
    s = spread_stories(spark, sf_dir).select("ingest_seq", "doc_key", "doc_id", "publication_date", "article_body")
    value = messages.story_message(s.drop("ingest_seq"), key="doc_key").alias("value")
    queued = 0
    for part in (s, s.where("ingest_seq % 2 = 0"), s.where("ingest_seq % 3 = 0").union(s.where("ingest_seq % 3 = 0"))):
        before, queued = queued, _enqueue(part.select(value), f"{folder}/queue")
        incoming = stream_messages(
            spark, f"{folder}/queue", files_per_trigger=max(1, ceil((queued - before) * 2 / 3)), arrival=True)
        streaming.stream_annotate(
            incoming, f"{folder}/out", f"{folder}/checkpoint", every=None, expiry=REPLAY_EXPIRY,
        ).awaitTermination()
    return annotate.to_stored(streaming.read_annotated(spark, f"{folder}/out"))


def stream_annotate(spark, sf_dir):
    """The documents as a message stream, annotated by the streaming job."""
    stored = streaming.read_annotated(spark, _run_stream(spark, sf_dir))
    return annotate.to_stored(stored)


def stream_stats(spark, sf_dir):
    """What the streaming job counted, without its clock."""
    stats = streaming.read_batch_stats(spark, _run_stream(spark, sf_dir))
    return stats.agg(*[
        F.sum(c).alias(c) for c in ("batch_size", "docs_size", "sentences", "io_operations")
    ])


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        language_stats, word_count, byte_length, decode_doc_id, quarantine_bad_ids,
        extract_articles, quarantine_articles, extract_pages, story_record,
        count_by_language, xml_articles, xml_first_n,
        date_simple, date_robust, date_robust_fixed, date_int_writeback, date_range,
        publish_json, publish_row_array, decode_message, quarantine_messages,
        split_sentences, split_turns, tokens, annotated_documents, explode_sentences,
        code_actors, code_verbs, phrases_by_doc, phrases_by_sentence, sentence_outcomes,
        first_event, flatten_events, code_actors_large, annotate_hook, code_hook, stored_events_meta, noun_pairs,
        recent_ids, newest_first, skip_processed, skip_all_processed, merge_annotations, merge_hot, merge_stored,
        shuffled_cap,
        batch_stats, batch_averages, progress,
        corpus_files, corpus_spellings, message_files, message_dialects, phrases_inserted, stories_inserted, rows_published,
        xml_files, xml_chunks, coded_files, stream_annotate, stream_stats, stream_restart, stream_replay,
    )
}
