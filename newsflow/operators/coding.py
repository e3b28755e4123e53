"""Dictionary coding of actors and verbs, and the per-document coded forms.

The dictionary look-up is a chain of joins, one per phrase length, over one row
per token position. Each dictionary has one row per phrase, so a left join never
multiplies a position, and the longest match is a ``coalesce`` - no window and
no grouping is needed to find it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import dates, text
from newsflow.operators.matching import MATCHES_DDL, Phrases

Coder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

# A dictionary within both bounds is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Copies of a large dictionary, so that a frequent word is spread over this many tasks.
SALTS = 32

# Up to these bounds every Python worker holds the dictionary, and documents are coded in place.
INLINE_ROWS = 20_000
INLINE_BYTES = 1 << 20

# A sentence needs one of these characters to be codable.
WORD_CHARACTER = r"[\p{L}\p{M}\p{N}]"
NO_WORDS = "no words"


@dataclass(frozen=True)
class Dictionary:
    """Phrases with an actor code, a verb code or both, one row per phrase."""

    entries: DataFrame  # phrase, n, actor, verb
    lengths: tuple[int, ...]  # phrase lengths in tokens, longest first
    small: bool
    inline: bool = False  # small enough to code documents in place

    def first_words(self) -> DataFrame:
        """Every word that starts a phrase: its own codes and the phrase lengths it starts."""
        single = F.col("n") == 1
        return self.entries.groupBy(F.split_part("phrase", F.lit(" "), F.lit(1)).alias("_gram1")).agg(
            F.max(F.when(single, F.col("actor"))).alias("_actor1"),
            F.max(F.when(single, F.col("verb"))).alias("_verb1"),
            F.collect_set("n").alias("_starts"),
        )

    def of_length(self, n: int) -> DataFrame:
        return self.entries.where(F.col("n") == n).select(
            F.col("phrase").alias(f"_gram{n}"),
            F.col("actor").alias(f"_actor{n}"),
            F.col("verb").alias(f"_verb{n}"),
        )


def load_dictionary(
    actors: DataFrame, verbs: DataFrame,
    max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> Dictionary:
    """Normalise two ``phrase, code`` tables and measure them.

    Phrases are lower-cased and tokenised like the text. A phrase listed twice
    keeps its smallest code. One small aggregate job measures the result.
    """
    def side(df: DataFrame, kind: str) -> DataFrame:
        words = text.tokens(F.lower("phrase"))
        return df.select(
            F.array_join(words, " ").alias("phrase"), F.size(words).alias("n"),
            *[(F.col("code") if k == kind else F.lit(None).cast("string")).alias(k)
              for k in ("actor", "verb")],
        )

    entries = (
        side(actors, "actor").unionByName(side(verbs, "verb"))
        .where(F.col("n") > 0)
        .groupBy("phrase", "n")
        .agg(F.min("actor").alias("actor"), F.min("verb").alias("verb"))
    )
    size = entries.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(sum(
            (F.coalesce(F.octet_length(c), F.lit(0)) for c in ("phrase", "actor", "verb")),
            F.lit(0),
        )), F.lit(0)).alias("bytes"),
        F.collect_set("n").alias("lengths"),
    ).first()
    small = size["rows"] <= max_rows and size["bytes"] <= max_bytes
    inline = size["rows"] <= min(INLINE_ROWS, max_rows) and size["bytes"] <= min(INLINE_BYTES, max_bytes)
    return Dictionary(entries, tuple(sorted(size["lengths"], reverse=True)), small, inline)


def _token_rows(
    sentences: DataFrame, dictionary: Dictionary, keep: list[str], header: list[str] | None = None
) -> DataFrame:
    """One row per token start, ready for look-up.

    With ``header`` an extra row at position 0 stands for the sentence and is the
    only one to carry those columns, as ``_head_<name>``. For a shuffled look-up the
    phrases are spelled out here, so that only header rows hold whole sentences.
    """
    words = F.col("_words")
    found = F.coalesce(text.tokens(F.lower("sentence")), F.array().cast("array<string>"))
    starts = words if header is None else F.concat(F.array(F.lit(None).cast("string")), words)
    # The outer form keeps the planner from computing the array twice, once for
    # an inferred emptiness filter; the look-up drops the rows of empty arrays.
    rows = sentences.withColumn("_words", found).select(
        "*", F.posexplode_outer(starts).alias("start", "_gram1")
    )
    if header is None:
        rows = rows.withColumn("start", F.col("start") + 1)
    carried = [*keep, "start", "_gram1"]
    carried += [F.when(F.col("start") == 0, F.col(c)).alias(f"_head_{c}") for c in header or ()]
    if dictionary.small:
        return rows.select(*carried, "_words")
    # The input partition is part of the salt: copies of a text do not share it.
    salt = F.xxhash64(F.spark_partition_id(), *keep, "start")
    return rows.select(
        *carried, salt.alias("_salt"),
        *[_spelled(n).alias(f"_gram{n}") for n in dictionary.lengths if n > 1],
    )


def _spelled(n: int) -> Column:
    """The phrase of ``n`` tokens from ``start``, or NULL at the end of the sentence."""
    following = [F.get("_words", F.col("start") + i) for i in range(n - 1)]
    complete = (F.col("start") > 0) & following[-1].isNotNull()
    return F.when(complete, F.concat_ws(" ", "_gram1", *following))


def _look_up(rows: DataFrame, entries: DataFrame, gram: str, small: bool) -> DataFrame:
    """Left join on one phrase column; the entry side is unique, so rows stay as many."""
    if small:
        return rows.join(F.broadcast(entries), gram, "left")
    # A frequent word would fill one task: every salt has its own copy of the entry.
    # Rows without a phrase match nothing; their unbounded salt spreads them over all tasks.
    copies = entries.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    salt = F.when(F.col(gram).isNotNull(), F.pmod("_salt", F.lit(SALTS))).otherwise(F.col("_salt"))
    return rows.withColumn("_copy", salt).join(copies, [gram, "_copy"], "left").drop("_copy")


def _matched(rows: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Add ``actor``/``verb`` structs (phrase, code) of the longest match at each start.

    Rows that can neither match nor stand for a sentence (start 0) are dropped
    after the first look-up, and longer phrases are only looked up where the
    first word starts one of that length.
    """
    rows = _look_up(rows, dictionary.first_words(), "_gram1", dictionary.small)
    rows = rows.where((F.col("start") == 0) | F.col("_starts").isNotNull())
    for n in dictionary.lengths:
        if n == 1:
            continue
        phrase = _spelled(n) if dictionary.small else F.col(f"_gram{n}")
        rows = rows.withColumn(f"_gram{n}", F.when(F.array_contains("_starts", n), phrase))
        rows = _look_up(rows, dictionary.of_length(n), f"_gram{n}", dictionary.small)

    def longest(kind: str) -> Column:
        found = [
            F.when(F.col(f"_{kind}{n}").isNotNull(), F.struct(
                F.lit(n).alias("n"), F.col(f"_gram{n}").alias("phrase"),
                F.col(f"_{kind}{n}").alias("code"),
            )) for n in dictionary.lengths
        ]
        none = F.lit(None).cast("struct<n:int,phrase:string,code:string>")
        return F.coalesce(*found, none)

    return rows.withColumns({"actor": longest("actor"), "verb": longest("verb")})


def dictionary_hits(
    sentences: DataFrame, dictionary: Dictionary, kind: str, *keep: str
) -> DataFrame:
    """Longest ``kind`` ("actor" or "verb") match at every token start.

    Matches that start at different positions may overlap; all are kept. With a
    small dictionary the plan is one pass of broadcast joins without a shuffle.
    ``sentences`` has the columns ``sen_id`` and ``sentence`` besides ``keep``.
    """
    keys = list(keep)
    rows = _matched(_token_rows(sentences, dictionary, keys), dictionary)
    return rows.where(F.col(kind).isNotNull()).select(
        *keys, "start", F.col(f"{kind}.n").alias("n"),
        F.col(f"{kind}.phrase").alias("phrase"), F.col(f"{kind}.code").alias("code"),
    )


def code_documents(
    annotated: DataFrame, dictionary: Dictionary, texts: tuple[str, ...] = ("sentence", "tree"),
) -> DataFrame:
    """Annotated documents to one coded row per document (``schemas.CODED``).

    ``texts`` names the text fields the result is needed with; the others are NULL
    and never enter the exchange. A sentence is known by its position, so repeated
    and missing ``sen_id`` values change nothing.

    With a dictionary within ``INLINE_ROWS`` and ``INLINE_BYTES`` documents stay whole rows
    and are coded in place, without a shuffle: only their tokens travel to Python, in Arrow
    batches bounded by bytes. With a larger one, every sentence row travels once through one
    exchange, as the header row of its matches, so documents are neither read twice nor joined back. The exchange
    key holds the content hash and the input partition besides the document key:
    copies of a document, however many, stay spread over as many groups as there
    are input partitions, collapse inside each, and are counted and restored.
    """
    if dictionary.inline:
        return _code_in_place(annotated, dictionary, texts)
    identity = ["_hash_a", "_hash_b", "_part"]
    document = ["doc_key", "doc_id", "date"]
    content = [F.col(c) for c in (*document, "sentences")]
    docs = annotated.withColumns({
        "_hash_a": F.xxhash64(*content),
        "_hash_b": F.xxhash64(F.lit(1), *content),
        "_part": F.spark_partition_id(),
    })
    sentences = docs.select(*identity, *document, F.posexplode_outer("sentences").alias("_pos", "_s"))
    sentences = sentences.select(*identity, *document, "_pos", "_s.*").withColumn(
        "_codable", F.col("sentence").rlike(WORD_CHARACTER))
    # Only the header row carries these; a match is a position, a length and a code.
    header = [*document, "sen_id", *texts, "_codable"]
    rows = _matched(_token_rows(sentences, dictionary, [*identity, "_pos"], header), dictionary)
    rows = rows.where((F.col("start") == 0) | F.col("actor").isNotNull() | F.col("verb").isNotNull())
    mark = F.when(F.col("start") > 0, F.struct("start", "actor", "verb"))
    per_sentence = (
        rows.repartition(*identity)
        .groupBy(*identity, "_pos")
        .agg(
            # A set, so the marks of copies merge; it holds one sentence at most.
            F.sort_array(F.collect_set(mark)).alias("_marks"),
            F.count_if(F.col("start") == 0).alias("_copies"),
            *[F.first(f"_head_{c}", ignorenulls=True).alias(c) for c in header],
        )
    )
    for c in {"sentence", "tree"} - set(texts):
        per_sentence = per_sentence.withColumn(c, F.lit(None).cast("string"))
    coded = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.col("_coded").alias("s")))
    per_document = (
        _coded_sentences(per_sentence)
        .groupBy(*identity)
        .agg(
            F.transform(F.sort_array(F.collect_list(coded)), lambda c: c["s"]).alias("coded"),
            F.max("_copies").alias("_copies"),
            *[F.first(c, ignorenulls=True).alias(c) for c in document],
        )
    )
    return (
        per_document
        .withColumn("_copy", F.explode_outer(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*document, "coded")
    )


def _code_in_place(annotated: DataFrame, dictionary: Dictionary, texts: tuple[str, ...]) -> DataFrame:
    """``code_documents`` by matching Arrow batches of tokens; texts and keys stay out of them."""
    entries = [tuple(r) for r in dictionary.entries.select("phrase", "actor", "verb").collect()]

    @F.arrow_udf(MATCHES_DDL)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        phrases = Phrases(entries)
        for documents in batches:
            yield phrases.match(documents)

    words = F.transform("sentences", lambda s: F.coalesce(
        text.tokens(F.lower(s["sentence"])), F.array().cast("array<string>")))
    docs = annotated.select("doc_key", "doc_id", "date", "sentences", match(words).alias("_found"))
    none = F.lit(None).cast("string")

    def coded(z: Column) -> Column:
        s, m = z["sentences"], z["_found"]
        return F.struct(
            s["sen_id"].alias("sen_id"),
            *[(s[c] if c in texts else none).alias(c) for c in ("sentence", "tree")],
            *[m[c].alias(c) for c in ("nouns", "noun_coding", "verbs", "verb_coding", "events")],
            F.when(~s["sentence"].rlike(WORD_CHARACTER), F.lit(NO_WORDS)).alias("error"),
        )

    # A document without sentences, or with NULL for them, has no coded ones.
    zipped = F.coalesce(F.arrays_zip("sentences", "_found"), F.array())
    return docs.select("doc_key", "doc_id", "date", F.transform(zipped, coded).alias("coded"))


def _coded_sentences(rows: DataFrame) -> DataFrame:
    """Add ``_coded``: phrases, codes and events of each sentence from its sorted marks.

    Events need two actors: the first actor of the sentence acts on the last one
    through every verb that starts between them. Each list is made once, in a
    projection of its own.
    """
    first, last = F.get("_actors", F.lit(0)), F.try_element_at(F.col("_actors"), F.lit(-1))
    between = F.filter(
        "_verbs", lambda v: (v["start"] > first["start"]) & (v["start"] < last["start"])
    )
    events = F.transform(
        between, lambda v: F.array(first["actor"]["code"], last["actor"]["code"], v["verb"]["code"])
    )
    verb = F.get("_verbs", F.lit(0))["verb"]
    return rows.withColumns({
        "_actors": F.filter("_marks", lambda m: m["actor"].isNotNull()),
        "_verbs": F.filter("_marks", lambda m: m["verb"].isNotNull()),
    }).withColumn("_events", events).withColumn("_coded", F.struct(
        "sen_id", "sentence", "tree",
        F.transform("_actors", lambda a: a["actor"]["phrase"]).alias("nouns"),
        F.transform("_actors", lambda a: a["actor"]["code"]).alias("noun_coding"),
        F.coalesce(verb["phrase"], F.lit("")).alias("verbs"),
        F.coalesce(verb["code"], F.lit("")).alias("verb_coding"),
        F.when(F.size("_events") > 0, F.col("_events")).alias("events"),
        F.when(~F.col("_codable"), F.lit(NO_WORDS)).alias("error"),
    ))


def code_with(annotated: DataFrame, coder: Coder) -> DataFrame:
    """Run a user's coder; it maps batches of annotated documents to coded ones.

    The coder gets the date as year + month + day: a date of eight digits as it is, a
    printed one normalised, ``-1`` where it cannot be read. A document travels to
    Python as one row per sentence, so that an Arrow batch is bounded by sentences
    and not by whole documents; the rows of a document follow each other in its
    partition and are put together there, in order and without a shuffle.
    """
    dated = dates.robust_date(annotated, "date", "_normalised", max_year=None)
    date = F.when(F.col("date").rlike("^[0-9]{8}$"), F.col("date")).otherwise(F.col("_normalised"))
    # A document without sentences keeps one row with what it has, an empty array or NULL.
    rows = F.when(F.size("sentences") > 0, F.transform("sentences", lambda s: F.array(s))).otherwise(F.array("sentences"))
    columns = dated.select("doc_key", "doc_id", date.alias("date"), F.posexplode_outer(rows).alias("_pos", "sentences"))
    return columns.mapInPandas(lambda batches: coder(_whole_documents(batches)), schemas.CODED)


def _whole_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of one row each from rows of one sentence each; the last one of a batch may go on in the next."""
    waiting = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        starts = np.flatnonzero(rows["_pos"] == 0)
        waiting = rows.iloc[starts[-1]:]
        if len(starts) > 1:
            yield _put_together(rows, starts)
    if waiting is not None:
        yield _put_together(waiting, np.array([0, len(waiting)]))


def _put_together(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """The documents between consecutive ``starts``."""
    parts = rows["sentences"].to_numpy()
    sentences = [parts[a] if b - a == 1 else np.concatenate(parts[a:b]) for a, b in zip(starts, starts[1:])]
    documents = rows[["doc_key", "doc_id", "date"]].iloc[starts[:-1]].reset_index(drop=True)
    return documents.assign(sentences=pd.Series(sentences, dtype=object))


def per_sentence_coder(code: Callable[[str, str, str], dict]) -> Coder:
    """A coder from a function of (sentence, tree, date) that may fail.

    A failing sentence gets empty results and its error text; its document goes on.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = [
                [_guarded(code, s, date) for s in (sents if sents is not None else [])]
                for sents, date in zip(batch["sentences"], batch["date"])
            ]
            yield batch[["doc_key", "doc_id", "date"]].assign(coded=coded)

    return run


def _guarded(code: Callable[[str, str, str], dict], sentence: dict, date: str) -> dict:
    empty = {"nouns": [], "noun_coding": [], "verbs": "", "verb_coding": "", "events": None, "error": None}
    try:
        result = {**empty, **code(sentence["sentence"], sentence["tree"], date)}
    except Exception as failure:  # noqa: BLE001 - any coder failure is recorded
        result = {**empty, "error": str(failure) or type(failure).__name__}
    return {**{k: sentence[k] for k in ("sen_id", "sentence", "tree")}, **result}


def noun_arrays(pairs: Column) -> tuple[Column, Column]:
    """Two parallel arrays from an array of (noun, code) pairs."""
    return (
        F.transform(pairs, lambda p: F.get(p, F.lit(0))),
        F.transform(pairs, lambda p: F.get(p, F.lit(1))),
    )


def _phrases(s: Column) -> Column:
    return F.struct(s["nouns"], s["noun_coding"], s["verbs"], s["verb_coding"])


def phrases_by_doc(coded: DataFrame) -> DataFrame:
    """``doc_id, phrases, mongo_id``: JSON array of one-entry maps keyed by sentence."""
    return coded.select(
        "doc_id",
        F.to_json(F.transform(
            "coded", lambda s: F.create_map(s["sentence"], _phrases(s))
        )).alias("phrases"),
        F.col("doc_key").alias("mongo_id"),
    )


def phrases_by_sentence(coded: DataFrame) -> DataFrame:
    """``doc_id, mongo_id, phrases, sents_count``: one map keyed by sentence text.

    Of a repeated sentence the last one counts, as with repeated assignment to a
    map key. Sorting by (text, ordinal descending) inside the row puts it first.
    Sentences with an error are left out.
    """
    good = F.filter("coded", lambda s: s["error"].isNull())
    ordered = F.sort_array(F.transform(good, lambda s: F.struct(
        s["sentence"].alias("sentence"), (-s["sen_id"]).alias("order"), _phrases(s).alias("phrases")
    )))
    latest = F.filter("_ordered", lambda s, i: (i == 0) | (
        s["sentence"] != F.get(F.col("_ordered"), i - 1)["sentence"]))
    return coded.withColumn("_ordered", ordered).select(
        "doc_id",
        F.col("doc_key").alias("mongo_id"),
        F.map_from_entries(F.transform(latest, lambda s: F.struct(s["sentence"], s["phrases"]))).alias("phrases"),
        F.size("coded").alias("sents_count"),
    )


def explode_phrases(by_sentence: DataFrame) -> DataFrame:
    """Rows of the phrase map."""
    return by_sentence.select(
        "doc_id", "mongo_id", "sents_count", F.explode_outer("phrases").alias("sentence", "p")
    ).where(F.col("sentence").isNotNull()).select("doc_id", "mongo_id", "sents_count", "sentence", "p.*")


def sentence_outcomes(coded: DataFrame) -> DataFrame:
    """Sentences of each document: total, parsed and failed (disjoint)."""
    failed = F.size(F.filter("coded", lambda s: s["error"].isNotNull()))
    return coded.select(
        "doc_key", F.size("coded").alias("total"),
        (F.size("coded") - failed).alias("parsed"), failed.alias("failed"),
    )


def first_event(coded: DataFrame) -> DataFrame:
    """First event per sentence by position; absent gives empty strings."""
    s = F.col("s")
    event = F.get(s["events"], F.lit(0))
    return coded.select("doc_key", F.explode_outer("coded").alias("s")).where(s.isNotNull()).select(
        "doc_key", s["sen_id"].alias("sen_id"),
        *[F.coalesce(F.get(event, F.lit(i)), F.lit("")).alias(name)
          for i, name in enumerate(("source", "target", "code"))],
    )


def events_by_doc(coded: DataFrame) -> DataFrame:
    """``doc_id, output, mongo_id, sents_count`` in the stored, doubly encoded form.

    ``output`` is ``{"main_output": text}`` where text is a JSON array of JSON
    texts, one per coded sentence with the date of its document as ``meta``.
    Sentences with an error are left out.
    """
    good = F.filter("coded", lambda s: s["error"].isNull())
    results = F.transform(good, lambda s: F.to_json(F.create_map(
        F.col("doc_key"),
        F.struct(F.create_map(
            s["sen_id"].cast("string"),
            F.struct(s["sentence"].alias("content"), s["tree"].alias("parsed"), s["events"].alias("events")),
        ).alias("sents"), F.struct("date").alias("meta")),
    )))
    return coded.select(
        "doc_id",
        F.to_json(F.struct(F.to_json(results).alias("main_output"))).alias("output"),
        F.col("doc_key").alias("mongo_id"),
        F.size("coded").alias("sents_count"),
    )


def flatten_events(by_doc: DataFrame) -> DataFrame:
    """``mongo_id, sen_id, sentence, events`` of every sentence that has events.

    Results without sentences, ordinals outside 1..sents_count and sentences
    without events are dropped.
    """
    texts = F.from_json(
        F.from_json("output", schemas.MAIN_OUTPUT)["main_output"], schemas.STRINGS
    )
    results = by_doc.select("mongo_id", "sents_count", F.explode_outer(texts).alias("r")).withColumn(
        "r", F.from_json("r", schemas.CODER_RESULT)
    )
    sents = F.try_element_at(F.col("r"), F.col("mongo_id"))["sents"]
    return (
        results.select("mongo_id", "sents_count", F.explode_outer(sents).alias("key", "s"))
        .withColumn("sen_id", F.col("key").try_cast("int"))
        .where(
            F.col("s.events").isNotNull() & F.col("sen_id").between(1, F.col("sents_count"))
            & (F.col("key") == F.col("sen_id").cast("string"))
        )
        .select("mongo_id", "sen_id", F.col("s.content").alias("sentence"), F.col("s.events").alias("events"))
    )
