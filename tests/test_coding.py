import json

import pytest
from pyspark.sql import functions as F

from newsflow.operators import annotate, coding

ACTORS = [("Prime Minister", "GOV"), ("minister", "MIN"), ("France", "FRA"), ("u.s.", "USA"), ("France", "ZZZ")]
VERBS = [("met", "040"), ("met with", "041"), ("attacked", "190")]
TEXT = "The Prime Minister met with France. Nothing here. The minister attacked the U.S. today! ..."


def dictionary(spark, **bounds):
    return coding.load_dictionary(
        spark.createDataFrame(ACTORS, "phrase string, code string"),
        spark.createDataFrame(VERBS, "phrase string, code string"), **bounds)


def annotated(spark, *bodies):
    rows = [(f"k{i}", f"d{i}", "20100305", b) for i, b in enumerate(bodies)]
    return annotate.annotate(
        spark.createDataFrame(rows, "doc_key string, doc_id string, date string, article_body string"))


def test_dictionary_is_normalised_and_measured(spark):
    d = dictionary(spark)
    assert d.small and d.lengths == (4, 2, 1)
    assert {(r.phrase, r.actor, r.verb) for r in d.entries.collect()} == {
        ("prime minister", "GOV", None), ("minister", "MIN", None), ("france", "FRA", None),
        ("u . s .", "USA", None), ("met", None, "040"), ("met with", None, "041"), ("attacked", None, "190")}
    assert not dictionary(spark, max_rows=3).small
    assert not dictionary(spark, max_bytes=10).small


def test_longest_match_per_start_and_overlaps_stay(spark):
    sentences = annotate.explode_sentences(annotated(spark, TEXT))
    hits = coding.dictionary_hits(sentences, dictionary(spark), "actor", "doc_key", "sen_id")
    assert sorted((r.sen_id, r.start, r.n, r.phrase, r.code) for r in hits.collect()) == [
        (1, 2, 2, "prime minister", "GOV"), (1, 3, 1, "minister", "MIN"), (1, 6, 1, "france", "FRA"),
        (3, 2, 1, "minister", "MIN"), (3, 5, 4, "u . s .", "USA"),
    ]
    verbs = coding.dictionary_hits(sentences, dictionary(spark), "verb", "doc_key", "sen_id")
    assert sorted((r.sen_id, r.start, r.phrase) for r in verbs.collect()) == [(1, 4, "met with"), (3, 3, "attacked")]


def test_hits_need_no_shuffle_of_the_text(spark):
    sentences = annotate.explode_sentences(annotated(spark, TEXT))
    hits = coding.dictionary_hits(sentences, dictionary(spark), "actor", "doc_key", "sen_id")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    # Every exchange belongs to a build side.
    probe = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("doc_key" not in line for line in probe)


def coded_rows(df):
    return {r.doc_key: r.coded for r in df.collect()}


def test_coded_documents(spark):
    coded = coding.code_documents(annotated(spark, TEXT, "", "No match at all."), dictionary(spark))
    got = coded_rows(coded)
    first, second, third = got["k0"][:3]
    assert (first.nouns, first.noun_coding) == (["prime minister", "minister", "france"], ["GOV", "MIN", "FRA"])
    assert (first.verbs, first.verb_coding, first.events) == ("met with", "041", [["GOV", "FRA", "041"]])
    assert (second.nouns, second.verbs, second.events, second.error) == ([], "", None, None)
    assert (third.verbs, third.events) == ("attacked", [["MIN", "USA", "190"]])
    assert got["k1"] == [] and len(got["k2"]) == 1
    assert [s.sen_id for s in got["k0"]] == list(range(1, len(got["k0"]) + 1))
    outcome = {r.doc_key: (r.total, r.parsed, r.failed) for r in coding.sentence_outcomes(coded).collect()}
    assert outcome["k0"] == (len(got["k0"]), len(got["k0"]) - 1, 1) and outcome["k1"] == (0, 0, 0)
    assert got["k0"][-1].error == coding.NO_WORDS


def test_large_dictionary_gives_the_same_result(spark):
    docs = annotated(spark, *([TEXT] * 5), "France met France.", "", "minister " * 300)
    small = coding.code_documents(docs, dictionary(spark))
    salted = coding.code_documents(docs, dictionary(spark, max_rows=0))
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


@pytest.mark.parametrize("parts", [1, 4])
def test_copies_of_a_document_are_all_kept(spark, parts):
    docs = annotated(spark, TEXT).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("n")
    docs = docs.unionByName(annotated(spark, "x", "France.")).repartition(parts)
    coded = coding.code_documents(docs, dictionary(spark))
    assert coded.count() == 52
    assert coded.where("doc_key = 'k0' AND size(coded) > 1").distinct().count() == 1


def test_same_key_with_different_texts_is_not_mixed(spark):
    docs = annotated(spark, "France.", "The minister.").withColumn("doc_key", F.lit("k"))
    nouns = sorted(r.coded[0].nouns for r in coding.code_documents(docs, dictionary(spark)).collect())
    assert nouns == [["france"], ["minister"]]


def test_phrase_forms(spark):
    coded = coding.code_documents(annotated(spark, "France met. Same. France met."), dictionary(spark))
    listed = json.loads(coding.phrases_by_doc(coded).first().phrases)
    assert [list(p) for p in listed] == [["France met."], ["Same."], ["France met."]]
    assert listed[0]["France met."] == {"nouns": ["france"], "noun_coding": ["FRA"], "verbs": "met", "verb_coding": "040"}
    mapped = coding.phrases_by_sentence(coded).first()
    assert set(mapped.phrases) == {"France met.", "Same."} and mapped.sents_count == 3


def test_repeated_sentence_keeps_the_last_record(spark):
    docs = annotated(spark, "Same. Same.")
    coded = coding.code_with(docs, coding.per_sentence_coder(numbered()))
    assert coding.phrases_by_sentence(coded).first().phrases["Same."].verbs == "2"


def numbered():
    calls = []

    def code(sentence, tree, date):
        calls.append(sentence)
        return {"verbs": str(len(calls))}

    return code


def test_a_failing_sentence_does_not_stop_its_document(spark):
    def code(sentence, tree, date):
        if "bad" in sentence:
            raise ValueError("cannot parse")
        return {"nouns": ["n"], "noun_coding": ["N"], "events": [["A", "B", date]]}

    coded = coding.code_with(annotated(spark, "Good. A bad one. Fine.", ""), coding.per_sentence_coder(code))
    got = coded_rows(coded)
    assert [s.error for s in got["k0"]] == [None, "cannot parse", None]
    assert got["k0"][1].nouns == [] and got["k0"][2].nouns == ["n"]
    outcome = {r.doc_key: (r.total, r.parsed, r.failed) for r in coding.sentence_outcomes(coded).collect()}
    assert outcome == {"k0": (3, 2, 1), "k1": (0, 0, 0)}
    events = coding.flatten_events(coding.events_by_doc(coded)).orderBy("sen_id").collect()
    assert [(e.mongo_id, e.sen_id, e.events) for e in events] == [
        ("k0", 1, [["A", "B", "20100305"]]), ("k0", 3, [["A", "B", "20100305"]])]


def test_stored_events_are_filtered_as_documented(spark):
    def result(key, sents):
        return json.dumps({key: {"sents": sents, "meta": {"date": "x"}}})

    event = {"content": "c", "events": [["A", "B", "1"]]}
    rows = [
        ("d", json.dumps({"main_output": json.dumps([
            result("m", {"1": event}), result("m", None), result("m", {"2": {"content": "no"}}),
            result("m", {"9": event}), result("other", {"3": event}), json.dumps({"m": {"meta": {}}}),
        ])}), "m", 3),
        ("e", json.dumps({"main_output": "[]"}), "n", 0),
    ]
    by_doc = spark.createDataFrame(rows, "doc_id string, output string, mongo_id string, sents_count int")
    assert [tuple(r) for r in coding.flatten_events(by_doc).collect()] == [("m", 1, "c", [["A", "B", "1"]])]


def test_first_event_and_noun_arrays(spark):
    def code(sentence, tree, date):
        return {"events": [["A", "B", "1"], ["C", "D", "2"]] if "yes" in sentence else None}

    coded = coding.code_with(annotated(spark, "yes. no."), coding.per_sentence_coder(code))
    got = [(r.sen_id, r.source, r.target, r.code) for r in coding.first_event(coded).orderBy("sen_id").collect()]
    assert got == [(1, "A", "B", "1"), (2, "", "", "")]
    nouns, codes = coding.noun_arrays(F.col("pairs"))
    pairs = spark.createDataFrame([([["a", "A"], ["b", "B"]],)], "pairs array<array<string>>")
    assert tuple(pairs.select(nouns.alias("n"), codes.alias("c")).first()) == (["a", "b"], ["A", "B"])


@pytest.mark.parametrize("records", [1, 3, 10_000])
def test_a_coder_gets_whole_documents_in_batches_bounded_by_sentences(spark, records):
    """Documents cut between Arrow batches arrive whole and in order; empty and NULL ones stay what they are."""
    def sizes(batches):
        for b in batches:
            n = [-1 if s is None else len(s) for s in b["sentences"]]
            held = sum(max(1, k) for k in n)
            coded = [[{"sen_id": x["sen_id"], "sentence": x["sentence"], "tree": x["tree"], "nouns": [], "noun_coding": [],
                       "verbs": str(k), "verb_coding": str(held), "events": None, "error": None}
                      for x in (s if s is not None else [])] for s, k in zip(b["sentences"], n)]
            yield b[["doc_key", "doc_id"]].assign(date=[str(k) for k in n], coded=coded)

    longs = [" ".join(f"S{i}-{j}." for j in range(7)) for i in range(4)]
    docs = annotated(spark, "", *longs, "", "One.").unionByName(annotated(spark, "x").select(
        F.lit("none").alias("doc_key"), "doc_id", "date", F.lit(None).cast(annotated(spark, "").schema["sentences"].dataType).alias("sentences")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = {r.doc_key: r for r in coding.code_with(docs.coalesce(1), sizes).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {k: r.date for k, r in got.items()} == {
        "k0": "0", "k1": "7", "k2": "7", "k3": "7", "k4": "7", "k5": "0", "k6": "1", "none": "-1"}
    for i in range(4):
        assert [(s.sen_id, s.sentence) for s in got[f"k{i + 1}"].coded] == [(j + 1, f"S{i}-{j}.") for j in range(7)]
    if records == 3:
        # A batch of three rows and the document it completes, never all documents at once.
        assert max(int(s.verb_coding) for r in got.values() for s in r.coded) <= 10


def test_a_small_dictionary_codes_in_place_as_the_joins_do(spark):
    """Odd documents, copies and sentences give the same rows; no document is shuffled."""
    from dataclasses import replace

    from newsflow import schemas

    kind = schemas.ANNOTATED["sentences"].dataType
    docs = annotated(spark, TEXT, TEXT, "", None, "u.s. prime", "minister " * 5, "France met. Same. France met France.")
    odd = docs.limit(1).select(F.lit(None).cast("string").alias("doc_key"), "doc_id", "date", F.array(
        F.lit(None).cast(kind.elementType), F.struct(F.lit(7).alias("sen_id"), F.lit(None).cast("string").alias("sentence"), F.lit("t").alias("tree")),
    ).cast(schemas.T.ArrayType(kind.elementType)).alias("sentences"))
    docs = docs.unionByName(odd).unionByName(odd).unionByName(odd.withColumn("sentences", F.lit(None).cast(kind)))
    d = dictionary(spark)
    assert d.inline and not dictionary(spark, max_rows=3).inline
    for texts in (("sentence", "tree"), ("sentence",), ()):
        placed = coding.code_documents(docs, d, texts)
        joined = coding.code_documents(docs, replace(d, inline=0), texts)
        assert placed.dtypes == joined.dtypes
        assert sorted(map(str, placed.collect())) == sorted(map(str, joined.collect()))
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and ("_hash_a" in line or "doc_key" in line)]


def test_matching_in_batches_equals_brute_force():
    """Longest actor and verb at every token, and the events, on random sentences in whole, cut and sliced batches."""
    import random

    import pyarrow as pa

    from newsflow.operators.matching import AT_ONCE, MATCHES, Phrases

    rng = random.Random(5)
    entries = [("a", "A", None), ("a b", None, "1"), ("a b c d", "ABCD", "2"), ("b", "B", "3"), ("b c", "BC", None),
               ("d . d", None, "4"), ("\u00e9", "E", None), ("c", None, None), ("d", "", None)]
    words = ["a", "b", "c", "d", ".", "\u00e9", "x"]

    def one(tokens):
        hits = {}
        for kind in (0, 1):
            hits[kind] = []
            for i in range(len(tokens)):
                fit = [(len(p.split(" ")), p, codes[kind]) for p, *codes in entries
                       if codes[kind] is not None and tokens[i:i + len(p.split(" "))] == p.split(" ")]
                if fit:
                    hits[kind].append((i, *max(fit)[1:]))
        actors, verbs = hits[0], hits[1]
        events = [[actors[0][2], actors[-1][2], v[2]] for v in verbs if actors and actors[0][0] < v[0] < actors[-1][0]]
        return {"nouns": [p for _, p, _ in actors], "noun_coding": [c for _, _, c in actors], "verbs": verbs[0][1] if verbs else "",
                "verb_coding": verbs[0][2] if verbs else "", "events": events or None}

    docs = [None if rng.random() < 0.1 else [[rng.choice(words) for _ in range(rng.choice([0, 1, 2, 9]))]
            for _ in range(rng.choice([0, 1, 4]))] for _ in range(2 * AT_ONCE + 5)]
    kind = pa.list_(pa.list_(pa.string()))
    expected = [None if d is None else [one(s) for s in d] for d in docs]
    got = Phrases(entries).match(pa.array(docs, kind))
    assert got.type == pa.list_(MATCHES) and got.to_pylist() == expected
    assert Phrases(entries).match(pa.array(docs, kind).slice(7, 300)).to_pylist() == expected[7:307]
    assert Phrases(entries).match(pa.array([], kind)).to_pylist() == []
    assert Phrases([]).match(pa.array([[["a"]], None], kind)).to_pylist() == [[one(["x"])], None]
    assert any(s["events"] for d in expected for s in d or [])


def test_coding_in_place_sends_only_tokens_to_python(spark):
    """No token is looked up in an interpreted lambda: the plan has no dictionary join, and texts and keys stay in the JVM."""
    coded = coding.code_documents(annotated(spark, TEXT), dictionary(spark), ("sentence",))
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "Join" not in plan
    evaluated = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "match(transform(sentences" in evaluated and "doc_key" not in evaluated
