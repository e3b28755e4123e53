import json

import pandas as pd
import pytest

from newsflow.operators import annotate
from newsflow.sources.messages import stream_messages
from newsflow.streaming import annotate as job


def publish(folder, name, keys, extra=()):
    lines = [json.dumps({"_id": {"$oid": k}, "doc_id": f"D{k}", "article_body": f"One {k}. Two.",
                         "publication_date_raw": "March 5, 2010"}) for k in keys]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*lines, *extra]) + "\n")


def run(spark, tmp_path, checkpoint="ck", **options):
    stream = stream_messages(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = job.stream_annotate(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), every=None, **options)
    query.awaitTermination()
    return job.read_annotated(spark, str(tmp_path / "out"))


def keys_of(stored):
    return sorted(r.doc_key for r in stored.collect())


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    publish(tmp_path / "in", "1.txt", "ab")
    publish(tmp_path / "in", "2.txt", "cd", extra=["{broken"])
    stored = run(spark, tmp_path)
    assert keys_of(stored) == list("abcd")
    docs = spark.createDataFrame(
        [(k, f"D{k}", "March 5, 2010", f"One {k}. Two.") for k in "abcd"],
        "doc_key string, doc_id string, date string, article_body string")
    assert sorted(stored.drop("batch_id").collect()) == sorted(annotate.annotate(docs).collect())
    assert [r.error for r in job.read_quarantine(spark, str(tmp_path / "out")).collect()] == ["malformed message"]
    assert keys_of(run(spark, tmp_path)) == list("abcd")
    publish(tmp_path / "in", "3.txt", "e")
    assert keys_of(run(spark, tmp_path)) == list("abcde")


@pytest.mark.parametrize("look_back", [200, None])
def test_full_replay_adds_nothing(spark, tmp_path, look_back):
    for i, keys in enumerate(("ab", "cd", "ef")):
        publish(tmp_path / "in", f"{i}.txt", keys)
    run(spark, tmp_path, look_back=look_back)
    assert keys_of(run(spark, tmp_path, checkpoint="other", look_back=look_back)) == list("abcdef")


def test_redelivered_keys_are_skipped_within_the_window(spark, tmp_path):
    publish(tmp_path / "in", "1.txt", "ab")
    run(spark, tmp_path)
    publish(tmp_path / "in", "2.txt", "bc")
    assert keys_of(run(spark, tmp_path)) == list("abc")
    publish(tmp_path / "in", "3.txt", "ad")
    assert keys_of(run(spark, tmp_path, look_back=1)) == list("aabcd")
    stats = {r.batch_id: r for r in job.read_batch_stats(spark, str(tmp_path / "out")).collect()}
    assert [(stats[i].batch_size, stats[i].sentences, stats[i].io_operations) for i in range(3)] == [
        (2, 4, 2), (1, 2, 1), (2, 4, 2)]
    assert stats[1].docs_size == 2 * len("One b. Two.") and stats[1].time_taken > 0


def test_a_batch_retried_after_its_write_replaces_itself(spark, tmp_path):
    publish(tmp_path / "in", "1.txt", "ab")
    messages = spark.read.text(str(tmp_path / "in"))
    for _ in range(2):
        job._process(messages, 0, str(tmp_path / "out"), None, 200)
    assert keys_of(job.read_annotated(spark, str(tmp_path / "out"))) == ["a", "b"]


def test_look_back_reaches_over_small_batches(spark, tmp_path):
    for i, k in enumerate("abcdefg"):
        publish(tmp_path / "in", f"{i}.txt", k)
    run(spark, tmp_path)
    out = str(tmp_path / "out")
    assert len(keys_of(job._recently_stored(spark, f"{out}/annotated", 7, 3))) == 4
    assert keys_of(job._recently_stored(spark, f"{out}/annotated", 7, 200)) == list("abcdefg")
    assert job._recently_stored(spark, f"{out}/annotated", 0, 3) is None


def test_annotator_in_the_stream(spark, tmp_path):
    def annotator(batches):
        for b in batches:
            yield pd.DataFrame({"doc_key": b.doc_key, "doc_id": b.doc_id, "date": b.date,
                                "sentences": [[{"sen_id": 1, "sentence": "s", "tree": "t"}]] * len(b)})

    publish(tmp_path / "in", "1.txt", "a")
    stored = run(spark, tmp_path, annotator=annotator)
    assert stored.first().sentences[0].tree == "t"


def test_timed_trigger_flushes_what_waits(spark, tmp_path):
    publish(tmp_path / "in", "1.txt", "ab")
    stream = stream_messages(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = job.stream_annotate(stream, str(tmp_path / "out"), str(tmp_path / "ck"), every="1 second")
    try:
        query.processAllAvailable()
        publish(tmp_path / "in", "2.txt", "c")
        query.processAllAvailable()
    finally:
        query.stop()
    assert keys_of(job.read_annotated(spark, str(tmp_path / "out"))) == list("abc")


def run_with_state(spark, tmp_path, expiry="1 day"):
    stream = stream_messages(spark, str(tmp_path / "in"), files_per_trigger=1, arrival=True)
    query = job.stream_annotate(stream, str(tmp_path / "out"), str(tmp_path / "ck"), every=None, expiry=expiry)
    query.awaitTermination()
    return job.read_annotated(spark, str(tmp_path / "out")), query


def arrived(folder, name, seconds):
    import os

    os.utime(folder / name, (seconds, seconds))


def test_state_store_keeps_each_key_once_in_and_across_batches(spark, tmp_path):
    publish(tmp_path / "in", "1.txt", "abca", extra=["{broken", "{broken"])
    stored, _ = run_with_state(spark, tmp_path)
    assert keys_of(stored) == list("abc")
    assert len(job.read_quarantine(spark, str(tmp_path / "out")).collect()) == 1
    publish(tmp_path / "in", "2.txt", "bcd")
    publish(tmp_path / "in", "3.txt", "ad")
    stored, _ = run_with_state(spark, tmp_path)
    assert keys_of(stored) == list("abcd")


def test_state_is_bounded_by_the_expiry(spark, tmp_path):
    """Keys older than the expiry behind the watermark leave the state; a copy after that is stored again."""
    day = 86_400
    publish(tmp_path / "in", "1.txt", "ab")
    arrived(tmp_path / "in", "1.txt", 10 * day)
    run_with_state(spark, tmp_path)
    publish(tmp_path / "in", "2.txt", "c")
    arrived(tmp_path / "in", "2.txt", 13 * day)
    publish(tmp_path / "in", "3.txt", "d")
    arrived(tmp_path / "in", "3.txt", 13 * day)
    _, query = run_with_state(spark, tmp_path)
    state = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert state and state[-1] <= 2
    publish(tmp_path / "in", "4.txt", "ac")
    arrived(tmp_path / "in", "4.txt", 13 * day)
    stored, _ = run_with_state(spark, tmp_path)
    assert keys_of(stored) == list("aabcd")


@pytest.mark.parametrize("name, batches", [("stream_replay", 9)])
def test_the_queue_grows_in_files_and_not_in_micro_batches(spark, tmp_path, monkeypatch, name, batches):
    """No task writes a fixed share of the messages: every core has a file of its own at least."""
    from newsflow.plans import catalog

    n = 400
    docs = spark.createDataFrame([(i, f"One {i}. Two.", "en", "s") for i in range(n)], "doc_id bigint, text string, lang string, source string")
    # Copies of a row are stored once.
    docs.union(docs.where("doc_id < 40")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "shared_folder", lambda _, purpose: str(tmp_path / purpose))
    stored = getattr(catalog, name)(spark, str(tmp_path))
    assert sorted(int(r.mongo_id) for r in stored.select("mongo_id").collect()) == list(range(n))
    folder = tmp_path / name.removeprefix("stream_")
    sizes = [sum(1 for _ in open(f)) for f in (folder / "queue").glob("part-*")]
    assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism and max(sizes) <= n / 6
    assert len(list((folder / "out" / "annotated").glob("batch_id=*"))) == batches
