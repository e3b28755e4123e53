"""The bucketed store: updates rewrite only their buckets, and a failed run leaves the old state."""

import os

import pytest
from pyspark.sql import functions as F

from newsflow.operators import store
from newsflow.session import shared_folder


def files(path):
    """bucket folder -> {file name: modification time} of its data files."""
    out = {}
    for folder in sorted(os.listdir(path)):
        if folder.startswith(f"{store.BUCKET}="):
            full = os.path.join(path, folder)
            out[folder] = {f: os.stat(os.path.join(full, f)).st_mtime_ns for f in os.listdir(full) if f.endswith(".parquet")}
    return out


@pytest.fixture()
def stored(spark):
    path = shared_folder(spark, "store-test")
    rows = [(f"k{i}", i, None) for i in range(200)] + [("hot", 1000 + i, None) for i in range(60)] + [(None, 5000, None)]
    store.create(spark.createDataFrame(rows, "doc_key string, doc_id bigint, value string"), path, buckets=16)
    return path


def table(spark, path):
    return sorted((tuple(r) for r in store.read(spark, path).collect()), key=repr)


def test_updates_rewrite_only_their_buckets(spark, stored):
    before = files(stored)
    updates = spark.createDataFrame(
        [("k3", 1, "old"), ("k3", 2, "new"), ("hot", 1, "h"), ("absent", 1, "x"), (None, 1, "n")],
        "doc_key string, ingest_seq bigint, value string")
    touched = store.update(spark, stored, updates, "value", buckets=16)
    after = files(stored)
    names = {f"{store.BUCKET}={b}" for b in touched}
    assert 0 < len(names) < len(before)
    assert {b: f for b, f in after.items() if b not in names} == {b: f for b, f in before.items() if b not in names}
    got = table(spark, stored)
    assert len(got) == 261
    assert [r for r in got if r[0] == "k3"] == [("k3", 3, "new")]
    assert all(r[2] == "h" for r in got if r[0] == "hot")
    assert all(r[2] is None for r in got if r[0] not in ("k3", "hot"))


def test_no_update_writes_nothing(spark, stored):
    before = files(stored)
    empty = spark.createDataFrame([], "doc_key string, ingest_seq bigint, value string")
    assert store.update(spark, stored, empty, "value", buckets=16) == []
    assert files(stored) == before


def test_a_failed_run_leaves_the_old_state(spark, stored, monkeypatch):
    before, rows = files(stored), table(spark, stored)
    updates = spark.createDataFrame([("k1", 1, "v")], "doc_key string, ingest_seq bigint, value string")
    real = store.shared_folder

    def staging_then_fail(session, purpose):
        folder = real(session, purpose)
        monkeypatch.setattr(type(session.read), "parquet", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        return folder

    monkeypatch.setattr(store, "shared_folder", staging_then_fail)
    with pytest.raises(Exception):
        store.update(spark, stored, updates, "value", buckets=16)
    monkeypatch.undo()
    assert files(stored) == before and table(spark, stored) == rows


def test_the_update_reads_only_touched_buckets(spark, stored):
    updates = spark.createDataFrame([("k7", 1, "v")], "doc_key string, ingest_seq bigint, value string")
    bucket = spark.range(1).select(store.bucket_of(F.lit("k7"), 16)).first()[0]
    plan = spark.read.parquet(stored).where(F.col(store.BUCKET).isin([bucket]))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(bucket#" in plan and f" = {bucket})]" in plan
    store.update(spark, stored, updates, "value", buckets=16)
    assert [r for r in table(spark, stored) if r[2] == "v"] == [("k7", 7, "v")]
