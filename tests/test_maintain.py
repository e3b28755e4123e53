import random

from pyspark.sql import functions as F

from newsflow.operators import joins, maintain, monitor


def keyed(spark, keys, start=1):
    rows = [(k, i) for i, k in enumerate(keys, start)]
    return spark.createDataFrame(rows, "doc_key string, ingest_seq bigint")


def test_recent_window(spark):
    stored = keyed(spark, "abcd")
    assert [r.doc_key for r in maintain.recent_ids(stored, 2).collect()] == ["d", "c"]
    assert [r.doc_key for r in maintain.newest_first(stored).collect()] == list("dcba")
    incoming = keyed(spark, "bce")
    assert sorted(r.doc_key for r in maintain.skip_processed(incoming, stored, 2).collect()) == ["b", "e"]
    assert [r.doc_key for r in maintain.skip_processed(incoming, stored).collect()] == ["e"]
    marked = {r.doc_key: r.skipped for r in maintain.mark_processed(incoming, stored, 2).collect()}
    assert marked == {"b": False, "c": True, "e": False}


def test_repeated_stored_keys_do_not_multiply_rows(spark):
    stored = keyed(spark, "aab")
    assert maintain.mark_processed(keyed(spark, "ab"), stored, 3).count() == 2


def test_keyed_merge(spark):
    stories = spark.createDataFrame([("1", "old"), ("2", "old"), ("3", None)], "doc_key string, corenlp_output string")
    updates = spark.createDataFrame(
        [("2", "w", 1), ("2", "x", 5), ("2", "v", 3), ("9", "y", 2)], "doc_key string, corenlp_output string, ingest_seq int")
    merged = {r.doc_key: r.corenlp_output for r in maintain.merge_annotations(stories, updates).collect()}
    assert merged == {"1": "old", "2": "x", "3": None}


def without_broadcast(spark, df_of):
    confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for c in confs:
        spark.conf.set(c, "-1")
    try:
        return df_of()
    finally:
        for c in confs:
            spark.conf.unset(c)


def test_a_hot_key_is_spread_over_many_tasks(spark):
    left = spark.range(0, 3000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("doc_key"), "id")
    right = spark.createDataFrame([("hot", "h"), ("1", "one"), ("none", "x")], "doc_key string, v string")

    def joined():
        df = joins.join_unique(left, right, "doc_key", "left", hot_rows=100)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(doc_key" in plan and ", _salt" in plan
        anti = joins.join_unique(left, right, "doc_key", "left_anti", hot_rows=100)
        return df.columns, df.collect(), anti.columns, anti.count()

    columns, rows, anti_columns, kept = without_broadcast(spark, joined)
    assert columns == ["doc_key", "id", "v"] and anti_columns == ["doc_key", "id"]
    assert len(rows) == 3000 and kept == 3000 - 1000 - 1
    assert sum(r.v == "h" for r in rows) == 1000 and sum(r.v == "one" for r in rows) == 1
    assert [r.doc_key for r in joins.hot_keys(left, "doc_key", 100).collect()] == ["hot"]


def test_first_n_by_key(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("doc_key"), "id")
    got = [r.doc_key for r in maintain.first_n(df, 7).collect()]
    assert got == [f"{i:04d}" for i in range(7)]
    repeated = df.unionByName(df)
    assert [r.doc_key for r in maintain.first_n(repeated, 3).collect()] == ["0000", "0000", "0001"]


def test_capped_shuffle_is_the_exact_head_of_the_permutation(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("doc_key"), F.lit("body").alias("b"))
    ranked = df.withColumn("r", maintain.shuffle_rank()).orderBy("r", "doc_key").limit(321)
    want = [r.doc_key for r in ranked.collect()]
    assert [r.doc_key for r in maintain.capped_shuffle(df, 321).collect()] == want
    assert maintain.capped_shuffle(df, 10**6).count() == 5000
    hot = df.withColumn("doc_key", F.when(F.col("doc_key").cast("int") % 3 == 0, "hot").otherwise(F.col("doc_key")))
    assert maintain.capped_shuffle(hot, 100).count() == 100


def test_running_totals_match_brute_force(spark):
    random.seed(7)
    rows = [(random.randrange(-10**6, 10**6), random.randrange(100)) for _ in range(3000)]
    rows += [(5, 1), (5, 2)]
    df = spark.createDataFrame(rows, "b bigint, n bigint")
    for buckets in (1, 16, 1024):
        got = {(r.b, r.total) for r in monitor.running_totals(df, "b", buckets, total="n").collect()}
        sums, by = 0, {}
        for b in sorted({b for b, _ in rows}):
            sums += sum(n for x, n in rows if x == b)
            by[b] = sums
        assert got == set(by.items())


def test_running_totals_keep_rows_without_a_value(spark):
    df = spark.createDataFrame([(None, 4), (1, 1), (9, 2)], "b bigint, n bigint")
    assert sorted((r.total, r.b) for r in monitor.running_totals(df, "b", total="n").collect()) == [(4, None), (5, 1), (7, 9)]


def test_progress_and_totals(spark):
    docs = spark.createDataFrame([(1,), (1,), (2,), (4,)], "batch_id bigint")
    rows = {r.batch_id: (r.batch_rows, r.total_rows, r.inserted_rows, r.remaining_rows) for r in monitor.progress(docs).collect()}
    assert rows == {1: (2, 4, 2, 2), 2: (1, 4, 3, 1), 4: (1, 4, 4, 0)}
    assert monitor.total_rows(docs).first().total_rows == 4


def test_batch_stats_count_skipped_bytes_only(spark):
    docs = spark.createDataFrame(
        [(1, "One. Two.", False), (1, "é", True), (2, None, False)], "batch_id int, article_body string, skipped boolean")
    got = {r.batch_id: tuple(r)[1:] for r in monitor.batch_stats(docs, skipped="skipped").collect()}
    assert got == {1: (1, 11, 2, 1), 2: (1, 0, 0, 1)}


def test_cumulative_documents_and_time(spark):
    stats = spark.createDataFrame([(0, 2, 1.5), (1, 3, 0.5)], "batch_id bigint, io_operations bigint, time_taken double")
    rows = monitor.cumulative(stats).orderBy("batch_id").collect()
    assert [(r.total_docs, r.total_time) for r in rows] == [(2, 1.5), (5, 2.0)]


def test_batch_averages_round_half_up(spark):
    stats = spark.createDataFrame([(1, 2), (2, 3)], "data_size int, batch_time int")
    assert tuple(monitor.batch_averages(stats).first()) == (2.0, 3.0)


def test_ranks_come_from_partition_offsets_not_one_task(spark):
    rows = [(f"k{i:04d}", (i * 7919) % 1000, "x") for i in range(1000)] + [(None, None, "y"), ("t", 5, "z")]
    df = spark.createDataFrame(rows, "doc_key string, ingest_seq bigint, v string")
    got = maintain.ranked(df, [F.desc("ingest_seq"), F.desc("doc_key")], partitions=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number()" in plan and "windowspecdefinition(_part" in plan
    assert "SinglePartition" not in plan
    ranks = sorted((r["rank"], r["ingest_seq"] if r["ingest_seq"] is not None else -1, r["doc_key"] or "")
                   for r in got.collect())
    assert [r[0] for r in ranks] == list(range(1, 1003))
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0] or ""), reverse=True)
    assert [(r[1] if r[1] is not None else -1, r[0] or "") for r in want] == [r[1:] for r in ranks]
    assert maintain.ranked(df.where("false"), [F.col("v")]).count() == 0
    newest = maintain.newest_first(keyed(spark, "abcd"))
    assert [(r.doc_key, r["rank"]) for r in newest.collect()] == [("d", 1), ("c", 2), ("b", 3), ("a", 4)]
