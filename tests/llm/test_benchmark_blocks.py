"""Benchmark items without a key, and many items under one key."""

from newsflow.llm import decontaminate


def passage(i):
    return " ".join(f"word{i} {w}" for w in "one two three four five six seven eight".split())


def test_items_without_a_key_clean_documents(spark):
    items = spark.createDataFrame([(None, passage(1)), (None, passage(2)), (3, passage(3)), (None, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"before {passage(i)} after") for i in range(6)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in decontaminate.cleaned(docs, items).collect()) == [0, 4, 5]
    assert [tuple(r)[:2] for r in decontaminate.leaks(docs, items).collect()] == [(3, 3)]


def test_blocks_of_one_key_are_bounded(spark):
    """Items under one key are dealt over the blocks."""
    items = spark.createDataFrame([(7, passage(i)) for i in range(60)], "item_id bigint, text string")
    chars = sum(len(passage(i)) + 20 for i in range(60))
    for named in (True, False):
        sizes = [sum(len(g.ids) for g in x.classes.values()) for x in decontaminate.indexes(items, block_chars=chars // 6, named=named)]
        assert sum(sizes) == 60 and max(sizes) <= 30
