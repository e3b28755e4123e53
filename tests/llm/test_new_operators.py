"""Spelling variants, ranked lexical search and source mixing: against brute force, with odd rows."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from conftest import SMALL  # noqa: E402

from newsflow.llm import queries, spelling  # noqa: E402

# Column names the operators use inside, given as extra input columns.
CLASH = ["word", "form", "root", "n", "near", "near_n", "prefix", "whole", "run", "best", "moved", "size", "rate",
         "copies", "source_size", "target", "taken", "score", "term", "tf", "df", "shard", "block", "rank"]


def with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def test_spelling_query_matches_brute_force(spark, documents):
    got = {r["word"]: tuple(r)[1:6] for r in queries.op11_spelling_variants(spark, SMALL).collect()}
    assert got == {w: (f, r, n, k, fn) for w, (f, r, n, k, fn) in brute.spelling(documents).items()}
    assert any(v[0] for v in got.values())


SPELLINGS = (
    ["colour"] * 200 + ["colours"] * 6 + ["coluor"] * 5 + ["colourr"] * 40 + ["colourrr"] * 8 + ["Colouur"] * 5 + ["cölour"] * 5
    + ["theatre"] * 40 + ["theater"] * 8 + ["theaterr"] * 5 + ["abcdef"] * 5 + ["abcdeg"] * 5 + ["abcdeh"] * 5
)


def test_spelling_on_odd_rows(spark):
    long = "abc " * 100_000 + "Théâtre"
    data = [(i, w) for i, w in enumerate(SPELLINGS)] + [
        (None, None), (1000, ""), (1001, "12345 !!"), (None, "colour colour"), (2000, long), (2000, long)]
    docs = with_clashes(spark.createDataFrame(data, "doc_id bigint, text string")).repartition(4)
    got = {r["word"]: tuple(r)[1:6] for r in spelling.variants(docs).collect()}
    assert got == brute.spelling(data)
    # Chains are followed; ties go to the smaller word; a form needs five times the count.
    assert got["colourrr"][:2] == ("colourr", "colour")
    assert got["abcdef"][0] is None and got["abcdef"][3] == 2
    assert spelling.variants(docs.where("false")).count() == 0


def test_permuterm_keys_find_every_edit():
    """Replacements share a cut rotation; a deletion meets the shorter word's whole rotation."""
    def cut(w):
        return {w[i + 1:] + "$" + w[:i] for i in range(len(w))}

    def whole(w):
        m = w + "$"
        return {m[j:] + m[:j] for j in range(len(m))}

    assert cut("colour") & cut("coluur")
    assert cut("colour") & whole("color")
    assert not cut("colour") & cut("clour") and not cut("colour") & cut("coulor")


def test_mixing_query_matches_brute_force(spark):
    from newsflow.llm import mixing

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    first = queries.op13_source_mixing(spark, SMALL)
    got = sorted(tuple(r) for r in first.select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == sorted(brute.mixing(rows, mixing.targets))
    again = sorted(tuple(r) for r in queries.op13_source_mixing(spark, SMALL).select("doc_id", "taken").collect())
    assert again == [(g[0], g[4]) for g in got]


def test_mixing_targets_share_all_words_and_stop_at_three_times():
    from newsflow.llm import mixing

    goal = mixing.targets({"b": 100, "a": 10, None: 1000, "c": 0})
    # a, b, c, NULL weigh 5, 2, 1, 5; a and c stop at 3 times their size; of the rest b's share,
    # 1080 * 2 / 7, is above 300 in turn, and NULL takes what is left.
    assert goal["a"] == 30 and goal["c"] == 0 and goal["b"] == 300 and goal[None] == 780
    assert sum(goal.values()) == pytest.approx(1110)
    assert mixing.targets({}) == {} and mixing.targets({"x": 0}) == {"x": 0.0}


def test_mixing_on_odd_rows(spark):
    from newsflow.llm import mixing

    long = "word " * 200_000
    data = [(1, "a b c", "s1"), (2, None, "s1"), (None, "x y", "s1"), (None, "x y", "s1"), (3, "", None),
            (4, "p q r s", None), (5, long, "s2"), (5, long, "s2"), (6, "\t\n ", "s2"), (7, "one", "s3")]
    docs = with_clashes(spark.createDataFrame(data, "doc_id bigint, text string, source string")).repartition(3)
    got = mixing.mix(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["taken"]) for r in got) == sorted(
        (i is None, i or 0, k) for i, _, _, _, k in brute.mixing(data, mixing.targets))
    assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in got)
    assert mixing.mix(docs.where("false")).count() == 0


def test_mixing_splits_a_large_source_into_blocks(spark, monkeypatch):
    from newsflow.llm import mixing

    monkeypatch.setattr(mixing, "BLOCK_ROWS", 7)
    data = [(i, "w " * (1 + i % 13), "hot" if i % 3 else f"s{i % 2}") for i in range(120)]
    got = mixing.mix(spark.createDataFrame(data, "doc_id bigint, text string, source string")).collect()
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    goal = mixing.targets(sizes)
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    blocks = {s: -(-sum(1 for d in data if d[2] == s) // 7) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= blocks[s] * 13 / 2


def test_search_on_odd_rows(spark):
    from newsflow.llm import lexical_search

    docs = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry date egg"), (4, "apple"), (4, "apple"),
            (None, "apple apple"), (5, None), (6, ""), (7, "!!! 123"), (8, "Apple BANANA " * 5_000), (0, "egg")]
    items = [(10, "apple cherry"), (11, "banana banana"), (12, None), (13, "zebra"), (10, "egg"), (None, "date")]
    d = with_clashes(spark.createDataFrame(docs, "doc_id bigint, text string")).repartition(3)
    q = with_clashes(spark.createDataFrame(items, "item_id bigint, text string")).repartition(2)
    got = [tuple(r) for r in lexical_search.search(d, q).collect()]
    want = []
    for item, text in items:
        want += [(item, rank, doc, score) for _, rank, doc, score in brute.lexical_search(docs, [(item, text)])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert lexical_search.search(d.where("false"), q).count() == 0
    assert lexical_search.search(d, q.where("false")).count() == 0


def test_ball_tree_is_exact_and_prunes(monkeypatch):
    """Random sparse vectors in deep trees: the ten best of brute force, and most leaves never opened."""
    import numpy as np

    from newsflow.llm import lexical_search

    monkeypatch.setattr(lexical_search, "LEAF", 4)
    rng = np.random.default_rng(7)
    width, docs = 300, 600
    rows = [np.unique(rng.integers(0, width, rng.integers(1, 30))) for _ in range(docs)]
    # Planted near copies of one document, which its query should find first.
    rows[:20] = [rows[0]] * 20
    data = [rng.integers(1, 10**6, len(r)) for r in rows]
    indptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    tree = lexical_search.BallTree(indptr, np.concatenate(rows), np.concatenate(data).astype(np.int64), width)
    keys, order = rng.permutation(docs).astype(np.int64), np.arange(docs)
    dense = np.zeros((docs, width), dtype=np.int64)
    for i, (r, v) in enumerate(zip(rows, data)):
        dense[i, r] = v
    opened = []
    real = tree.leaf_scores
    monkeypatch.setattr(tree, "leaf_scores", lambda m, q: opened.append(len(m)) or real(m, q))
    for _ in range(30):
        q_idx = np.unique(rng.integers(0, width, 12))
        q_val = rng.integers(1, 30_000, len(q_idx))
        scores = dense[:, q_idx] @ q_val
        want = sorted((i for i in range(docs) if scores[i] > 0), key=lambda i: (-scores[i], keys[i]))[:10]
        assert [m for _, m in tree.search(q_idx, q_val, keys, order)] == want
    q_idx = rows[0]
    opened.clear()
    tree.search(q_idx, np.full(len(q_idx), 30_000), keys, order)
    assert sum(opened) < docs / 2
