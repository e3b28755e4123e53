"""Ranked lexical search by an exact sparse ball tree over integer term scores.

Documents are sparse vectors of integer term scores; a query is the sparse
vector of its terms' weights, repeats counted; a document's score is the
inner product. Corpus statistics (document count, term count, document
frequencies) are DataFrame aggregates over all documents.

The documents are dealt into shards by a hash of their row; each shard builds a
ball tree: every node keeps the centroid of its documents and the largest
distance of one of them from it, so that no document below scores more than
``q . c + |q| |r|``. The bound is taken in floating point and widened by a
relative margin far above the rounding error, then subtrees are opened best
first and pruned once the bound falls below the tenth best score. Leaves are
scored exactly in 64-bit integers. Each shard meets every block of queries in
one task (a stated query set against all rows, in blocks); the ten best of
each shard are merged per item.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.llm.common import lower_ascii, materialised

# Fixed values of the operator's contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
SCALE = 1_000_000_000

# Documents per shard and queries per block: what one task holds.
SHARD_DOCS = 4_000
BLOCK_QUERIES = 2_000
# Documents in a leaf of the tree.
LEAF = 128
# Relative and absolute widening of a floating-point bound; rounding errors are far below.
MARGIN = 1e-7


# The characters between terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    """The maximal matches of ``TERM``, A-Z lower-cased: the text split at runs of the other characters."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def document_vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """``row, doc_id, n, idx (distinct terms, sorted), tf``; term weights ``term, w``; and N.

    Term frequencies are counted inside each document by sorting its terms and
    measuring the runs, on the map side: no term of a document is shuffled.
    ``row`` tells repeated rows apart; it is fixed once written.
    """
    terms_of = docs.select(F.col(key).alias("doc_id"), terms(F.col(text)).alias("t")).where(F.size("t") > 0)
    sorted_terms = F.array_sort("t")
    starts = F.filter(F.sequence(F.lit(1), F.size("t")),
                      lambda i: F.when(i == 1, F.lit(True)).otherwise(F.element_at("t", i) != F.element_at("t", i - 1)))
    counted = terms_of.select("doc_id", sorted_terms.alias("t")).select(
        "doc_id", "t", starts.alias("starts")).select(
        "doc_id", F.size("t").cast("bigint").alias("n"),
        F.transform("starts", lambda i: F.element_at("t", i)).alias("idx"),
        F.transform("starts", lambda i, j: F.coalesce(
            F.try_element_at("starts", (j + 2).cast("int")), F.size("t") + 1) - i).cast("array<bigint>").alias("tf"))
    vectors = materialised(counted.withColumn("row", F.monotonically_increasing_id()), "search-vectors")
    totals = vectors.agg(F.count("*").alias("big_n"), F.sum("n").alias("big_l")).first()
    big_n, big_l = int(totals["big_n"]), int(totals["big_l"] or 0)
    weights = vectors.select(F.explode("idx").alias("term")).groupBy("term").agg(F.count("*").alias("df")).select(
        "term", F.floor(1000 * F.log((2.0 * big_n + 2) / (2.0 * F.col("df") + 1))).cast("bigint").alias("w"))
    m = f"(CAST({100 - 75} AS BIGINT) + (75 * n * CAST({big_n} AS BIGINT)) div CAST({max(big_l, 1)} AS BIGINT))"
    scores = F.expr(f"transform(tf, f -> (CAST({SCALE} AS BIGINT) * f) div (1000 * f + 8 * {m}))")
    return vectors.select("row", "doc_id", "idx", scores.alias("val")), weights, big_n


def query_vectors(items: DataFrame, weights: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, idx, val``: each query term with its weight times its count; terms no document holds add nothing."""
    numbered = items.select(F.col(key).alias("item_id"), F.col(text).alias("text")).withColumn(
        "query", F.monotonically_increasing_id())
    counted = numbered.select("query", "item_id", F.explode(terms(F.col("text"))).alias("term")).groupBy(
        "query", "item_id", "term").count()
    weighted = counted.join(weights, "term").select("query", "item_id", "term", (F.col("w") * F.col("count")).alias("q"))
    return weighted.where(F.col("q") > 0).groupBy("query", "item_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "q"))).alias("entries")).select(
        "query", "item_id", F.col("entries.term").alias("idx"), F.col("entries.q").alias("val"))


class BallTree:
    """A ball tree over sparse integer vectors in CSR form (``indptr``, ``indices``, ``data``)."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, width: int):
        self.indptr, self.indices, self.data = indptr, indices, data
        self.norms = np.sqrt(np.add.reduceat(data.astype(float) ** 2, indptr[:-1])) if len(data) else np.zeros(0)
        self.norms[np.diff(indptr) == 0] = 0.0
        self.scratch = np.zeros(width)
        self.nodes = []  # (centroid indices, centroid values, radius, children, members, radius per term)
        self._build(np.arange(len(indptr) - 1))

    def _entries(self, members: np.ndarray):
        """Columns, values, owning member (0 to len - 1) and positions of the members' entries."""
        starts, lengths = self.indptr[members], self.indptr[members + 1] - self.indptr[members]
        take = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        return self.indices[take], self.data[take].astype(float), np.repeat(np.arange(len(members)), lengths), take

    def _dots(self, members: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        """Inner products of the members with one sparse vector."""
        self.scratch[idx] = val
        cols, vals, owner, _ = self._entries(members)
        dots = np.bincount(owner, weights=vals * self.scratch[cols], minlength=len(members))
        self.scratch[idx] = 0.0
        return dots

    def _build(self, members: np.ndarray) -> int:
        cols, vals, owner, _ = self._entries(members)

        def dots(idx: np.ndarray, val: np.ndarray) -> np.ndarray:
            """Inner products of the members with one sparse vector, on the entries taken once."""
            self.scratch[idx] = val
            out = np.bincount(owner, weights=vals * self.scratch[cols], minlength=len(members))
            self.scratch[idx] = 0.0
            return out

        # The node's terms, sorted, and per term the mean (the centre) and the largest value, by one sort.
        order = np.argsort(cols, kind="stable")
        by_term, values = cols[order], vals[order]
        firsts = np.flatnonzero(np.r_[True, by_term[1:] != by_term[:-1]]) if len(by_term) else np.zeros(0, np.int64)
        idx = by_term[firsts]
        centre = np.add.reduceat(values, firsts) / max(len(members), 1) if len(firsts) else np.zeros(0)
        # The radius along each term: how far the farthest member lies above the centre there.
        reach = np.maximum(np.maximum.reduceat(values, firsts) - centre, 0.0) if len(firsts) else np.zeros(0)
        del order, by_term, values, firsts
        norms2 = self.norms[members] ** 2
        dist = np.sqrt(np.maximum(norms2 - 2 * dots(idx, centre) + float(centre @ centre), 0.0))
        radius = float(dist.max()) if len(members) else 0.0
        node = len(self.nodes)
        self.nodes.append(None)
        children, leaf = (), members
        if len(members) > LEAF and radius > 0:
            a = members[int(np.argmax(dist))]
            to_a = norms2 - 2 * dots(*self._row(a)) + self.norms[a] ** 2
            b = members[int(np.argmax(to_a))]
            to_b = norms2 - 2 * dots(*self._row(b)) + self.norms[b] ** 2
            # Halves by the median of the difference, so that the tree stays balanced.
            near_a = np.zeros(len(members), dtype=bool)
            near_a[np.argsort(to_a - to_b, kind="stable")[: len(members) // 2]] = True
            # The entries of this node are let go before the halves take their own.
            del cols, vals, owner, dots, dist, to_a, to_b, norms2
            children, leaf = (self._build(members[near_a]), self._build(members[~near_a])), None
        self.nodes[node] = (idx, centre, radius, children, leaf, reach)
        return node

    def _row(self, i: int):
        s, e = self.indptr[i], self.indptr[i + 1]
        return self.indices[s:e], self.data[s:e].astype(float)

    def _centre_dots(self, node: int, q_idx: np.ndarray, q_val: np.ndarray) -> tuple[float, float]:
        """``q . c`` and ``q . r``, the radius per term, over the query's terms only (the node's terms are sorted)."""
        idx, centre, reach = self.nodes[node][0], self.nodes[node][1], self.nodes[node][5]
        if not len(idx):
            return 0.0, 0.0
        at = np.minimum(np.searchsorted(idx, q_idx), len(idx) - 1)
        hit = idx[at] == q_idx
        return float(q_val[hit] @ centre[at[hit]]), float(q_val[hit] @ reach[at[hit]])

    def leaf_scores(self, leaf: np.ndarray, q_int: np.ndarray) -> np.ndarray:
        """Exact 64-bit scores of a leaf's members."""
        cols, _, owner, take = self._entries(leaf)
        scores = np.zeros(len(leaf), dtype=np.int64)
        np.add.at(scores, owner, q_int[cols] * self.data[take])
        return scores

    def search(self, q_idx: np.ndarray, q_val: np.ndarray, keys: np.ndarray, rows: np.ndarray, top: int = TOP):
        """The ``top`` members of highest positive score, ties by key then row, as ``(score, member)``."""
        q_float = q_val.astype(float)
        q_int = np.zeros(len(self.scratch), dtype=np.int64)
        q_int[q_idx] = q_val
        q_norm = math.sqrt(float(q_float @ q_float))
        best = []  # min-heap of (score, -key, -row, member): the worst of the best on top

        def bound(node):
            # No member scores more than the centre plus the radius: the ball's, |q| r, or that along
            # the query's own terms, sum q_t r_t, whichever is smaller.
            centre, along = self._centre_dots(node, q_idx, q_float)
            spread = min(q_norm * self.nodes[node][2], along)
            ub = centre + spread
            return ub + MARGIN * (abs(centre) + spread) + 1.0

        frontier = [(-bound(0), 0)]
        while frontier:
            negative, node = heapq.heappop(frontier)
            floor = best[0][0] if len(best) == top else 1
            if -negative < floor:
                break
            children, leaf = self.nodes[node][3], self.nodes[node][4]
            if leaf is None:
                for child in children:
                    heapq.heappush(frontier, (-bound(child), child))
                continue
            scores = self.leaf_scores(leaf, q_int)
            # Only members that can enter the ten best reach Python.
            can = scores >= max(floor, 1)
            for member, score in zip(leaf[can].tolist(), scores[can].tolist()):
                entry = (score, -int(keys[member]), -int(rows[member]), member)
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return sorted(((s, m) for s, _, _, m in best), key=lambda p: (-p[0], keys[p[1]], rows[p[1]]))


def _search_shard(docs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The ten best documents of one shard for each query of one block."""
    empty = pd.DataFrame({"query": pd.Series([], dtype="int64"), "item_id": pd.Series([], dtype="object"), "unnamed": pd.Series([], dtype=bool),
                          "doc_id": pd.Series([], dtype="int64"), "doc_unnamed": pd.Series([], dtype=bool),
                          "row": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="int64")})
    if docs.empty or queries.empty:
        return empty
    vocabulary = {}
    indices, lengths = [], []
    for terms_of in docs["idx"]:
        indices.extend(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of)
        lengths.append(len(terms_of))
    indptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = np.concatenate([np.asarray(v, dtype=np.int64) for v in docs["val"]]) if len(docs) else np.zeros(0, np.int64)
    tree = BallTree(indptr, np.asarray(indices, dtype=np.int64), data, len(vocabulary))
    keys, rows = docs["doc_id"].to_numpy(np.int64), docs["row"].to_numpy(np.int64)
    unnamed_docs = docs["doc_unnamed"].to_numpy(bool)
    out = []
    for query, item, unnamed, q_terms, q_vals in zip(
            queries["query"], queries["item_id"], queries["unnamed"], queries["idx"], queries["val"]):
        pairs = [(vocabulary[t], v) for t, v in zip(q_terms, q_vals) if t in vocabulary]
        if not pairs:
            continue
        q_idx = np.array([p[0] for p in pairs], dtype=np.int64)
        q_val = np.array([p[1] for p in pairs], dtype=np.int64)
        for score, member in tree.search(q_idx, q_val, keys, rows):
            out.append((int(query), item, bool(unnamed), int(keys[member]), bool(unnamed_docs[member]), int(rows[member]), int(score)))
    if not out:
        return empty
    return pd.DataFrame(out, columns=["query", "item_id", "unnamed", "doc_id", "doc_unnamed", "row", "score"])


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ten best documents with a score above 0, all if fewer.

    Terms are maximal ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with
    A-Z lower-cased. ``w = floor(1000 ln((2N+2)/(2df+1)))``, a document's
    ``m = 25 + (75 n N) div L`` and its score sums
    ``w ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms, repeats
    included, all in 64-bit integers. Equal scores rank by ascending key.

    NULL texts hold no term; documents without a term never score; items
    without a term, or whose terms no document holds, give no rows. Repeated
    documents are ranked each; repeated items are searched each. NULL
    ``item_id`` items are searched like others; a NULL document key ranks after
    every key. Other columns are not read, whatever their names; empty tables
    give no rows; very long texts are read whole. ``item_id`` keeps its type.
    """
    vectors, weights, big_n = document_vectors(docs, key, text)
    item_type = items.schema[item_key].dataType.simpleString()
    queries = materialised(query_vectors(items.select(
        F.col(item_key).cast("string").alias("item_id"), F.col(item_key).isNull().alias("unnamed"),
        F.col(item_text).alias("text")), weights).select(
        "query", "item_id", F.col("item_id").isNull().alias("unnamed"), "idx", "val"), "search-queries")
    n_queries = queries.count()
    shards = max(1, -(-big_n // SHARD_DOCS))
    blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    # NULL keys rank after every key; they go to Python as the largest key and come back as NULL.
    dealt = vectors.select(
        F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("doc_id"), F.col("doc_id").isNull().alias("doc_unnamed"),
        "row", "idx", "val", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("bigint").alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"))
    asked = queries.select(
        "query", "item_id", "unnamed", "idx", "val", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("bigint").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
    schema = "query bigint, item_id string, unnamed boolean, doc_id bigint, doc_unnamed boolean, row bigint, score bigint"
    found = dealt.select("shard", "block", "doc_id", "doc_unnamed", "row", "idx", "val").groupBy("shard", "block") \
        .cogroup(asked.groupBy("shard", "block")).applyInPandas(_search_shard, schema)
    # At most ten rows per item and shard reach the ranking.
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= TOP).select(
        F.when(~F.col("unnamed"), F.col("item_id")).cast(item_type).alias("item_id"),
        F.col("rank").cast("int").alias("rank"),
        F.when(~F.col("doc_unnamed"), F.col("doc_id")).alias("doc_id"), "score")
