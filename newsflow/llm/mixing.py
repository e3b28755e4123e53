"""Mixing sources to target weights by entropy balancing.

Documents get rates ``r_d`` that stay as close as possible, in relative
entropy, to taking every word once, under the constraint that each source's
taken words, ``sum size_d * r_d`` over its documents, equal its target. The
dual of that convex problem has one variable per constraint, and its solution
tilts every document exponentially: ``r_d = exp(lambda . x_d)``, where
``x_d`` marks the document's source. Newton's method solves the dual; the
gradient and Hessian are sums over documents, gathered by one distributed
aggregate per source (the tilt is constant inside a source, so the sums need
not be taken again per step).

Rates are rounded into whole copies by carrying the rounding error from one
document to the next, in a fixed hash order, inside blocks of at most
``BLOCK_ROWS`` documents of one source. A source that holds a third of all
rows is split into as many blocks as its size asks for.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import materialised

# Fixed values of the operator's contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3

# Documents of one source rounded in one Python call.
BLOCK_ROWS = 200_000
# Sources whose per-source row is sent to every task; above, the row is joined by a shuffle.
BROADCAST_SOURCES = 100_000


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size``: the number of runs of non-blank characters, 0 for NULL."""
    return docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def targets(sizes: dict) -> dict:
    """Each source's target in words, from its size.

    Sources in code-point order, NULL last, weigh 5, 2, 1, 5, ...; together
    they share all words. A target stops at three times its source's size; what
    it would take beyond goes to the others by weight, until none is above.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + (
        [None] if None in sizes else [])
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    capped: dict = {}
    while True:
        free = [s for s in order if s not in capped]
        budget = total - sum(capped.values())
        share = sum(weight[s] for s in free)
        over = [s for s in free if budget * weight[s] / share > MOST_COPIES * sizes[s]]
        if not over:
            break
        capped |= {s: float(MOST_COPIES * sizes[s]) for s in over}
    return capped | {s: budget * weight[s] / share for s in free}


def tilts(words: np.ndarray, wanted: np.ndarray, steps: int = 100) -> np.ndarray:
    """Newton's method on the dual ``sum_s W_s exp(l_s) - l_s t_s``: the ``l`` with ``W exp(l) = t``.

    Sources without words or without a target keep ``-inf`` (rate 0).
    """
    live = (words > 0) & (wanted > 0)
    lam = np.zeros(len(words))
    for _ in range(steps):
        taken = words * np.exp(lam)
        gradient = np.where(live, taken - wanted, 0.0)
        if np.all(np.abs(gradient) <= 1e-12 * np.maximum(wanted, 1.0)):
            break
        lam = lam - np.where(live, gradient / np.where(live, taken, 1.0), 0.0)
    return np.where(live, lam, -np.inf)


def _rounded(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for one block: the rounding error is carried from document to document."""
    rows = rows.sort_values(["order", "unnamed", "doc_id", "size"], kind="mergesort")
    rate = float(rows["rate"].iloc[0]) if len(rows) else 0.0
    base = min(math.floor(rate), MOST_COPIES)
    owed = 0.0
    copies = []
    for size in rows["size"].tolist():
        owed += (rate - base) * size
        extra = 1 if base < MOST_COPIES and size > 0 and owed >= size / 2 else 0
        owed -= extra * size
        copies.append(base + extra)
    out = rows[["doc_id", "unnamed", "source", "size", "source_size", "target", "rate"]].copy()
    out["copies"] = np.asarray(copies, dtype="int64")
    out["taken"] = out["copies"] * out["size"]
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    ``target`` is the document's source's target in words (see :func:`targets`),
    ``rate`` the tilted rate of its source, ``copies`` the whole number of times
    the mix takes it, at most 3, and ``taken = copies * size``. Each source's
    taken words differ from its target by at most half its largest document per
    block. NULL texts have size 0 and are never taken; NULL sources form one
    source, ordered last; NULL keys are rounded last in their block. Repeated
    rows count each time. Other columns are not read, whatever their names; an
    empty table gives no rows. Reruns give the same rows: the order of rounding
    is ``xxhash64(doc_id)``, then the key and size.
    """
    spark = docs.sparkSession
    rows = materialised(sized(docs, key, text, source), "mixing-sizes")
    # One row per source: bounded by the number of sources, not of documents.
    stats = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).collect()
    names = [r["source"] for r in stats]
    sizes = {r["source"]: int(r["words"]) for r in stats}
    goal = targets(sizes)
    lam = tilts(np.array([sizes[s] for s in names], dtype=float), np.array([goal[s] for s in names], dtype=float))
    per_source = spark.createDataFrame(
        [(s, sizes[s], goal[s], float(np.exp(l)) if np.isfinite(l) else 0.0, max(1, -(-int(r["rows"]) // BLOCK_ROWS)))
         for s, l, r in zip(names, lam, stats)],
        "_source string, source_size bigint, target double, rate double, blocks bigint")
    if len(names) <= BROADCAST_SOURCES:
        per_source = F.broadcast(per_source)
    order = F.xxhash64(F.col("doc_id"))
    # Keys go to Python without NULLs, so that pandas keeps them as 64-bit integers.
    tilted = rows.join(per_source, rows["source"].eqNullSafe(per_source["_source"])).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("unnamed"), "source", "size",
        order.alias("order"), "source_size", "target", "rate", F.pmod(order, F.col("blocks")).alias("block"))
    schema = ("doc_id bigint, unnamed boolean, source string, size bigint, source_size bigint, target double, "
              "rate double, copies bigint, taken bigint")
    rounded = tilted.groupBy("source", "block").applyInPandas(_rounded, schema)
    return rounded.select(
        F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id"), "source", "size", "source_size", "target", "rate",
        "copies", "taken")
