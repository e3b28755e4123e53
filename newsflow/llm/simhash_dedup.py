"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within the radius of 3 bits differ in at most 2 bits once a
block that holds one of the differences is masked out. So every fingerprint is
taken with each of four 16-bit blocks masked, and emits all variants within
half of the remaining radius, 1 bit: 4 x 49 variants. Fingerprints within the
radius share a variant and meet in one group after a shuffle on the variants;
colliding pairs are verified on all 64 bits and deduplicated.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, materialised, text_or_empty

RADIUS = 3
SHINGLE = 3
SEED = 42
BLOCKS = 4
# Groups with more fingerprints than this are linked by the unmasked balls of ``dense_links``.
DENSE = 2_048
# Shingles whose bits are counted at once.
PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit number.

    A-Z are lower-cased, words are runs of anything but the six ASCII blanks,
    shingles are joined by a space and repeated as often as they occur. Fewer
    words than a shingle are one shingle; no words give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), PIECE):
        h = np.array([digest(s, seed) for s in shingles[start: start + PIECE]], dtype=">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, body, fp`` for every row; ``body`` is a hash that tells texts under one key apart."""

    def open_task():
        return lambda keys, bodies, texts: (keys, bodies, [fingerprint(t) for t in texts])

    rows = docs.select(F.col(key).cast("bigint"), F.xxhash64(F.col(text)), text_or_empty(F.col(text)).cast("binary"))
    return map_batches(rows, open_task, {"doc_id": "bigint", "body": "bigint", "fp": "bigint"})


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _literal_pairs(pairs: list[tuple[int, int]], names: tuple[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(a).cast("bigint").alias(names[0]), F.lit(b).cast("bigint").alias(names[1])) for a, b in pairs])


def masked_variants(fps: DataFrame) -> DataFrame:
    """``variant, fp``: each block masked, and each remaining bit flipped once or none.

    The masked block holds its number, so that variants of different masks do not
    meet; if they do by chance, verification drops the pair.
    """
    width = 64 // BLOCKS
    pairs = []
    for block in range(BLOCKS):
        mask = ((1 << width) - 1) << (block * width)
        mark = (block + 1) << (block * width)
        flips = [0] + [1 << bit for bit in range(64) if not mask >> bit & 1]
        pairs += [(_signed(~mask & (1 << 64) - 1), _signed(mark ^ flip)) for flip in flips]
    listed = fps.select("fp", F.explode(_literal_pairs(pairs, ("keep", "flip"))).alias("v"))
    return listed.select(F.col("fp").bitwiseAND(F.col("v.keep")).bitwiseXOR(F.col("v.flip")).alias("variant"), "fp")


def dense_variants(fps: DataFrame) -> DataFrame:
    """``variant, near, fp``: unmasked balls of 1 bit (``near``) and of 2 bits.

    Of three differing bits two lie in the same half, so flipping only pairs
    inside a half still lets the two balls meet. What meets in a group, with a
    near member, is within the radius by construction: nothing is left to verify,
    and a group cannot hold more than the 1,122 fingerprints around its variant.
    """
    near = [(1, 0)] + [(1, _signed(1 << b)) for b in range(64)]
    far = [(0, 0)] + [(0, _signed(1 << b)) for b in range(64)] + [
        (0, _signed(1 << a | 1 << b)) for half in (range(32), range(32, 64)) for a, b in combinations(half, 2)]
    listed = fps.select("fp", F.explode(_literal_pairs(near + far, ("near", "flip"))).alias("v"))
    return listed.select(F.col("fp").bitwiseXOR(F.col("v.flip")).alias("variant"), F.col("v.near").alias("near"), "fp")


def forest(group: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect exactly what chains of distances within ``radius`` connect."""
    links, left = [], group
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            fp = queue.pop()
            near = np.bitwise_count(left ^ fp) <= radius
            found = left[near]
            links += [(fp, other) for other in found]
            queue += list(found)
            left = left[~near]
    return links


def _runs(batches, columns: int, most: int):
    """Runs of equal first values in sorted batches.

    Yields the columns with ``starts, ends`` of the runs and whether each is above
    ``most`` rows. Such a run may come in several parts, all of them marked, so no
    run is ever held as a whole.
    """
    held = broken = None

    def marked(part, starts, ends):
        above = ends - starts > most
        above[0] |= broken is not None and part[0][0] == broken
        return part, starts, ends, above

    for batch in batches:
        part = [batch.column(i).to_numpy() for i in range(columns)]
        if not len(part[0]):
            continue
        if held is not None:
            part = [np.concatenate([a, b]) for a, b in zip(held, part)]
        cuts = np.flatnonzero(part[0][1:] != part[0][:-1]) + 1
        last = cuts[-1] if len(cuts) else 0
        long = len(part[0]) - last > most
        held = None if long else [a[last:].copy() for a in part]
        if long:
            last = len(part[0])
        if last:
            starts = np.concatenate([[0], cuts[cuts < last]]).astype(np.int64)
            yield marked(part, starts, np.append(starts[1:], last))
        if long:
            broken = part[0][-1]
    if held is not None:
        yield marked(held, np.array([0]), np.array([len(held[0])]))


def sparse_links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """``a, b`` (a < b) within the radius, and ``(fp, NULL)`` for members of groups above ``dense``."""

    def link(batches):
        for (variant, fp), starts, ends, crowded in _runs(batches, 2, dense):
            size = ends - starts
            two = starts[(size == 2) & ~crowded]
            x, y = fp[two].astype(np.uint64), fp[two + 1].astype(np.uint64)
            close = (np.bitwise_count(x ^ y) <= RADIUS) & (x != y)
            pairs = [(fp[two][close], fp[two + 1][close])]
            alone = []
            more = (size > 2) | crowded
            for s, e, above in zip(starts[more], ends[more], crowded[more]):
                group = np.unique(fp[s:e])
                if above:
                    alone.append(group)
                else:
                    found = forest(group.astype(np.uint64))
                    if found:
                        pairs.append(tuple(np.array(side, dtype=np.uint64).astype(np.int64) for side in zip(*found)))
            a, b = (np.concatenate(side) for side in zip(*pairs))
            low, high = np.minimum(a, b), np.maximum(a, b)
            single = np.concatenate(alone) if alone else np.array([], dtype=np.int64)
            none = np.concatenate([np.zeros(len(high), dtype=bool), np.ones(len(single), dtype=bool)])
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(np.concatenate([low, single])),
                "b": pa.array(np.concatenate([high, single]), mask=none)})

    grouped = masked_variants(fps).repartition("variant").sortWithinPartitions("variant", "fp")
    return grouped.mapInArrow(link, "a bigint, b bigint").distinct()


def dense_links(fps: DataFrame) -> DataFrame:
    """``a, b`` (a < b): stars that connect each unmasked group with a near member."""

    def link(batches):
        for (variant, near, fp), starts, ends, _ in _runs(batches, 3, 1 << 20):
            lows, highs = [], []
            for s, e in zip(starts, ends):
                if e - s > 1 and near[s:e].any():
                    group = np.unique(fp[s:e])
                    lows.append(np.full(len(group) - 1, group[0]))
                    highs.append(group[1:])
            if lows:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(lows), "b": np.concatenate(highs)})

    grouped = dense_variants(fps).repartition("variant").sortWithinPartitions("variant", "fp")
    return grouped.mapInArrow(link, "a bigint, b bigint").distinct()


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints whose closure is that of all pairs within the radius."""
    found = materialised(sparse_links(fps, dense), "simhash-links")
    pairs = found.where(F.col("b").isNotNull())
    crowded = found.where(F.col("b").isNull()).select(F.col("a").alias("fp"))
    if crowded.isEmpty():
        return pairs
    # A fingerprint outside every crowded group has met all its partners already.
    return pairs.unionByName(dense_links(crowded.distinct())).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges ``a < b``; the number of edges never grows.

    Large: every larger neighbour of a node is tied to the smallest of its
    neighbourhood; small: the node and its smaller neighbours are.
    """
    toward = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    if large:
        toward = toward.unionByName(edges.select(F.col("a").alias("node"), F.col("b").alias("other")))
    lowest = toward.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
    # Written first: both sides of the join are then plain exchanges, whose hot nodes the adaptive join splits.
    joined = toward.join(materialised(lowest, "simhash-low"), "node")
    tied = joined.where(F.col("other") > F.col("node")).select(F.col("low").alias("a"), F.col("other").alias("b")) if large else (
        joined.select(F.col("low").alias("a"), F.explode(F.array("other", "node")).alias("b")))
    return tied.where(F.col("a") < F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of the edges ``a < b`` reaches.

    Large and small contractions alternate until nothing changes; each result is
    written to the shared folder. No group of a component is ever collected.
    """
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.col("b") % 1_000_003)).first()

    edges = materialised(edges, "simhash-edges")
    before = state(edges)
    while before[0]:
        edges = materialised(_star(materialised(_star(edges, True), "simhash-edges"), False), "simhash-edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def classified(docs: DataFrame, key: str = "doc_id", text: str = "text", dense: int = DENSE) -> DataFrame:
    """``doc_id, body, fp, component_id, first`` for every row, copies of a fingerprint handled as one.

    ``first`` is true for the component's row with the smallest key, NULL last; ``body`` breaks ties.
    """
    rows = materialised(fingerprints(docs, key, text), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "body")
    fps = materialised(rows.groupBy("fp").agg(F.min(order).alias("least")), "simhash-distinct")
    roots = components(links(fps.select("fp"), dense))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialised(rooted, "simhash-roots")
    smallest = materialised(rooted.groupBy("root").agg(F.min("least").alias("keeper")), "simhash-least")
    classes = materialised(rooted.join(smallest, "root").select("fp", "keeper"), "simhash-classes")
    first = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("body") == F.col("keeper.body"))
    return rows.join(classes, "fp").select(
        "doc_id", "body", "fp", F.col("keeper.doc_id").alias("component_id"), first.alias("first"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", dense: int = DENSE) -> DataFrame:
    """One row per document: ``<key>, fingerprint`` (16 hex digits)``, component_id``.

    The component is the smallest key reachable over fingerprints that differ in
    at most 3 bits. NULL and empty texts have fingerprint zero and link like any
    other. NULL keys are never the smallest unless a component has no other.
    Repeated rows and ties each give their own row; other columns are not read;
    an empty table gives an empty table. Very long texts are read whole.

    Copies share one fingerprint, so everything after the first step works on
    distinct fingerprints only.
    """
    return classified(docs, key, text, dense).select(
        F.col("doc_id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns: one document of each component, that with the smallest key.

    A row is known by its key and its text. Of several texts under the smallest
    key one stays, and so does one text of a component without any key. Rows
    repeated with one key and one text cannot be told apart and stay or go together.
    Other columns, whatever their names, pass untouched.
    """
    gone = classified(docs, key, text).where(~F.col("first"))
    dropped_key, dropped_body = (_unused(docs.columns, name) for name in ("_dropped", "_body"))
    dropped = materialised(
        gone.select(F.col("doc_id").alias(dropped_key), F.col("body").alias(dropped_body)).distinct(), "simhash-dropped")
    same = docs[key].eqNullSafe(dropped[dropped_key]) & (F.xxhash64(docs[text]) == dropped[dropped_body])
    return docs.join(dropped, same, "left_anti")


def _unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column of ``columns`` has it, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
