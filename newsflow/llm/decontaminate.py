"""Benchmark decontamination by SimHash windows and exact shingle similarity.

For every benchmark item, windows of the item's size slide over each document.
A window's SimHash is looked up in Hamming blocks: within the radius at least
one of eight bytes differs in at most an eighth of the radius, so all
fingerprints within the radius are found. Candidates are then compared by the
weighted similarity of their shingles, which decides. A window that shares no
shingle with the item has similarity zero and is not taken up at all.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import filter_batches, map_batches, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
# At similarity 0.8 about 10 of 64 bits differ, with a deviation of 3: 24 is five deviations away.
RADIUS = 24
BYTES = 8
# Benchmark text that travels with the tasks at once; a larger benchmark is searched in several passes.
BLOCK_CHARS = 4_000_000
# Neighbouring windows compared at once, and the most (window, item) pairs in their table of one byte each.
WINDOWS = 2_048
TABLE = 1 << 25
WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall(text.lower())


def shingles(words: list, size: int) -> list[tuple]:
    return list(zip(*(words[i:] for i in range(size))))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: each shingle weighs as often as it occurs."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def _digests(found: list[tuple[str, ...]]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(" ".join(s)) for s in found], dtype=">u8")


def window_fingerprints(digests: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash bytes of the windows of ``width`` shingles at ``starts``, by running sums of bits."""
    bits = np.unpackbits(digests.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.vstack([np.zeros((1, 64), dtype=np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return np.packbits((sums[starts + width] - sums[starts]) * 2 > width, axis=1)


_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


@dataclass
class SizeClass:
    """Items of one number of words, with their block index."""

    words: int
    shingle: int
    ids: list[int] = field(default_factory=list)
    weights: list[Counter] = field(default_factory=list)
    prints: list[np.ndarray] = field(default_factory=list)
    index: np.ndarray | None = None  # block x byte value x item: may the item be within the radius?

    def close(self) -> None:
        block = np.array(self.prints)
        self.index = np.stack([_NEAR[:, block[:, b]] <= RADIUS // BYTES for b in range(BYTES)])
        self.prints = block


@dataclass
class Index:
    vocabulary: dict[str, int]
    classes: dict[int, SizeClass]
    # Shingle of word numbers -> [(size class, place of the item in it)].
    holders: dict[tuple[int, ...], list[tuple[int, int]]]
    sizes: list[int]  # shingle sizes in use
    keys: dict[int, np.ndarray]  # by shingle size: sorted 64-bit keys of the shingles


def _keys(numbers: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit key per shingle of word numbers; keys of equal shingles are equal."""
    n = len(numbers) - size + 1
    key = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        key = (key ^ numbers[i: i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def build_index(items: list[tuple[int, str]]) -> Index:
    """The index of benchmark items; items without a word cannot be found and are left out."""
    index = Index({}, {}, {}, [], {})
    for item, text in items:
        words = words_of(text or "")
        if not words:
            continue
        size = min(SHINGLE, len(words))
        group = index.classes.setdefault(len(words), SizeClass(len(words), size))
        found = shingles(words, size)
        numbers = [index.vocabulary.setdefault(w, len(index.vocabulary) + 1) for w in words]
        for shingle in set(shingles(numbers, size)):
            index.holders.setdefault(shingle, []).append((len(words), len(group.ids)))
        group.ids.append(item)
        group.weights.append(Counter(found))
        group.prints.append(window_fingerprints(_digests(found), np.array([0]), len(found))[0])
    for group in index.classes.values():
        group.close()
    index.sizes = sorted({g.shingle for g in index.classes.values()})
    for size in index.sizes:
        own = np.array([s for s in index.holders if len(s) == size], dtype=np.int64)
        index.keys[size] = np.unique(np.concatenate([_keys(row, size) for row in own]))
    return index


def search(text: str, index: Index) -> list[tuple[int, float, int, int, int]]:
    """Items found in a text: ``(item, similarity, first word, words, differing bits)``.

    The best window of each item counts, the first of equal ones.
    """
    words = words_of(text)
    known = index.vocabulary.get
    numbers = np.array([known(w, 0) for w in words], dtype=np.int64)
    hits: dict[int, dict[int, list[int]]] = {}  # size class -> item -> places of shared shingles, ascending
    for size in index.sizes:
        if len(words) < size:
            continue
        # Only shingles of benchmark words can be shared.
        sums = np.concatenate([[0], np.cumsum(numbers > 0)])
        places = np.flatnonzero(sums[size:] - sums[:-size] == size)
        if not len(places):
            continue
        keys = _keys(numbers, size)[places]
        at = np.searchsorted(index.keys[size], keys)
        at[at == len(index.keys[size])] = 0
        for p in places[index.keys[size][at] == keys]:
            for width, item in index.holders.get(tuple(numbers[p: p + size].tolist()), ()):
                hits.setdefault(width, {}).setdefault(item, []).append(int(p))
    found = []
    for width, by_item in hits.items():
        found += _verify(words, index.classes[width], by_item)
    return sorted(found)


def _verify(
    words: list[str], group: SizeClass, by_item: dict[int, list[int]], windows: int = WINDOWS,
) -> list[tuple[int, float, int, int, int]]:
    # A text shorter than the item is one window.
    width = min(group.words, len(words))
    n = width - group.shingle + 1
    last = len(words) - width
    shared = {item: np.array(places) for item, places in by_item.items()}
    # A window is taken up if it covers a shared shingle of any item.
    cover = np.zeros(last + 2, dtype=np.int64)
    for places in shared.values():
        np.add.at(cover, np.maximum(places - n + 1, 0), 1)
        np.add.at(cover, np.minimum(places, last) + 1, -1)
    starts = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    best: dict[int, tuple[float, int, int]] = {}
    # Neighbouring windows share their shingles; far ones are worked on apart, and long runs piece by piece.
    at_once = max(1, min(windows, TABLE // len(group.ids)))
    runs = np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1)
    for part in (run[i: i + at_once] for run in runs for i in range(0, len(run), at_once)):
        first = int(part[0])
        local = shingles(words[first: int(part[-1]) + width], group.shingle)
        prints = window_fingerprints(_digests(local), part - first, n)
        candidate = np.zeros((len(part), len(group.ids)), dtype=bool)
        for b in range(BYTES):
            candidate |= group.index[b][prints[:, b]]
        for i, item in zip(*np.nonzero(candidate)):
            places = shared.get(item)
            if places is None:
                continue
            start = int(part[i])
            next_shared = np.searchsorted(places, start)
            if next_shared == len(places) or places[next_shared] >= start + n:
                continue
            bits = int(np.bitwise_count(prints[i] ^ group.prints[item]).sum())
            if bits > RADIUS:
                continue
            value = similarity(Counter(local[start - first: start - first + n]), group.weights[item])
            if value >= SIMILARITY and (item not in best or value > best[item][0]):
                best[item] = (value, start, bits)
    return [(group.ids[item], value, start, width, bits) for item, (value, start, bits) in best.items()]


def indexes(benchmark: DataFrame, key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS, named: bool = True):
    """Indexes of all items, one block of bounded size at a time.

    NULL or empty texts are left out, and so are rows with a NULL key, which cannot
    be reported, unless ``named`` is false; then all items count as item 0. The
    number of blocks follows the measured size of the benchmark.
    """
    item = F.col(key).cast("bigint")
    items = benchmark.select((item if named else F.lit(0).cast("bigint")).alias("item"), text_or_empty(F.col(text)).alias("text")).where(
        F.col("item").isNotNull())
    chars = items.agg(F.coalesce(F.sum(F.length("text") + 20), F.lit(0))).first()[0]
    blocks = -(-chars // block_chars)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield build_index([(r["item"], r["text"]) for r in part.orderBy("item", "text").collect()])


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: ``<key>, item_id, similarity, first_word, n_words, bits``.

    Documents without a leak have no row. NULL and empty texts contain nothing; a
    text shorter than an item is compared as a whole. Whole texts are searched,
    however long. Repeated rows give repeated rows; of repeated items with one id
    the best match counts once per row of the benchmark. Keys may be NULL; other columns are
    not read; an empty table on either side gives an empty table.
    """
    schema = {key: "bigint", "item_id": "bigint", "similarity": "double", "first_word": "bigint", "n_words": "bigint", "bits": "int"}
    rows = docs.select(F.col(key).cast("bigint").alias(key), text_or_empty(F.col(text)).alias("_text"))
    found = docs.sparkSession.createDataFrame([], ", ".join(f"{k} {v}" for k, v in schema.items()))

    def opened(index: Index):
        def open_task():
            def work(keys, texts):
                out = [(k, *hit) for k, t in zip(keys, texts) for hit in search(t, index)]
                return list(zip(*out)) if out else [[]] * len(schema)

            return work

        return open_task

    for block, index in enumerate(indexes(benchmark)):
        passed = map_batches(rows, opened(index), schema)
        found = passed if block == 0 else found.unionByName(passed)
    return found


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all columns, in which no item was found, whether it has a key or none."""

    def opened(index: Index):
        return lambda: lambda texts: [not search(t or "", index) for t in texts]

    for index in indexes(benchmark, named=False):
        docs = filter_batches(docs, opened(index), text)
    return docs
