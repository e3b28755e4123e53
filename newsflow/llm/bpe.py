"""Byte-pair encoding and decoding with a contiguous array of ranks.

A word is an array of part boundaries beside an array of the ranks of adjacent
parts. The array is scanned for its minimum again and again; a boundary is
deleted and the neighbouring ranks are refreshed. Words are looked up in a
bounded cache of the task first. The vocabulary is public; its path is a
parameter and its file is read on the driver only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, text_or_empty

END = "</w>"
NEVER = 1 << 60
# Longer words are merged with a heap, whose work does not grow with the square of the length.
SHORT_WORD = 256
# Capital letters newer than Python's tables, and how far off their small letters are.
NEW_CAPITALS = {
    (0x1C89, 0x1C89): 0x1, (0xA7CB, 0xA7CB): 0x264 - 0xA7CB, (0xA7CC, 0xA7CC): 0x1, (0xA7CE, 0xA7CE): 0x1,
    (0xA7D2, 0xA7D2): 0x1, (0xA7D4, 0xA7D4): 0x1, (0xA7DA, 0xA7DA): 0x1, (0xA7DC, 0xA7DC): 0x19B - 0xA7DC,
    (0x10D50, 0x10D65): 0x20, (0x16EA0, 0x16EB8): 0x1B,
}
SMALL = {c: c + step for (low, high), step in NEW_CAPITALS.items() for c in range(low, high + 1)}
# Letters and numbers newer than Unicode 16, which the tokenizers library takes for neither.
NEWER = (
    r"[\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    r"\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8"
    r"\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6"
    r"\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    r"\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F]"
)
# Words that a task keeps in each of two generations: when the newer one is full
# it becomes the older one, so frequent words stay (together about 200 MB).
CACHED_WORDS = 250_000
CACHED_LENGTH = 64


def byte_symbols() -> list[str]:
    """The printable character of each byte: itself where printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = {b: chr(b) for b in own}, 0x100
    for b in range(256):
        if b not in symbols:
            symbols[b], spare = chr(spare), spare + 1
    return [symbols[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    tokens: list[str]  # by id
    first: list[int]  # id of each byte inside a word
    final: list[int]  # id of each byte at the end of a word
    merges: dict[tuple[int, int], tuple[int, int]]  # pair -> (rank, merged id)
    special: dict[str, int]
    pattern: str


def load(path: str) -> Vocabulary:
    """The vocabulary file, which must be a lower-casing BPE with word ends."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or data.get("decoder"):
        raise ValueError("a BPE vocabulary with word ends and no decoder is needed")
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    merges = {}
    for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        merges[ids[a], ids[b]] = (rank, ids[a + b])
    symbols = byte_symbols()
    split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    # The file's blanks are those of Unicode, whatever the engine calls blank.
    pattern = split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")
    return Vocabulary(tokens, [ids[s] for s in symbols], [ids[s + END] for s in symbols], merges, special, pattern)


def with_older_letters(pattern: str, newer: str = NEWER) -> str:
    """``pattern`` for an engine that takes the characters of ``newer`` for neither letters nor numbers."""
    exact = pattern.replace(r"[\p{L}]", rf"[\p{{L}}--{newer}]").replace(r"[\p{N}]", rf"[\p{{N}}--{newer}]")
    return exact.replace(r"[^\p{White_Space}\p{L}\p{N}]", rf"[^\p{{White_Space}}[\p{{L}}\p{{N}}--{newer}]]")


def merge_short(parts: list[int], merges: dict) -> list[int]:
    """Ids of a word by scanning the rank array."""
    get = merges.get
    none = (NEVER, 0)
    pairs = [get(p, none) for p in zip(parts, parts[1:])]
    ranks = [p[0] for p in pairs]
    while ranks:
        low = min(ranks)
        if low == NEVER:
            break
        i = ranks.index(low)
        parts[i] = pairs[i][1]
        del parts[i + 1], ranks[i], pairs[i]
        if i < len(ranks):
            pairs[i] = get((parts[i], parts[i + 1]), none)
            ranks[i] = pairs[i][0]
        if i:
            pairs[i - 1] = get((parts[i - 1], parts[i]), none)
            ranks[i - 1] = pairs[i - 1][0]
    return parts


def merge_long(parts: list[int], merges: dict) -> list[int]:
    """The same ids for a long word: lowest rank first, leftmost of equal ranks, from a heap."""
    n = len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j] = merges[a, b][1], False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else n
            if right < n and (pair := (parts[left], parts[right])) in merges:
                heapq.heappush(heap, (merges[pair][0], left, *pair))
    return [p for p, here in zip(parts, alive) if here]


def encode_word(word: str, vocabulary: Vocabulary) -> list[int]:
    data = word.encode("utf-8")
    parts = [vocabulary.first[b] for b in data[:-1]] + [vocabulary.final[data[-1]]]
    return (merge_short if len(parts) <= SHORT_WORD else merge_long)(parts, vocabulary.merges)


def lowered(text: str) -> str:
    """Lower case character by character: a capital sigma at a word's end is no exception."""
    return text.replace("Σ", "σ").lower().translate(SMALL)


class Encoder:
    """Encodes texts inside one task; ``pieces`` also gives the decoded form of each word."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.newer = regex.compile(NEWER).search
        self.find_older = None
        self.cut = regex.compile("|".join(map(regex.escape, vocabulary.special))).split if vocabulary.special else None
        self.named = regex.compile("|".join(map(regex.escape, vocabulary.special))).findall if vocabulary.special else None
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def _word(self, word: str) -> tuple[int, str, str]:
        made = self.older.get(word)
        if made is None:
            ids = encode_word(word, self.vocabulary)
            made = (len(ids), " ".join(map(str, ids)), decode(ids, self.vocabulary))
        if len(word) <= CACHED_LENGTH:
            self.cache[word] = made
        return made

    def _plain(self, text: str) -> list[tuple[int, str, str]]:
        if len(self.cache) >= CACHED_WORDS:
            self.cache, self.older = {}, self.cache
        get, make = self.cache.get, self._word
        if text.isascii():
            return [get(w) or make(w) for w in self.find(text.lower())]
        text = lowered(unicodedata.normalize("NFC", text))
        find = self.find
        if self.newer(text):
            if self.find_older is None:
                self.find_older = regex.compile(with_older_letters(self.vocabulary.pattern), regex.VERSION1).findall
            find = self.find_older
        return [get(w) or make(w) for w in find(text)]

    def pieces(self, text: str) -> list[tuple[int, str, str]]:
        """``(tokens, ids as text, decoded text)`` of each word; special tokens are found before anything else."""
        if not any(name in text for name in self.vocabulary.special):
            return self._plain(text)
        names = self.named(text)
        out = []
        for i, part in enumerate(self.cut(text)):
            out += self._plain(part)
            if i < len(names):
                out.append((1, str(self.vocabulary.special[names[i]]), names[i]))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for piece in self.pieces(text) for i in piece[1].split(" ")]


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The tokens joined by a space, word ends and special tokens included: the file has no decoder."""
    return " ".join(vocabulary.tokens[i] for i in ids)


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``<key>, ids, decoded``. NULL is empty; an empty text has no ids and decodes to an empty text."""
    def open_task():
        encoder = Encoder(vocabulary)

        def work(keys, texts):
            pieces = [encoder.pieces(t) for t in texts]
            return (keys, [[int(i) for p in ps for i in p[1].split(" ")] for ps in pieces],
                    [" ".join(p[2] for p in ps) for ps in pieces])

        return work

    rows = docs.select(F.col(key).cast("bigint").alias(key), text_or_empty(F.col(text)).alias("_text"))
    return map_batches(rows, open_task, {key: "bigint", "ids": "array<int>", "decoded": "string"})


def digests(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``<key>, n_tokens, ids_sha256, decoded_sha256``.

    The digests are those of the ids in decimal, joined by one space, and of the
    decoded text. NULL and empty texts have no tokens. Whole texts are encoded,
    however long. Keys may be NULL or repeated; other columns are not read; an
    empty table gives an empty table.
    """

    def open_task():
        encoder = Encoder(vocabulary)

        def sha(parts):
            return hashlib.sha256(" ".join(parts).encode("utf-8")).hexdigest()

        def work(keys, texts):
            counts, ids, decoded = [], [], []
            for t in texts:
                pieces = encoder.pieces(t)
                counts.append(sum(p[0] for p in pieces))
                ids.append(sha([p[1] for p in pieces]))
                decoded.append(sha([p[2] for p in pieces]))
            return keys, counts, ids, decoded

        return work

    rows = docs.select(F.col(key).cast("bigint").alias(key), text_or_empty(F.col(text)).alias("_text"))
    return map_batches(rows, open_task, {
        key: "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"})
