"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed bigrams and trigrams per language on a bounded sample of
labelled rows and keeps one matrix of log-probabilities. The matrix travels
with the tasks; texts are scored in numpy from their sparse counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import filter_batches, map_batches

# The matrix has this many columns: 2 ** 15 buckets of 4 bytes, 128 KB per language.
BUCKETS = 1 << 15
# At most this many languages, so that the matrix stays below 64 MB.
MOST_LANGUAGES = 500
# Labelled rows to learn from, about, per language; a language with fewer gives all its rows.
SAMPLE_PER_LANGUAGE = 4_000
SMOOTHING = 0.5
# Characters handled at once; longer texts are counted piece by piece.
PIECE = 1 << 18
NO_LANGUAGE = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # buckets x languages


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur in a text and how often: its sparse count vector.

    The text is lower-cased and framed by blanks. Bigrams and trigrams of code points are hashed.
    """
    total = None
    text = f" {text.lower()} "
    for start in range(0, len(text), PIECE):
        # Two characters of overlap, so that no n-gram is lost or counted twice.
        piece = text[max(0, start - 2): start + PIECE]
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        two = (c[:-1] * np.uint32(0x9E3779B1) ^ c[1:] * np.uint32(0x85EBCA77)) if len(c) > 1 else c[:0]
        three = (two[:-1] * np.uint32(0xC2B2AE3D) ^ c[2:] * np.uint32(0x27D4EB2F)) if len(c) > 2 else c[:0]
        if start:
            two = two[1:]
        grams = np.concatenate([two, three])
        counts = np.bincount((grams >> np.uint32(4)) % np.uint32(BUCKETS), minlength=BUCKETS)
        total = counts if total is None else total + counts
    buckets = np.flatnonzero(total)
    return buckets, total[buckets]


def sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int) -> DataFrame:
    """About ``per_language`` labelled rows of every language, chosen by a hash of key and text.

    With the text in it, rows that share one key, or have none, are not taken or left as a whole.

    Counts over all rows set each language's share; they are one small row per language.
    """
    counts = docs.where(F.col(lang).isNotNull()).groupBy(lang).count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return docs.where(F.lit(False))
    unit = 1 << 30
    parts = [
        (F.col(lang) == r[lang]) & (F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(7)), F.lit(unit)) < int(unit * per_language / r["count"]) + 1)
        for r in counts
    ]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen | part
    return docs.where(chosen)


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE, smoothing: float = SMOOTHING,
) -> Model:
    """The model of the labelled rows; rows with a NULL label or text teach nothing.

    Counts are summed inside each task first, so a task sends at most one row per
    language and bucket. Whole numbers are added, so the model does not depend
    on the order of the rows.
    """
    chosen = sample(docs, key, text, lang, per_language).where(F.col(text).isNotNull())

    def counted(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for language, body in zip(*(column.to_pylist() for column in batch.columns)):
                buckets, n = gram_counts(body)
                sums.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))[buckets] += n
                rows[language] = rows.get(language, 0) + 1
        for language, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "language": [language] * (len(used) + 1),
                # Bucket -1 holds the number of rows.
                "bucket": [-1, *used.tolist()], "n": [rows[language], *total[used].tolist()]})

    pairs = chosen.select(F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    table = (
        pairs.mapInArrow(counted, "language string, bucket bigint, n bigint")
        .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    languages = sorted(set(table["language"].to_pylist()))
    at = {name: i for i, name in enumerate(languages)}
    column = np.array([at[x] for x in table["language"].to_pylist()], dtype=np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    rows, counts = np.zeros(len(languages)), np.zeros((BUCKETS, len(languages)))
    prior = bucket < 0
    rows[column[prior]] = n[prior]
    counts[bucket[~prior], column[~prior]] = n[~prior]
    counts += smoothing
    return Model(languages, np.log(rows / max(rows.sum(), 1)), np.log(counts / counts.sum(axis=0)).astype(np.float32))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(text: str | None, model: Model) -> tuple[str, float]:
    """The most probable language and its posterior; ties go to the first name in order."""
    if text is None or not model.languages or not has_letter(text):
        return NO_LANGUAGE, 0.0
    buckets, n = gram_counts(text)
    scores = n @ model.log_probability[buckets].astype(np.float64) + model.log_prior
    best = int(np.argmax(scores))
    return model.languages[best], float(1 / np.exp(scores - scores[best]).sum())


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``<key>, lang_pred, score``.

    NULL and empty texts and texts without a letter are ``und`` with score 0, and
    so is everything when the model has learned nothing. Whole texts are scored,
    very long ones in pieces. Keys may be NULL or repeated; other columns are not
    read; an empty table gives an empty table.
    """

    def open_task():
        def work(keys, texts):
            found = [predict(t, model) for t in texts]
            return keys, [f[0] for f in found], [f[1] for f in found]

        return work

    rows = docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("_text"))
    return map_batches(rows, open_task, {key: "bigint", "lang_pred": "string", "score": "double"})


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose language is known with a posterior of at least ``least``."""

    def open_task():
        def keep(texts):
            found = (predict(t, model) for t in texts)
            return [language != NO_LANGUAGE and score >= least for language, score in found]

        return keep

    return filter_batches(docs, open_task, text)


def held_out(key: Column) -> Column:
    """The fourth of all rows that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) == 2, F.lit(False))
