"""Spelling variants grouped by permuterm rotations.

Every word is written with a terminator, ``$``, and taken in all its
rotations. Two words that differ by one replaced code point share the
rotation that starts just after it, with that code point (its last character)
left out; a word one code point shorter holds the same string as a whole
rotation. So each rotation, with its last character cut, names a prefix range
of the sorted rotations, and everything in that range is a near word. The
sort-merge join on those prefixes is the sorted scan; a range holds at most
one word per letter of the alphabet plus one, whatever the size of the corpus,
so the neighbours it emits are bounded by the alphabet, not by the data.

Counts come first and collapse map-side: a word that a third of all rows hold
costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import lower_ascii, materialised

# Fixed values of the operator's contract.
RUN = r"[A-Za-zÀ-ÿ]+"
CUT_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
DOMINANCE = 5
END = "$"


def planted(doc_id: Column, run: Column) -> Column:
    """The run, lower-cased in A-Z, with one code point cut where ``crc32("<doc_id>:<run>")`` is a multiple of 199.

    The cut code point is the one at ``h % length``, counted from 0. A NULL
    ``doc_id`` makes ``h`` NULL, and the run stays whole.
    """
    lowered = lower_ascii(run)
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), lowered))
    at = (h % F.char_length(lowered)).cast("int")
    cut = F.concat(F.substring(lowered, F.lit(1), at), F.substring(lowered, at + 2, F.lit(1 << 30)))
    return F.when(h % CUT_EVERY == 0, cut).otherwise(lowered)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: every word of at least 6 code points that occurs at least 5 times in all texts."""
    runs = docs.select(F.col(key).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), 0)).alias("run"))
    words = runs.select(planted(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, whole``: each rotation of ``word$``.

    Rotations that end in a letter of the word give their prefix without that
    letter (``whole`` false); every rotation also stands whole (``whole`` true).
    """
    w = F.col("word")
    size = F.char_length(w)
    marked = F.concat(w, F.lit(END))
    # The rotation of word$ that starts at i + 1 ends in the letter at i.
    cut = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.concat(F.substring(w, i + 2, F.lit(1 << 30)), F.lit(END), F.substring(w, F.lit(1), i)))
    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda j: F.concat(F.substring(marked, j + 1, F.lit(1 << 30)), F.substring(marked, F.lit(1), j)))
    return words.select("word", "n", F.explode(F.array(
        F.struct(F.lit(False).alias("whole"), cut.alias("keys")),
        F.struct(F.lit(True).alias("whole"), whole.alias("keys")))).alias("part")).select(
        "word", "n", F.col("part.whole").alias("whole"), F.explode("part.keys").alias("prefix"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every ordered pair of words at one replaced, inserted or deleted code point, once."""
    rot = materialised(rotations(words), "spelling-rotations")
    ranges = rot.where(~F.col("whole")).select("prefix", "word", "n")
    wholes = rot.where(F.col("whole")).select("prefix", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Same range, same length: one code point replaced.
    other = ranges.select("prefix", F.col("word").alias("near"), F.col("n").alias("near_n"))
    replaced = ranges.join(other, "prefix").where(F.col("word") != F.col("near"))
    # A whole rotation in the range: the shorter word lacks the cut letter.
    shorter = ranges.join(wholes, "prefix")
    longer = shorter.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return replaced.select("word", "near", "near_n").unionByName(shorter.select("word", "near", "near_n")).unionByName(
        longer).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last by pointer doubling.

    A form has at least five times its word's count, so chains are at most
    log5 of the largest count long and the doubling ends after a few rounds.
    """
    parents = materialised(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        up = parents.alias("a").join(parents.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word").alias("word"), F.coalesce(F.col("b.root"), F.col("a.root")).alias("root"),
            (F.col("b.root") != F.col("a.root")).alias("moved"))
        up = materialised(up, "spelling-roots")
        if up.where("moved").isEmpty():
            return up.select("word", "root")
        parents = up.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Runs are maximal ``[A-Za-z\\u00C0-\\u00FF]+``, lower-cased in A-Z only, one
    code point cut as :func:`planted` says. Words are the results of at least
    6 code points that occur at least 5 times in all texts. ``form`` is the near
    word of largest count, ties by code-point order, if its count is at least
    five times the word's; else NULL, and so is ``form_n``. ``root`` follows
    forms to the last; ``n_near`` counts the distinct near words.

    NULL texts hold no run; a NULL key cuts nothing; repeated rows count each
    time; other columns are not read, whatever their names; very long texts are
    read whole; an empty table gives no rows.
    """
    words = materialised(word_counts(docs, key, text), "spelling-words")
    pairs = near_pairs(words)
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    nearest = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus_n") >= DOMINANCE * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.minus_n") >= DOMINANCE * F.col("n"), -F.col("best.minus_n")).alias("form_n"))
    chosen = materialised(chosen, "spelling-forms")
    return chosen.join(roots(chosen), "word").select(
        "word", "form", "root", "n", F.col("n_near").cast("bigint").alias("n_near"), F.col("form_n").cast("bigint").alias("form_n"))
