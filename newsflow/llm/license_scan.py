"""License scans: base phrases, and an exact set-similarity join with license templates.

The join finds every (text block, template) pair whose containment, the share
of the template's distinct words that the block holds, reaches the threshold.
Words are ordered by their frequency in the whole corpus, rarest first; a block
that qualifies must hold one of the first ``|T| - need + 1`` words of the
template (prefix filter), have ``need`` words (length filter), and leave enough
words after the match on both sides (positional filter). The overlap is then
counted exactly. Everything stays in DataFrame functions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import materialised, text_or_empty

# Letters A-Z in either case, digits and everything beyond ASCII.
LETTER = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORDS = rf"[{LETTER}]+"
# A block ends at an empty line, or at a line end after closing punctuation.
BLOCK_END = r"\n[ \t\r]*\n|(?<=[.!?:;])[ \t\r]*\n"
THRESHOLD = 0.9

# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of public license texts and notices, under their short identifiers.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]


def words(text: Column) -> Column:
    """The words of a text as they are written."""
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+", text.lower())))


def _lowered(word: Column) -> Column:
    """Lower-cased, NULL if that changed anything but A-Z (which no template word needs)."""
    low = F.lower(word)
    return F.when(F.octet_length(low) == F.octet_length(word), low)


def word_counts(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How often each template word stands in the corpus; as many rows as the vocabulary has words."""
    known = F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "_known string"))
    found = docs.select(F.explode(words(text_or_empty(F.col(text)))).alias("_word"))
    rows = found.join(known, _lowered(F.col("_word")) == F.col("_known")).groupBy("_known").count().collect()
    return {r["_known"]: r["count"] for r in rows}


def containment_join(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text",
) -> DataFrame:
    """Every qualifying pair, reduced per text: ``_hash`` (MD5 of the text), ``found`` (labels), ``score``.

    The template table is a parameter of a few hundred sentences at most; the
    prefix index built from it is broadcast.
    """
    spark = docs.sparkSession
    sets = [template_words(t) for _, t in templates]
    counts = word_counts(docs, sorted(set().union(*sets)), text)
    order = {w: i for i, w in enumerate(sorted(set().union(*sets), key=lambda w: (counts.get(w, 0), w)))}
    index, wanted = [], []
    for t, ((label, _), tokens) in enumerate(zip(templates, sets)):
        tokens = sorted(tokens, key=order.get)
        # The small allowance keeps 0.9 * 10 at 9.
        need = math.ceil(threshold * len(tokens) - 1e-9)
        wanted.append((t, label, tokens, need))
        index += [(w, t, i) for i, w in enumerate(tokens[: len(tokens) - need + 1])]
    prefix = F.broadcast(spark.createDataFrame(index, "_prefix string, _template int, _at int"))
    table = F.broadcast(spark.createDataFrame(wanted, "_template int, _label string, _tokens array<string>, _need int"))
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])

    blocks = docs.select(text_or_empty(F.col(text)).alias("_text")).select(
        "_text", F.explode(F.split("_text", BLOCK_END)).alias("_block"))
    starts = blocks.select("_text", "_block", F.explode(words(F.col("_block"))).alias("_word"))
    candidates = (
        starts.join(prefix, _lowered(F.col("_word")) == F.col("_prefix")).join(table, "_template")
        .where(F.regexp_count("_block", F.lit(WORDS)) >= F.col("_need"))
        .withColumn("_held", F.array_distinct(F.transform(words(F.col("_block")), _lowered)))
        # Ranks of the block's template words; words of no template cannot add to an overlap.
        .withColumn("_ranks", F.filter(F.transform("_held", lambda w: F.try_element_at(ranks, w)), lambda r: r.isNotNull()))
    )
    rank = F.try_element_at(ranks, F.col("_prefix"))
    left_in_block = F.size(F.filter("_ranks", lambda r: r >= rank))
    left_in_template = F.size("_tokens") - F.col("_at")
    before = F.size(F.array_intersect(F.col("_held"), F.slice("_tokens", F.lit(1), F.col("_at"))))
    possible = candidates.where(before + F.least(left_in_block, left_in_template) >= F.col("_need"))
    overlap = F.size(F.array_intersect("_held", "_tokens"))
    verified = possible.withColumn("_overlap", overlap).where(F.col("_overlap") >= F.col("_need"))
    return verified.groupBy(F.md5("_text").alias("_hash")).agg(
        F.collect_set("_label").alias("found"), F.max(F.col("_overlap") / F.size("_tokens")).alias("score"))


def _phrase(phrase: str) -> str:
    return rf"[^{LETTER}]+".join(phrase.split()) + rf"(?![{LETTER}])"


def base_places(docs: DataFrame, phrases: dict[str, str] = PHRASES, text: str = "text") -> DataFrame:
    """Add ``n_words, n_base, first_word, last_word, base`` (labels) for the phrases in ``text``.

    The text is cut before every place of a phrase. The words of the first piece
    are the smallest start, all words less those of the last piece the largest.
    """
    whole = F.col(text)
    docs = docs.withColumn("n_words", F.regexp_count(whole, F.lit(WORDS)).cast("bigint"))
    any_phrase = rf"(?i)(?<![{LETTER}])(?:" + "|".join(_phrase(p) for p in phrases) + ")"
    docs = docs.withColumn("_any", whole.rlike(any_phrase))
    for i, phrase in enumerate(phrases):
        # The leading blank keeps a phrase at the very start apart from "no cut".
        pieces = F.split(F.concat(F.lit(" "), whole), rf"(?i)(?<![{LETTER}])(?={_phrase(phrase)})")
        docs = docs.withColumn(f"_pieces{i}", F.when(F.col("_any"), pieces))
    places, firsts, lasts, labels = F.lit(0).cast("bigint"), [], [], []
    for i, label in enumerate(phrases.values()):
        pieces = F.col(f"_pieces{i}")
        n = F.size(pieces) - 1
        places = places + F.when(n > 0, n).otherwise(0)
        count = lambda piece: F.regexp_count(piece, F.lit(WORDS)).cast("bigint")
        firsts.append(F.when(n > 0, count(F.get(pieces, F.lit(0)))))
        lasts.append(F.when(n > 0, F.col("n_words") - count(F.get(pieces, n))))
        labels.append(F.when(n > 0, F.lit(label)))
    none = F.lit(None).cast("bigint")
    return docs.withColumns({
        "n_base": places,
        "first_word": F.least(none, none, *firsts), "last_word": F.greatest(none, none, *lasts),
        "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }).drop("_any", *[f"_pieces{i}" for i in range(len(phrases))])


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """One row per document: ``<key>, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``labels`` adds the labels of the templates that one of the text's blocks
    contains; ``score`` is the highest containment, 1 where a base phrase stands
    and 0 where nothing was found. NULL and empty texts have no words and no
    labels. NULL keys, repeated rows and ties each give their own row; other
    columns are not read; an empty table gives an empty table.

    Pairs are looked up by text, so copies share them. The result of the join is
    written before it is joined back, which lets a frequent text be split by the
    adaptive skew join.
    """
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(F.col(text)).alias("_text"))
    pairs = materialised(containment_join(rows, templates, threshold, "_text"), "license")
    based = base_places(rows, phrases, "_text").withColumn("_hash", F.md5("_text")).drop("_text")
    joined = based.join(pairs, "_hash", "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        F.col("_key").alias(key), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )
