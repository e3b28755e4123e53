"""Text and attributes of SGML/HTML-like markup, without a Python parser.

Tag and attribute names match in any case, tags and comments are dropped from
text, and character references are decoded in one pass.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import strip

COMMENT = r"(?s)<!--.*?-->"
TAG = r"<[/!?a-zA-Z][^>]*>"
REFERENCE = r"^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# Numbers 128 to 159 are read as this single-byte encoding, as browsers do.
WINDOWS = "cp1252"


def _named_references() -> Column:
    # The HTML 4 names of the standard library plus the upper-case spellings
    # that newswire markup uses for the markup characters themselves.
    names = {name: chr(code) for name, code in name2codepoint.items()}
    names.update({n.upper(): names[n] for n in ("amp", "lt", "gt", "quot")})
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def decode_references(c: Column) -> Column:
    """Replace ``&name;``, ``&#n;`` and ``&#xh;``; unknown references stay as they are.

    The text is cut at every ampersand and each piece is decoded on its own, so
    decoded text is never read again. Pass a plain column: it is used repeatedly.
    """
    def split_off(piece: Column) -> Column:
        return F.struct(piece.alias("piece"), F.regexp_extract(piece, REFERENCE, 1).alias("ref"))

    def numbered(p: Column) -> Column:
        # The pattern bounds the digits, so neither conversion can overflow.
        digits = F.regexp_extract(p["ref"], "^#[xX]?0*(.*)$", 1)
        number = F.when(
            p["ref"].rlike("^#[xX]"), F.conv(digits, 16, 10).try_cast("int")
        ).when(p["ref"].startswith("#"), digits.try_cast("int"))
        number = F.coalesce(F.try_element_at(windows, number), number)
        return F.struct(p["piece"].alias("piece"), p["ref"].alias("ref"), number.alias("number"))

    def decoded(p: Column) -> Column:
        n = p["number"]
        char = F.when(
            n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF),
            F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
        ).when(n.isNull(), F.try_element_at(names, p["ref"]))
        rest = F.substring(p["piece"], F.length(p["ref"]) + 2, F.length(p["piece"]))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), p["piece"]))

    names = _named_references()
    windows = F.create_map(*[
        F.lit(ord(c) if i % 2 else b) for b in range(0x80, 0xA0)
        for i, c in enumerate((None, bytes([b]).decode(WINDOWS, "replace"))) if bytes([b]).decode(WINDOWS, "replace") != "\uFFFD"
    ])
    pieces = F.split(c, "&")
    tail = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(0)))
    for step in (split_off, numbered, decoded):
        tail = F.transform(tail, step)
    joined = F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))
    return F.when(c.contains("&"), joined).otherwise(c)


def without_comments(markup: Column) -> Column:
    return F.regexp_replace(markup, COMMENT, "")


def element(markup: Column, name: str) -> Column:
    """Undecoded text of the first element called ``name``; absent gives ``''``.

    An element that is never closed runs to the end of the markup.
    """
    # Possessive runs up to each "<": one test per tag instead of one per character.
    pattern = rf"(?is)<{name}(?:\s[^>]*)?>((?:[^<]++|<(?!/{name}\s*>))*+)"
    return F.regexp_replace(F.regexp_extract(markup, pattern, 1), TAG, "")


def attribute(markup: Column, owner: str, name: str) -> Column:
    """Undecoded value of an attribute of the first such element; absent gives ``''``."""
    opening = F.regexp_extract(markup, rf"(?is)<{owner}(\s[^>]*)>", 1)
    value = F.regexp_extract(opening, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.regexp_replace(value, r"(?s)^([\"'])(.*)\1$", "$2")


def read_fields(df: DataFrame, markup: str, elements: dict[str, str], attributes: dict[str, tuple[str, str]]) -> DataFrame:
    """Add decoded, stripped element texts and attribute values as columns.

    ``elements`` maps a column to an element name, ``attributes`` a column to an
    (element, attribute) pair. Cutting out, then decoding, in separate steps lets
    every regular expression run once per row.
    """
    m = F.col("_markup")
    cut = {column: element(m, name) for column, name in elements.items()}
    cut.update({column: attribute(m, *where) for column, where in attributes.items()})
    return (
        df.withColumn("_markup", without_comments(F.col(markup)))
        .withColumns(cut)
        .withColumns({column: strip(decode_references(F.col(column))) for column in cut})
        .drop("_markup")
    )
