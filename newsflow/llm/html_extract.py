"""Main text of web pages: flat text blocks and a decision tree over their neighbourhood.

A page is cut into flat blocks. Each block has its word count and link density,
those of the blocks before and after it, and marks of the elements around it. A
small decision tree, trained on a labelled table of page layouts, tells article
blocks from the rest. Pages are independent, so the work is one narrow map.
"""

from __future__ import annotations

import html as html_module
import itertools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, text_or_empty

# Comments, declarations, then tags whose attribute values may hold ">".
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"\w+")
BLANKS = re.compile(r"\s+")

# Element names of HTML.
RAW = {"script", "style", "iframe", "textarea", "title"}
SILENT = {"noscript", "template", "svg", "math", "object", "canvas", "select"}
# Drawings and formulas, where a slash ends an element; blocks of a page inside one end it.
FOREIGN = {"svg", "math"}
BREAKOUT = {"p", "div", "blockquote", "ul", "ol", "dl", "li", "table", "pre", "hr", "center", "h1", "h2", "h3", "h4", "h5", "h6"}
HTML_IN_FOREIGN = {"foreignobject", "desc", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"}
# A slash before the end of a tag that belongs to an unquoted value.
UNQUOTED_END = re.compile(r"""=\s*[^\s"'>][^\s>]*/\Z""")
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
# Words in class, id and role that name what a container holds.
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar",
    "aside", "widget", "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "form",
    "login", "search", "share", "social", "related", "recommended", "comment", "comments", "disqus", "respond", "reply", "replies",
    "copyright", "legal", "pagination", "pager", "toolbar", "complementary", "contentinfo",
}
# What follows these in a class tells about the layout around an element, as in "has-sidebar" and "page-with-sidebar".
LAYOUT = re.compile(r"(?:^|-)(?:has|with|without|no)-.*")
# Endings of classes that tell about a state of the page, as in "comments-open".
STATE = ("-open", "-closed", "-enabled", "-disabled", "-active", "-inactive", "-visible", "-hidden", "-on", "-off")
# Words of containers whose article elements are not the article, anywhere in a class or as a whole class.
STRICT_WORDS = {
    "comment", "comments", "disqus", "respond", "reply", "replies", "related", "recommended", "sponsor", "sponsored", "promo", "promotion",
}
STRICT_CLASSES = STRICT_WORDS | {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "footer", "contentinfo", "sidebar", "aside", "complementary", "widget",
}
ARTICLE = {"article", "main"}
# Whole classes of article elements that hold something else.
OTHER_ARTICLES = {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo", "related"}
ARTICLE_WORDS = {"article", "articlebody", "main", "content", "post", "entry", "story", "body", "text"}


def _holds(name: str, attributes: str) -> int:
    """1 for an article container, -1 and -2 for page furniture, -3 for a header, 0 for none of these.

    An article or main element below -1 is still the article: a class word or a form may stand for the
    layout of a page around it. Below -2 nothing is. Classes of the page as a whole tell about layout, not
    about what it holds, and so do most of an article element; only the whole classes of ``OTHER_ARTICLES``
    count there.
    """
    if name in ("html", "body"):
        return 0
    classes = [
        LAYOUT.sub("", c) for value in NAMED.findall(attributes) for c in value.lower().strip("\"'").split() if not c.endswith(STATE)
    ] if attributes else []
    if name in ARTICLE:
        return -2 if OTHER_ARTICLES.intersection(classes) else 1
    words = {word for c in classes for word in re.split(r"[^a-z]+", c) if word}
    furniture = words & FURNITURE_WORDS
    if name in FURNITURE - {"header", "form"} or words & STRICT_WORDS or STRICT_CLASSES.intersection(classes):
        return -2
    if name == "form" or furniture - {"header"}:
        return -1
    if name == "header" or furniture:
        # Inside an article it is the article's own; see ``blocks``.
        return -3
    return 1 if words & ARTICLE_WORDS else 0


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """Flat text blocks: ``(text, words, linked words, container, heading)`` in page order.

    Inline tags do not end a block, every other tag does. The container is -1
    below any furniture, 1 below an article, else 0; an article or main element
    ends furniture around it that may be layout (see ``_holds``). Text of scripts, styles and
    other silent elements is left out. Elements that are never closed end with
    their parent; an end tag without a start is ignored.
    """
    found, parts, linked = [], [], 0
    stack: list[tuple[str, int]] = []
    links = heading = 0
    container = 0
    silent = None  # the place of the outermost silent element on the stack
    at, length = 0, len(page)

    def end_block():
        nonlocal parts, linked
        if parts:
            text = BLANKS.sub(" ", html_module.unescape("".join(parts))).strip()
            if text:
                found.append((text, len(text.split()), linked, container, heading))
        parts, linked = [], 0

    while at < length:
        m = MARKUP.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and silent is None:
            parts.append(piece)
            if links:
                linked += len(piece.split())
        if m is None:
            break
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        foreign = name in FOREIGN
        if silent is not None and not closing:
            inner = next((n for n, _ in reversed(stack) if n in FOREIGN or n in HTML_IN_FOREIGN or n in SILENT), None)
            if inner in FOREIGN and name in BREAKOUT:
                # An unclosed drawing ends where the page goes on.
                while stack[-1][0] not in FOREIGN:
                    stack.pop()
                stack.pop()
                silent = None if len(stack) <= silent else silent
            foreign = foreign or inner in FOREIGN
        if foreign and not closing and attributes.endswith("/") and not UNQUOTED_END.search(attributes):
            continue
        if name in RAW and not closing:
            # Raw text up to the matching end tag, whatever it looks like.
            end = re.compile(rf"</{name}\s*>|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if silent is not None and not closing:
            if name not in VOID:
                stack.append((name, 0))
            continue
        if name in SILENT and not closing:
            silent = len(stack)
            stack.append((name, 0))
            continue
        if silent is not None:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is None:
                continue
            if depth >= silent:
                # The block around a silent element goes on behind it.
                del stack[depth:]
                silent = None if depth == silent else silent
                continue
            silent = None
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                parts.append(" ")
            continue
        end_block()
        links = 0
        if name in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
        else:
            while stack and (name == "p" and stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li"):
                stack.pop()
            kind = _holds(name, attributes)
            above = stack[-1][1] if stack else 0
            if kind == -3:
                kind = 0 if above == 1 else -2 if name == "header" else -1
            if above == -1 and kind == 1 and name in ARTICLE and all(n != "article" for n, _ in stack):
                above = 0
            # Furniture stays furniture all the way down; an article may hold furniture.
            stack.append((name, min(kind, above) if min(kind, above) < 0 else max(kind, above)))
        container = max(stack[-1][1], -1) if stack else 0
        heading = int(bool(stack) and len(stack[-1][0]) == 2 and stack[-1][0][0] == "h" and stack[-1][0][1].isdigit())
    end_block()
    return found


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "container", "heading", "page_has_article",
)


def features(found: list[tuple[str, int, int, int, int]]) -> np.ndarray:
    """One row of ``FEATURES`` per block; a missing neighbour counts as empty."""
    table = np.zeros((len(found), len(FEATURES)))
    if not found:
        return table
    _, words, linked, container, heading = (np.array(c) for c in zip(*[("", *b[1:]) for b in found]))
    words = words.astype(float)
    density = np.minimum(linked / np.maximum(words, 1), 1)
    table[:, 0], table[:, 1] = words, density
    table[1:, 2], table[1:, 3] = words[:-1], density[:-1]
    table[:-1, 4], table[:-1, 5] = words[1:], density[1:]
    table[:, 6], table[:, 7], table[:, 8] = container, heading, (container == 1).any()
    return table


def labelled_pages() -> list[tuple[str, str]]:
    """The small labelled table: page layouts whose article texts start with ``KEEP``.

    Layouts vary what surrounds an article, whether a container marks it, and how
    long its paragraphs are, down to single words.
    """
    def say(mark: str, n: int) -> str:
        return " ".join([mark] + ["word"] * (n - 1))

    menu = "<ul>" + "".join(f"<li><a href=/{i}>{say('DROP', n)}</a></li>" for i, n in enumerate((1, 2, 1, 3))) + "</ul>"
    around = [
        (f"<nav>{menu}</nav><div class='ad'>{say('DROP', 8)}</div>", f"<footer>{say('DROP', 9)}</footer>"),
        (f"<header><h1>{say('DROP', 3)}</h1>{menu}</header>", f"<aside><p>{say('DROP', 30)}</p></aside><footer>{say('DROP', 4)}</footer>"),
        (f"<div id='cookie-notice'><p>{say('DROP', 25)}</p></div><div class='menu'>{menu}</div>",
         f"<section class='comments'><h2>{say('DROP', 2)}</h2><p>{say('DROP', 40)}</p><p>{say('DROP', 12)}</p></section><div class='footer'>{say('DROP', 12)}</div>"),
        (f"<div>{menu}</div>", f"<div>{menu}</div><form><p>{say('DROP', 15)}</p></form>"),
        (f"<table><tr><td>{menu}</td></tr></table>", f"<p><a href=/x>{say('DROP', 4)}</a></p><p>{say('DROP', 4)}</p>"),
        (f"<div>{say('DROP', 2)}</div>{menu}", f"<div>{say('DROP', 5)}</div>{menu}<div>{say('DROP', 3)}</div>"),
        (f"<div>{say('DROP', 3)}</div>", f"{menu}<div>{say('DROP', 4)}</div>"),
        ("", ""),
    ]
    bodies = [
        [("h1", 9), ("p", 30), ("p", 60), ("p", 12), ("p", 1), ("p", 45)],
        [("h1", 6), ("p", 3), ("p", 1), ("p", 2)],
        [("h1", 12), ("p", 80), ("h2", 3), ("p", 25), ("blockquote", 18), ("p", 90)],
        [("p", 20), ("p", 7), ("p", 150)],
    ]
    pages = []
    for (before, after), body, container in itertools.product(around, bodies, ("article", "main", "div class=post", "div")):
        if container == "div" and body is bodies[1]:
            continue  # without a container, a few words in a row are no article
        text = "".join(f"<{t}>{say('KEEP', n)}</{t}>" for t, n in body)
        inside = f"<div class='share'>{say('DROP', 3)}</div>" if container in ("article", "main") else ""
        pages.append((f"{before}<{container}>{text}{inside}</{container.split()[0]}>{after}", container))
    # Pages whose layout names furniture around the article, with furniture that holds article elements.
    teaser = f"<article><h2>{say('DROP', 4)}</h2><p>{say('DROP', 25)}</p></article>"
    aside = (f"<div class='sidebar'>{teaser}</div><aside>{teaser}</aside><section class='related-posts'>{teaser}</section>"
             f"<div class='comments-area'>{teaser}</div><footer>{teaser}</footer>")
    layouts = [
        ("div class='content-sidebar-wrap'", ("article", "main")), ("div class='page-with-sidebar'", ("article", "main", "div class=post")),
        ("form action='/page'", ("article", "main")), ("div class='site-header-wrap'", ("article", "main")),
        ("div", ("div class='entry-content comments-open'",)),
    ]
    for (around, containers), body in itertools.product(layouts, bodies):
        text = "".join(f"<{t}>{say('KEEP', n)}</{t}>" for t, n in body)
        pages += [(f"<{around}><nav>{menu}</nav><{c}>{text}</{c.split()[0]}>{aside}</{around.split()[0]}>", c) for c in containers]
    return pages


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1) -> list:
    """A decision tree by Gini impurity: nested ``[feature, cut, left, right]``, leaves are booleans.

    Ties go to the first feature and the smallest cut, so the tree is the same everywhere.
    """
    share = y.mean()
    if depth == 0 or share in (0, 1) or len(y) < 2 * least:
        return bool(share >= 0.5)
    best = None
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        values, hits = x[order, feature], np.cumsum(y[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])
        if not len(cuts):
            continue
        left, right = cuts + 1, len(y) - cuts - 1
        p, q = hits[cuts] / left, (hits[-1] - hits[cuts]) / right
        impurity = left * p * (1 - p) + right * q * (1 - q)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0] - 1e-9:
            best = (impurity[i], feature, float(values[cuts[i]] + values[cuts[i] + 1]) / 2)
    if best is None:
        return bool(share >= 0.5)
    low = x[:, best[1]] <= best[2]
    return [best[1], best[2], train_tree(x[low], y[low], depth - 1, least), train_tree(x[~low], y[~low], depth - 1, least)]


def trained_tree() -> list:
    """The tree of the labelled table (a few hundred blocks)."""
    tables, labels = [], []
    for page, _ in labelled_pages():
        found = blocks(page)
        tables.append(features(found))
        labels += [b[0].startswith("KEEP") for b in found]
    return train_tree(np.vstack(tables), np.array(labels, dtype=float))


def classify(tree: list, table: np.ndarray) -> np.ndarray:
    """Whether each row belongs to the article."""
    if isinstance(tree, bool):
        return np.full(len(table), tree)
    low = table[:, tree[0]] <= tree[1]
    out = np.empty(len(table), dtype=bool)
    out[low], out[~low] = classify(tree[2], table[low]), classify(tree[3], table[~low])
    return out


def main_text(page: str, tree: list) -> str:
    """The article's blocks, joined by an empty line."""
    found = blocks(page)
    keep = classify(tree, features(found))
    return "\n\n".join(b[0] for b, wanted in zip(found, keep) if wanted)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``<key>, <url>, text, n_chars`` (code points).

    NULL or empty markup, and a page without an article, give an empty text. Very
    long pages are read whole. Keys may be NULL or repeated; other columns are not
    read. An empty table gives an empty table.
    """
    tree = trained_tree()

    def open_task():
        def work(keys, urls, pages):
            texts = [main_text(page, tree) for page in pages]
            return keys, urls, texts, [len(t) for t in texts]

        return work

    rows = pages.select(F.col(key).cast("bigint").alias(key), F.col(url).cast("string").alias(url),
                        text_or_empty(F.col(html)).alias("_html"))
    return map_batches(rows, open_task, {key: "bigint", url: "string", "text": "string", "n_chars": "bigint"})
