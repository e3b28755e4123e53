"""The registered queries of these operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (
    bpe, chat, decontaminate, exact_dedup, html_extract, language_id, lexical_search, license_scan, mixing, pii, simhash_dedup,
    spelling, url_filters,
)
from newsflow.llm.common import table

# Rules of the URL query: host, path prefix, verdict.
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
VOCABULARY = "word_bpe_49k.json"
# Keys the surrogates of the query; a deployment passes its own.
SURROGATE_SECRET = "surrogates of the registered query"


def vocabulary_path() -> str:
    """In the folder that ``TOKENIZERS_DIR`` names, else that of the installed public files."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, VOCABULARY)
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def vocabulary() -> bpe.Vocabulary:
    return bpe.load(vocabulary_path())


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS rules(host, path, verdict)")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymise(table(spark, sf_dir, "documents"), SURROGATE_SECRET)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.train(documents.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.identify(documents, model).withColumn("held_out", language_id.held_out(F.col("doc_id")))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_messages(table(spark, sf_dir, "conversations"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_url_filters, op2_pii_surrogates, op3_exact_dedup, op4_html_extraction, op5_license_scan, op6_language_id,
        op7_chat_format, op8_simhash_dedup, op9_decontamination, op10_bpe, op11_spelling_variants,
        op12_lexical_search, op13_source_mixing,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1_SQL = rf"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS row_no, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS start FROM pages
), split AS (
  SELECT page_id, row_no,
    CASE WHEN start = 0 THEN '' ELSE translate(regexp_extract(substr(u, start + 3), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') END AS host,
    CASE WHEN start = 0 THEN '' ELSE regexp_extract(substr(u, start + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM parts
), rules(h, p, v) AS (VALUES {", ".join(str(r) for r in RULES)}
), hits AS (
  SELECT row_no, h || p AS rule, v, row_number() OVER (PARTITION BY row_no ORDER BY length(h || p) DESC, length(h) DESC) AS n
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM split LEFT JOIN hits ON hits.row_no = split.row_no AND n = 1
"""

OP3_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM t
"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    word, other = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    phrases = ", ".join(f"({_sql_text(p)}, {_sql_text(label)})" for p, label in license_scan.PHRASES.items())
    templates = ", ".join(
        f"({i}, {_sql_text(label)}, [{', '.join(_sql_text(w) for w in license_scan.template_words(t))}])"
        for i, (label, t) in enumerate(license_scan.TEMPLATES))
    return rf"""
WITH lowered AS (
  SELECT row_number() OVER () AS row_no, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS body FROM documents
), worded AS (SELECT *, regexp_extract_all(body, '{word}+') AS w FROM lowered
), phrases(phrase, label) AS (VALUES {phrases}
), places AS (
  SELECT row_no, label, list_filter(range(0, len(w)), lambda i: w[i + 1] = phrase_words[1] AND list_slice(w, i + 1, i + len(phrase_words)) = phrase_words) AS spots
  FROM worded, (SELECT string_split(phrase, ' ') AS phrase_words, label FROM phrases)
), base AS (
  SELECT row_no, sum(len(spots))::BIGINT AS n_base, min(list_min(spots)) AS first_word, max(list_max(spots)) AS last_word,
    coalesce(list(label) FILTER (len(spots) > 0), []) AS labels
  FROM places GROUP BY row_no
), templates(t, label, words) AS (VALUES {templates}
), blocks AS (
  SELECT row_no, list_distinct(regexp_extract_all(block, '{word}+')) AS held
  FROM (SELECT row_no, unnest(regexp_split_to_array(regexp_replace(body, '([.!?:;])[ \t\r]*\n', '\1' || chr(10) || chr(10), 'g'), '\n[ \t\r]*\n')) AS block FROM lowered)
), pairs AS (
  SELECT row_no, label, len(list_intersect(held, words)) AS common, len(words) AS size FROM blocks, templates
), found AS (
  SELECT row_no, list(DISTINCT label) AS labels, max(common::DOUBLE / size) AS score FROM pairs
  WHERE common >= ceil({license_scan.THRESHOLD} * size - 1e-9) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_base, first_word, last_word,
  array_to_string(list_sort(base.labels), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base.labels, coalesce(found.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
FROM worded JOIN base USING (row_no) LEFT JOIN found USING (row_no)
"""


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{lexical_search.TERM}') AS t
  FROM documents
), g AS (SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0
), tf AS (
  SELECT r, doc_id, len(t)::BIGINT AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, t, unnest(t) AS term FROM d WHERE len(t) > 0) GROUP BY r, doc_id, t, term
), w AS (
  SELECT term, floor(1000 * ln((2.0 * big_n + 2) / (2.0 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY term, big_n
), s AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)) AS s FROM tf, g
), q AS (
  SELECT i, item_id, term, count(*)::BIGINT AS c
  FROM (SELECT row_number() OVER () AS i, item_id,
          unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{lexical_search.TERM}')) AS term
        FROM benchmark)
  GROUP BY i, item_id, term
), scored AS (
  SELECT i, item_id, r, doc_id, sum(w * c * s)::BIGINT AS score FROM q JOIN w USING (term) JOIN s USING (term)
  GROUP BY i, item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE score > 0
) WHERE rank <= {lexical_search.TOP}
"""

ORACLE = {
    "op1_url_filters": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op5_license_scan": _license_sql(),
    "op12_lexical_search": OP12_SQL,
}
