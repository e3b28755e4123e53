"""SQL twins of the registered queries, runnable by DuckDB on the same tables."""

from __future__ import annotations

from newsflow.plans.catalog import ACTORS, CAP, EXPORT_LANGUAGE, FIRST, RECENT, VERBS, XML_CHUNK

_BLANKS = r"[ \t\n\r\f\x0B]"
_TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^ \t\n\r\f\x0B\p{L}\p{M}\p{N}]"


def _strip(e: str) -> str:
    return f"trim({e}, {_TRIM})"


def _words(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, '[^ \\t\\n\\r\\f\\x0B]+')) AS INTEGER)"


_STORIES = """stories AS (
  SELECT ingest_seq, doc_key,
         'SRC_' || language || '_' || strftime(publication_date, '%Y%m%d') || '.'
           || lpad(doc_key, CAST(greatest(length(doc_key), 4) AS INTEGER), '0') AS doc_id,
         language, news_source, publication_date,
         strftime(publication_date, '%Y%m%d') AS date, article_body, batch_id
  FROM (
    SELECT doc_id AS ingest_seq, CAST(doc_id AS VARCHAR) AS doc_key,
           CASE lang WHEN 'en' THEN 'ENG' WHEN 'fr' THEN 'FRE'
                     WHEN 'de' THEN 'GER' WHEN 'es' THEN 'SPA' END AS language,
           source AS news_source,
           CAST(DATE '1994-01-01' + CAST(doc_id % 5000 AS INTEGER) AS DATE) AS publication_date,
           text AS article_body, doc_id // 100 AS batch_id
    FROM documents
  )
)"""


def _split(body: str) -> str:
    marked = f"regexp_replace({_strip(body)}, '([.!?]){_BLANKS}+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: length(s) > 0)"


_LISTED = f"""listed AS (
  SELECT doc_key, doc_id, date, {_split('article_body')} AS l FROM stories
)"""
_SENTENCES = """sents AS (
  SELECT doc_key, doc_id, date, CAST(generate_subscripts(l, 1) AS INTEGER) AS sen_id,
         unnest(l) AS sentence
  FROM listed
)"""
_TREES = f"""trees AS (
  SELECT *, '(ROOT ' || array_to_string(regexp_extract_all(sentence, '{_TOKEN}'), ' ') || ')' AS tree
  FROM sents
)"""
_STORED_DOCS = """stored_docs AS (
  SELECT l.doc_id AS id, l.date,
         '{"doc_id":' || to_json(l.doc_id) || ',"sentences":[' || coalesce(j, '') || ']}' AS output,
         l.doc_key AS mongo_id
  FROM listed l LEFT JOIN (
    SELECT doc_key,
           string_agg(to_json({'sen_id': CAST(sen_id AS VARCHAR), 'sentence': sentence, 'tree': tree}),
                      ',' ORDER BY sen_id) AS j
    FROM trees GROUP BY doc_key
  ) t ON l.doc_key = t.doc_key
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_SENT = (_STORIES, _LISTED, _SENTENCES)
_ANNOT = (*_SENT, _TREES, _STORED_DOCS)


def _values(name: str, entries: dict[str, str]) -> str:
    rows = ", ".join(f"('{p}', '{c}')" for p, c in entries.items())
    return f"{name}(phrase, code) AS (VALUES {rows})"


_GRAMS = f"""toks AS (
  SELECT doc_key, sen_id, regexp_extract_all(lower(sentence), '{_TOKEN}') AS w FROM sents
), starts AS (
  SELECT doc_key, sen_id, w, CAST(unnest(range(1, len(w) + 1)) AS INTEGER) AS start FROM toks
), grams AS (
  SELECT doc_key, sen_id, start, n, array_to_string(w[start : start + n - 1], ' ') AS gram
  FROM starts, (VALUES (1), (2), (3)) AS lengths(n) WHERE start + n - 1 <= len(w)
)"""


def _hits(name: str, dictionary: str) -> str:
    return f"""{name} AS (
  SELECT doc_key, sen_id, start, n, phrase, code FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_key, sen_id, start ORDER BY n DESC) AS rn
    FROM grams JOIN {dictionary} ON gram = phrase
  ) WHERE rn = 1
)"""


_CODING = (
    *_SENT, _TREES, _values("actor_dict", ACTORS), _values("verb_dict", VERBS), _GRAMS,
    _hits("actors", "actor_dict"), _hits("verbs", "verb_dict"),
)
_CODED = """noun_lists AS (
  SELECT doc_key, sen_id, list(phrase ORDER BY start) AS nouns, list(code ORDER BY start) AS noun_coding,
         min(start) AS first_start, max(start) AS last_start,
         arg_min(code, start) AS source, arg_max(code, start) AS target
  FROM actors GROUP BY doc_key, sen_id
), first_verbs AS (
  SELECT doc_key, sen_id, arg_min(phrase, start) AS verbs, arg_min(code, start) AS verb_coding
  FROM verbs GROUP BY doc_key, sen_id
), event_rows AS (
  SELECT v.doc_key, v.sen_id, v.start, a.source, a.target, v.code
  FROM verbs v JOIN noun_lists a ON v.doc_key = a.doc_key AND v.sen_id = a.sen_id
  WHERE v.start > a.first_start AND v.start < a.last_start
), coded AS (
  SELECT t.doc_key, t.doc_id, t.sen_id, t.sentence, t.tree,
         coalesce(a.nouns, CAST([] AS VARCHAR[])) AS nouns,
         coalesce(a.noun_coding, CAST([] AS VARCHAR[])) AS noun_coding,
         coalesce(v.verbs, '') AS verbs, coalesce(v.verb_coding, '') AS verb_coding,
         NOT regexp_matches(t.sentence, '[\\p{L}\\p{M}\\p{N}]') AS failed
  FROM trees t
  LEFT JOIN noun_lists a ON t.doc_key = a.doc_key AND t.sen_id = a.sen_id
  LEFT JOIN first_verbs v ON t.doc_key = v.doc_key AND t.sen_id = v.sen_id
)"""
_CODED_ALL = (*_CODING, _CODED)

_IDS = """ids AS (
  SELECT doc_key, 'SR' || translate(right(news_source, 1), '0123456789', 'ABCDEFGh8_') || '_'
         || CASE WHEN length(article_body) % 10 = 1 THEN lower(language) ELSE language END || '_'
         || CASE WHEN length(article_body) % 10 = 0 THEN '19941332' ELSE date END || '.0001' AS doc_id
  FROM stories
), decoded AS (
  SELECT doc_key, doc_id,
         nullif(regexp_extract(doc_id, '_([A-Z]{3})_', 1), '') AS language,
         nullif(regexp_extract(doc_id, '^([A-Z]{3})_', 1), '') AS news_source,
         nullif(regexp_extract(doc_id, '_([0-9]{8})', 1), '') AS digits,
         strftime(try_strptime(nullif(regexp_extract(doc_id, '_([0-9]{8})', 1), ''), '%Y%m%d'),
                  '%Y-%m-%d') AS publication_date
  FROM ids
), judged AS (
  SELECT *, CASE WHEN language IS NULL THEN 'no language' WHEN news_source IS NULL THEN 'no source'
                 WHEN digits IS NULL THEN 'no date' WHEN publication_date IS NULL THEN 'bad date' END AS reject_reason
  FROM decoded
)"""

_ARTICLES = f"""articles AS (
  SELECT doc_key, length(article_body) < 200 AS undated,
         'Q&A ' || chr(8211) || ' ' || news_source AS article_title,
         CASE WHEN language = 'GER' THEN '' ELSE language || ', <' || date || '>' END AS dateline,
         {_strip('article_body')} AS article_body, doc_id,
         strftime(publication_date, '%Y-%m-%d') AS publication_date, 'SRC' AS news_source, language,
         CASE WHEN language = 'SPA' THEN '' ELSE 'story' END AS doc_type,
         {_words('article_body')} AS word_count
  FROM stories
)"""

_DATES = """printed AS (
  SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%B %-d, %Y')
    WHEN 1 THEN strftime(o_orderdate, '%A, %B %-d, %Y')
    WHEN 2 THEN strftime(o_orderdate, '%-d %B %Y')
    WHEN 3 THEN 'garbage'
    WHEN 4 THEN strftime(o_orderdate, '%m %d %Y')
    WHEN 5 THEN strftime(o_orderdate, '%B %-d, ') || '20' || strftime(o_orderdate, '%y') || 'XX'
    WHEN 6 THEN strftime(o_orderdate, '%B %Y')
    ELSE 'Foo ' || strftime(o_orderdate, '%-d, %Y') END AS publication_date_raw
  FROM orders
), months(name, num) AS (VALUES ('JANUARY','01'),('FEBRUARY','02'),('MARCH','03'),('APRIL','04'),
  ('MAY','05'),('JUNE','06'),('JULY','07'),('AUGUST','08'),('SEPTEMBER','09'),('OCTOBER','10'),
  ('NOVEMBER','11'),('DECEMBER','12')
), words AS (
  SELECT o_orderkey, publication_date_raw, string_split(publication_date_raw, ' ') AS w,
         regexp_replace(string_split(publication_date_raw, ' ')[1], '[^A-Za-z0-9]+', '', 'g') AS head
  FROM printed
), turned AS (
  SELECT *, CASE WHEN upper(head) IN ('SUNDAY','MONDAY','TUESDAY','WEDNESDAY','THURSDAY','FRIDAY','SATURDAY')
                 THEN list_append(w[2:], head) ELSE list_prepend(head, w[2:]) END AS t
  FROM words
), parts AS (
  SELECT o_orderkey, publication_date_raw, t[1] AS a, t[2] AS b, t[3] AS c,
         nullif(regexp_extract(CASE WHEN regexp_matches(t[2], '[0-9]') THEN t[2]
                                    WHEN regexp_matches(t[1], '[0-9]') THEN t[1] END, '[0-9]+'), '') AS d,
         nullif(regexp_extract(t[3], '[0-9]+'), '') AS y,
         regexp_matches(t[1], '[0-9]') AND NOT regexp_matches(t[2], '[0-9]') AS day_first
  FROM turned
)"""


def _robust(month_word: str, cap: str) -> str:
    return f"""robust AS (
  SELECT o_orderkey, publication_date_raw,
         CASE WHEN b IS NULL OR d IS NULL OR y IS NULL {cap} THEN '-1'
              ELSE y || coalesce(num, '01') || CASE WHEN length(d) < 2 THEN '0' || d ELSE d END END AS date
  FROM parts LEFT JOIN months
    ON name = upper(regexp_replace({month_word}, '[^A-Za-z0-9]+', '', 'g'))
), written AS (
  SELECT *, CASE WHEN date = '-1' THEN 0 ELSE CAST(date AS BIGINT) END AS date_int FROM robust
)"""


_ROBUST = (_DATES, _robust("a", "OR CAST(y AS BIGINT) > 2016"))
_FIXED = (_DATES, _robust("CASE WHEN day_first THEN b ELSE a END", ""))

_STORED = """stored AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_key, doc_id AS ingest_seq,
         to_json({'quality': quality, 'toxic': toxic}) AS corenlp_output
  FROM labels
)"""
_RECENT = f"""recent AS (
  SELECT doc_key, ingest_seq FROM stored ORDER BY ingest_seq DESC, doc_key DESC LIMIT {RECENT}
)"""

_XML = """strftime(publication_date, '%Y%m%d') AS _date, doc_id AS _id, doc_key AS "_mongoId",
       news_source AS _source, 'true' AS _sentence, article_body AS "Text\""""


def _unescape(e: str) -> str:
    for ref, char in (("&quot;", "'\"'"), ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&amp;", "'&'")):
        e = f"replace({e}, '{ref}', {char})"
    return e


def _element(tag: str) -> str:
    clean = r"regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
    inner = f"regexp_extract({clean}, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    return _strip(_unescape(f"regexp_replace({inner}, '<[^>]*>', '', 'g')"))


ORACLE: dict[str, str] = {
    "language_stats": _with(_STORIES) + f"""
SELECT language, count(*) AS documents, CAST(sum(len({_split('article_body')})) AS BIGINT) AS sentences,
       CAST(sum({_words('article_body')}) AS BIGINT) AS words, CAST(sum(strlen(article_body)) AS BIGINT) AS bytes
FROM stories GROUP BY language""",
    "word_count": _with(_STORIES) + f"SELECT doc_key, {_words('article_body')} AS word_count FROM stories",
    "byte_length": _with(_STORIES)
    + "SELECT doc_key, CAST(strlen(article_body) AS INTEGER) AS byte_length FROM stories",
    "decode_doc_id": _with(_STORIES, _IDS) + """
SELECT doc_key, doc_id, language, news_source, publication_date FROM judged WHERE reject_reason IS NULL""",
    "quarantine_bad_ids": _with(_STORIES, _IDS) + """
SELECT doc_key, doc_id, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    "extract_articles": _with(_STORIES, _ARTICLES) + """
SELECT article_title, dateline, article_body, doc_id, publication_date, news_source, language,
       doc_type, word_count, doc_type AS type FROM articles WHERE NOT undated""",
    "quarantine_articles": _with(_STORIES, _ARTICLES) + """
SELECT doc_key, regexp_replace(doc_id, '_[0-9]{8}', '_undated') AS doc_id, 'no date' AS reject_reason
FROM articles WHERE undated""",
    "story_record": _with(_STORIES, _ARTICLES) + """
SELECT news_source, article_title, publication_date, article_body, CAST(0 AS INTEGER) AS stanford,
       language, doc_id, word_count, dateline, doc_type AS type FROM articles WHERE NOT undated""",
    "extract_pages": f"""
WITH found AS (
  SELECT page_id, url, {_element('title')} AS title,
         regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS language,
         {_element('article')} AS article_text
  FROM pages
)
SELECT *, {_words('article_text')} AS word_count FROM found""",
    "count_by_language": _with(_STORIES) + "SELECT language, count(*) AS n_stories FROM stories GROUP BY language",
    "xml_articles": _with(_STORIES) + f"SELECT {_XML} FROM stories WHERE language = '{EXPORT_LANGUAGE}'",
    "xml_first_n": _with(_STORIES)
    + f"SELECT {_XML} FROM stories WHERE language = '{EXPORT_LANGUAGE}' ORDER BY ingest_seq LIMIT {FIRST}",
    "date_simple": _with(_DATES) + """
SELECT o_orderkey, publication_date_raw,
       w[3] || coalesce(num, '01') || left(w[2], length(w[2]) - 1) AS date
FROM words LEFT JOIN months ON name = upper(w[1])""",
    "date_robust": _with(*_ROBUST) + "SELECT o_orderkey, publication_date_raw, date FROM robust",
    "date_robust_fixed": _with(*_FIXED) + "SELECT o_orderkey, publication_date_raw, date FROM robust",
    "date_int_writeback": _with(*_ROBUST) + "SELECT o_orderkey, publication_date_raw, date_int FROM written",
    "date_range": _with(*_ROBUST) + """
SELECT coalesce(min(CASE WHEN date_int <> 0 THEN date_int END), 99999999) AS min_date,
       coalesce(max(CASE WHEN date_int <> 0 THEN date_int END), 0) AS max_date FROM written""",
    "publish_json": _with(_STORIES) + """
SELECT doc_key, CAST(to_json({'_id': {'$oid': doc_key}, 'doc_id': doc_id, 'language': language,
         'news_source': news_source, 'publication_date': {'$date': epoch_ms(publication_date)},
         'article_body': article_body}) AS VARCHAR) AS value
FROM stories""",
    "publish_row_array": _with(*_ANNOT)
    + "SELECT CAST(to_json([id, date, output, mongo_id]) AS VARCHAR) AS value FROM stored_docs",
    "decode_message": _with(_STORIES) + """
SELECT ingest_seq, CASE WHEN language = 'SPA' THEN doc_id ELSE 'oid' || doc_key END AS doc_key, doc_id,
       CASE WHEN language = 'GER' THEN date ELSE strftime(publication_date, '%B %-d, %Y') END AS date,
       article_body
FROM stories WHERE length(article_body) >= 200""",
    "quarantine_messages": _with(_STORIES) + """
SELECT ingest_seq, 'malformed message' AS error FROM stories WHERE length(article_body) < 200""",
    "split_sentences": _with(*_SENT) + "SELECT doc_key, sen_id, sentence FROM sents",
    "split_turns": f"""
WITH listed AS (SELECT conv_id, turn, {_split('text')} AS l FROM conversations)
SELECT conv_id, turn, CAST(generate_subscripts(l, 1) AS INTEGER) AS sen_id, unnest(l) AS sentence FROM listed""",
    "tokens": _with(*_SENT) + f"""
, listed_tokens AS (
  SELECT doc_key, sen_id, regexp_extract_all(sentence, '{_TOKEN}') AS w FROM sents
)
SELECT doc_key, sen_id, CAST(generate_subscripts(w, 1) AS INTEGER) AS pos, unnest(w) AS word,
       CAST(NULL AS VARCHAR) AS tag, CAST(NULL AS VARCHAR) AS ne
FROM listed_tokens""",
    "annotated_documents": _with(*_ANNOT) + "SELECT id, date, output, mongo_id FROM stored_docs",
    "explode_sentences": _with(*_ANNOT) + "SELECT doc_key, doc_id, date, sen_id, sentence, tree FROM trees",
    "code_actors": _with(*_CODING) + "SELECT doc_key, sen_id, start, n, phrase, code FROM actors",
    "code_verbs": _with(*_CODING) + "SELECT doc_key, sen_id, start, n, phrase, code FROM verbs",
    "phrases_by_doc": _with(*_CODED_ALL) + """
SELECT l.doc_id, '[' || coalesce(j, '') || ']' AS phrases, l.doc_key AS mongo_id
FROM listed l LEFT JOIN (
  SELECT doc_key, string_agg('{' || to_json(sentence) || ':' || to_json({
           'nouns': nouns, 'noun_coding': noun_coding, 'verbs': verbs, 'verb_coding': verb_coding}) || '}',
           ',' ORDER BY sen_id) AS j
  FROM coded GROUP BY doc_key
) c ON l.doc_key = c.doc_key""",
    "phrases_by_sentence": _with(*_CODED_ALL) + """
SELECT doc_id, doc_key AS mongo_id, sents_count, sentence, array_to_string(nouns, '|') AS nouns,
       array_to_string(noun_coding, '|') AS noun_coding, verbs, verb_coding
FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_key, sentence ORDER BY sen_id DESC) AS rn,
         CAST(max(sen_id) OVER (PARTITION BY doc_key) AS INTEGER) AS sents_count
  FROM coded
) WHERE rn = 1 AND NOT failed""",
    "sentence_outcomes": _with(*_CODED_ALL) + """
SELECT l.doc_key, CAST(count(c.sen_id) AS INTEGER) AS total,
       CAST(coalesce(sum(CASE WHEN NOT failed THEN 1 END), 0) AS INTEGER) AS parsed,
       CAST(coalesce(sum(CASE WHEN failed THEN 1 END), 0) AS INTEGER) AS failed
FROM listed l LEFT JOIN coded c ON l.doc_key = c.doc_key GROUP BY l.doc_key""",
    "first_event": _with(*_CODED_ALL) + """
SELECT c.doc_key, c.sen_id, coalesce(arg_min(e.source, e.start), '') AS source,
       coalesce(arg_min(e.target, e.start), '') AS target, coalesce(arg_min(e.code, e.start), '') AS code
FROM coded c LEFT JOIN event_rows e ON c.doc_key = e.doc_key AND c.sen_id = e.sen_id
GROUP BY c.doc_key, c.sen_id""",
    "flatten_events": _with(*_CODED_ALL) + """
SELECT c.doc_key AS mongo_id, c.sen_id, c.sentence,
       string_agg(e.source || '>' || e.target || '>' || e.code, '|' ORDER BY e.start) AS events
FROM coded c JOIN event_rows e ON c.doc_key = e.doc_key AND c.sen_id = e.sen_id
WHERE NOT c.failed GROUP BY c.doc_key, c.sen_id, c.sentence""",
    "recent_ids": _with(_STORED, _RECENT) + "SELECT doc_key, ingest_seq FROM recent",
    "skip_processed": _with(_STORIES, _STORED, _RECENT) + """
SELECT doc_key, doc_id, date, article_body FROM stories s
WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.doc_key = s.doc_key)""",
    "skip_all_processed": _with(_STORIES, _STORED) + """
SELECT doc_key, doc_id, date, article_body FROM stories s
WHERE NOT EXISTS (SELECT 1 FROM stored r WHERE r.doc_key = s.doc_key)""",
    "merge_annotations": _with(_STORIES, _STORED) + """
SELECT s.doc_key, s.doc_id, s.article_body, CAST(u.corenlp_output AS VARCHAR) AS corenlp_output
FROM stories s LEFT JOIN (
  SELECT doc_key, arg_max(corenlp_output, ingest_seq) AS corenlp_output FROM stored GROUP BY doc_key
) u ON s.doc_key = u.doc_key""",
    "shuffled_cap": _with(_STORIES) + f"""
SELECT ingest_seq, doc_id, article_body FROM stories
ORDER BY (ingest_seq * 7919) % 10007, ingest_seq LIMIT {CAP}""",
    "batch_stats": _with(_STORIES, _STORED, _RECENT) + f"""
, marked AS (
  SELECT s.batch_id, strlen(s.article_body) AS bytes, len({_split('s.article_body')}) AS n,
         r.doc_key IS NOT NULL AS skipped
  FROM stories s LEFT JOIN recent r ON s.doc_key = r.doc_key
), stats AS (
  SELECT batch_id, CAST(coalesce(sum(CASE WHEN NOT skipped THEN 1 END), 0) AS BIGINT) AS batch_size,
         CAST(sum(bytes) AS BIGINT) AS docs_size,
         CAST(coalesce(sum(CASE WHEN NOT skipped THEN n END), 0) AS BIGINT) AS sentences
  FROM marked GROUP BY batch_id
)
SELECT batch_id, batch_size, docs_size, sentences, batch_size AS io_operations,
       CAST(sum(batch_size) OVER (ORDER BY batch_id) AS BIGINT) AS total_docs_processed FROM stats""",
    "batch_averages": """
SELECT round(avg(data_size)) AS avg_size, round(avg(batch_time)) AS avg_time FROM (
  SELECT sum(strlen(props)) AS data_size, date_sub('second', min(ts), max(ts)) AS batch_time
  FROM events GROUP BY event_id // 100
)""",
    "progress": _with(_STORIES) + """
, sizes AS (SELECT batch_id, count(*) AS batch_rows FROM stories GROUP BY batch_id)
SELECT batch_id, batch_rows, CAST(sum(batch_rows) OVER () AS BIGINT) AS total_rows,
       CAST(sum(batch_rows) OVER (ORDER BY batch_id) AS BIGINT) AS inserted_rows,
       CAST(sum(batch_rows) OVER () - sum(batch_rows) OVER (ORDER BY batch_id) AS BIGINT) AS remaining_rows
FROM sizes""",
}

ORACLE["corpus_files"] = ORACLE["extract_articles"]
ORACLE["xml_files"] = ORACLE["xml_articles"]
ORACLE["coded_files"] = ORACLE["sentence_outcomes"]
ORACLE["merge_stored"] = ORACLE["merge_annotations"]
ORACLE["xml_chunks"] = _with(_STORIES) + f"""
SELECT chunk, count(*) AS rows, 1::BIGINT AS files FROM (
  SELECT (row_number() OVER (ORDER BY ingest_seq, doc_key) - 1) // {XML_CHUNK} + 1 AS chunk
  FROM stories WHERE language = '{EXPORT_LANGUAGE}'
) GROUP BY chunk"""
ORACLE["stream_annotate"] = ORACLE["annotated_documents"]
ORACLE["message_files"] = _with(_STORIES) + """
SELECT doc_key, doc_id, date, article_body, CAST(NULL AS VARCHAR) AS error FROM stories"""
ORACLE["stream_stats"] = _with(_STORIES) + f"""
SELECT count(*) AS batch_size, CAST(sum(strlen(article_body)) AS BIGINT) AS docs_size,
       CAST(sum(len({_split('article_body')})) AS BIGINT) AS sentences, count(*) AS io_operations
FROM stories"""
ORACLE["corpus_spellings"] = ORACLE["extract_articles"]
ORACLE["code_actors_large"] = ORACLE["code_actors"]
ORACLE["stories_inserted"] = ORACLE["story_record"]
ORACLE["rows_published"] = ORACLE["publish_row_array"]
ORACLE["stream_restart"] = ORACLE["annotated_documents"]
ORACLE["stream_replay"] = ORACLE["annotated_documents"]
ORACLE["phrases_inserted"] = f"SELECT doc_id, phrases FROM ({ORACLE['phrases_by_doc']})"
ORACLE["message_dialects"] = _with(_STORIES) + """
SELECT ingest_seq, CASE WHEN ingest_seq % 11 <> 0 THEN doc_id END AS doc_key,
       CASE WHEN ingest_seq % 11 <> 0 THEN date END AS date,
       CASE WHEN ingest_seq % 11 = 0 THEN 'malformed message' END AS error
FROM stories"""
ORACLE["annotate_hook"] = _with(_STORIES) + """
, lines AS (SELECT doc_key, string_split(article_body, chr(10)) AS l FROM stories)
SELECT doc_key, CAST(generate_subscripts(l, 1) AS INTEGER) AS sen_id, unnest(l) AS sentence FROM lines"""
ORACLE["code_hook"] = _with(*_SENT) + """
SELECT doc_key, sen_id, CASE WHEN length(sentence) % 2 = 0 THEN date ELSE '' END AS date,
       CASE WHEN length(sentence) % 2 = 0 THEN CAST(length(sentence) AS VARCHAR) ELSE '' END AS code,
       CASE WHEN length(sentence) % 2 = 1 THEN 'odd length' END AS error
FROM sents"""
ORACLE["stored_events_meta"] = _with(*_CODED_ALL) + """
SELECT l.doc_key AS mongo_id, CAST(coalesce(n, 0) AS INTEGER) AS results,
       CASE WHEN coalesce(n, 0) > 0 THEN l.date ELSE '' END AS dates
FROM listed l LEFT JOIN (SELECT doc_key, count(*) AS n FROM coded WHERE NOT failed GROUP BY doc_key) c ON l.doc_key = c.doc_key"""
ORACLE["noun_pairs"] = _with(*_CODING) + """
SELECT doc_key, sen_id, string_agg(phrase, '|' ORDER BY start) AS nouns, string_agg(code, '|' ORDER BY start) AS noun_coding
FROM actors GROUP BY doc_key, sen_id"""
ORACLE["newest_first"] = _with(_STORED) + """
SELECT doc_key, ingest_seq, CAST(corenlp_output AS VARCHAR) AS corenlp_output,
  row_number() OVER (ORDER BY ingest_seq DESC, doc_key DESC) AS rank
FROM stored ORDER BY ingest_seq DESC, doc_key DESC"""
ORACLE["merge_hot"] = _with(_STORIES, _STORED) + """
, keyed AS (
  SELECT CASE WHEN ingest_seq % 3 = 0 THEN '1' WHEN ingest_seq % 7 <> 0 THEN doc_key END AS doc_key, ingest_seq,
         CASE WHEN ingest_seq % 2 = 0 THEN 'old' END AS old FROM stories
)
SELECT k.doc_key, k.ingest_seq, coalesce(CAST(u.corenlp_output AS VARCHAR), old) AS corenlp_output
FROM keyed k LEFT JOIN (
  SELECT doc_key, arg_max(corenlp_output, ingest_seq) AS corenlp_output FROM stored GROUP BY doc_key
) u ON k.doc_key = u.doc_key"""
