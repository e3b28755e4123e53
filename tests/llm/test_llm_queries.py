"""The registered queries on the small tables: against SQL where there is a twin, else against brute force."""

import hashlib
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from compare import compare  # noqa: E402
from conftest import SMALL  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from newsflow.llm import html_extract, queries  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, duck, name):
    problem = compare(queries.QUERIES[name](spark, SMALL), duck, queries.ORACLE[name])
    assert problem is None, problem


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_html_extraction(spark):
    """The article element holds the article in all given pages."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op4_html_extraction(spark, SMALL).collect()}
    assert len(got) == len(pages)
    import html

    for page in pages:
        inside = re.search(r"(?s)<article>(.*?)</article>", page["html"])[1].replace("<br>", " ")
        pieces = [re.sub(r"<[^>]*>", "", x) for x in re.split(r"</?(?:p|h1)>", inside)]
        wanted = "\n\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in pieces) if x)
        assert got[page["page_id"]]["text"] == wanted
        assert got[page["page_id"]]["n_chars"] == len(wanted)


def test_language_id(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op6_language_id(spark, SMALL).collect()}
    assert len(rows) == len(documents)
    held = [(i, lang) for i, _, lang in documents if brute.held_out(i)]
    assert {i for i, r in rows.items() if r["held_out"]} == {i for i, _ in held}
    right = sum(rows[i]["lang_pred"] == lang for i, lang in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_chat_plain_messages(spark):
    import json

    source = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    got = {(r["conv_id"], r["turn"]): r for r in queries.op7_chat_format(spark, SMALL).collect()}
    assert len(got) == len(source)
    for r in source:
        made = got[r["conv_id"], r["turn"]]
        assert made["kind"] == "message" and made["errors"] == "" and made["place"] == r["turn"]
        assert made["json"] == json.dumps(
            {"content": r["text"], "role": r["role"]}, separators=(",", ":"), ensure_ascii=False)


def test_simhash(spark, documents):
    got = sorted(tuple(r) for r in queries.op8_simhash_dedup(spark, SMALL).collect())
    assert got == sorted(brute.linked([(i, t) for i, t, _ in documents]))


def test_decontamination(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r)[:5] for r in queries.op9_decontamination(spark, SMALL).collect())
    short = [(i, t) for i, t, _ in documents if len(t) < 6000]
    wanted = sorted(brute.leaks(short, items))
    names = {i for i, _ in short}
    assert [g for g in got if g[0] in names] == wanted
    assert wanted


def test_bpe_matches_the_library(spark, documents):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op10_bpe(spark, SMALL).collect()}
    assert len(got) == len(documents)
    for i, text, _ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_pipeline(spark, documents):
    """Each stage by brute force on what the one before it kept."""
    import corpus_pipeline as pipeline
    from newsflow.llm.language_id import has_letter

    got = {r["doc_id"] for r in pipeline.run(spark, SMALL).collect()}
    kept = [(i, t) for i, t, _ in documents if has_letter(t or "")]
    kept = [(i, t) for (i, t), e in zip(kept, brute.exact(kept)) if e[3]]
    kept = [(i, t) for (i, t), e in zip(kept, brute.linked(kept)) if e[2] == i]
    leaked = {r["doc_id"] for r in queries.op9_decontamination(spark, SMALL).select("doc_id").collect()}
    assert got == {i for i, _ in kept} - leaked


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns, name


def test_html_tree_knows_its_table():
    """The labelled table is told apart without a mistake."""
    tree = html_extract.trained_tree()
    for page, _ in html_extract.labelled_pages():
        assert "DROP" not in html_extract.main_text(page, tree)
        assert html_extract.main_text(page, tree).count("KEEP") == page.count("KEEP")
