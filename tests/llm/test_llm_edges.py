"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import json
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from newsflow.llm import (  # noqa: E402
    bpe, chat, decontaminate, exact_dedup, html_extract, language_id, license_scan, pii, queries, simhash_dedup, url_filters,
)

LONG = "Un mot après l'autre, sans fin et sans raison. " * 6000
TEXTS = [
    (1, "Released under the MIT License."), (2, None), (3, ""), (4, "Released  under\tthe MIT License."),
    (4, "Released  under\tthe MIT License."), (None, "no key here"), (None, "Released under the MIT License."),
    (5, " \n\t "), (6, LONG), (7, LONG + "x"), (8, "1234 !! ² Ⅷ"), (9, "Été <|endoftext|> Σίσυφος ΟΔΟΣ İ K 😀 e\u0301"),
    (10, "A\x0bB\x0cC\x1cD\u00a0E"), (0, None), (9, "another text under the same key"),
]
CLASH = ["_text", "_hash", "_key", "fp", "variant", "keep_id", "score", "component_id", "node", "root", "_host", "language", "kept", "_dropped", "_body", "body", "first", "least", "keeper"]


def rows(spark, data, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(data, schema)
    return df.withColumns({c: F.lit("clash") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    return rows(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(odd, none):
    assert tuples(exact_dedup.duplicates(odd)) == sorted(brute.exact(TEXTS), key=repr)
    assert exact_dedup.duplicates(none).count() == 0
    stay = exact_dedup.first_of_each(odd)
    assert stay.columns == odd.columns
    got = [(r["doc_id"], r["text"]) for r in stay.collect()]
    assert (1, TEXTS[0][1]) in got and (0, None) in got and (5, " \n\t ") in got
    assert len(got) == len({exact for *_, exact in brute.exact(TEXTS)})
    assert exact_dedup.first_of_each(none).count() == 0


def test_exact_dedup_survives_hash_collisions(odd):
    """With a digest of one value for all, only the bytes tell texts apart."""
    weak = exact_dedup.duplicates(odd, digest=lambda c: F.substring(c, 1, 0))
    assert tuples(weak) == sorted(brute.exact(TEXTS), key=repr)


def test_simhash(odd, none):
    assert tuples(simhash_dedup.near_duplicates(odd)) == sorted(brute.linked(TEXTS), key=repr)
    assert simhash_dedup.near_duplicates(none).count() == 0
    stay = simhash_dedup.first_of_each(odd)
    assert stay.columns == odd.columns
    assert {r["doc_id"] for r in stay.collect()} == {None} | {
        i for i, _, c in brute.linked(TEXTS) if i is not None and i == c}


def test_one_of_each_near_group_stays_without_keys_and_under_one_key(spark):
    base = [f"word{i}" for i in range(300)]
    near = [" ".join(base + [f"end{n}"]) for n in range(3)]
    data = [(None, near[0]), (None, near[1]), (7, near[2]), (8, "some other text"), (8, "quite another thing"),
            (None, "a b c"), (None, "a b c ")]
    linked = brute.linked(data)
    assert len({fp for _, fp, _ in linked}) < len(data)
    stay = tuples(simhash_dedup.first_of_each(rows(spark, data)).select("doc_id", "text"))
    assert [t for _, t in stay if t in near] == [near[2]]
    assert sorted(t.strip() for _, t in stay if t not in near) == ["a b c", "quite another thing", "some other text"]
    tied = [(5, near[0]), (5, near[1]), (5, near[2])]
    assert simhash_dedup.first_of_each(rows(spark, tied)).count() == 1


def planted_fingerprints(seed, groups=30, size=8):
    """Random fingerprints with neighbours at 1 to 5 bits, and one crowd around a centre."""
    pick = random.Random(seed)
    found = set()
    for _ in range(groups):
        base = pick.getrandbits(64)
        for _ in range(size):
            found.add(base ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 5))))
    centre = pick.getrandbits(64)
    found |= {centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3))) for _ in range(120)}
    return sorted(found)


@pytest.mark.parametrize("dense, batch", [(2_048, 10_000), (4, 10_000), (4, 7), (2_048, 7)])
def test_every_link_within_the_radius(spark, dense, batch):
    """Chains of fingerprints, with the masked balls alone and with crowded groups sent to the unmasked ones.

    Small batches cut groups in the middle.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    prints = planted_fingerprints(5, groups=30 if batch > 100 else 4)
    df = spark.createDataFrame([(simhash_dedup._signed(p),) for p in prints], "fp bigint")
    edges = simhash_dedup.links(df, dense)
    roots = {r["node"]: r["root"] for r in simhash_dedup.components(edges).collect()}
    got = {}
    for p in prints:
        got.setdefault(roots.get(simhash_dedup._signed(p), simhash_dedup._signed(p)), set()).add(p)
    wanted = {}
    for p, _, c in brute.components([(p, p) for p in prints]):
        wanted.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))
    if dense == 4:
        assert simhash_dedup.sparse_links(df, dense).where("b IS NULL").count() > 0
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001)]
    got = {r["node"]: r["root"] for r in simhash_dedup.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, **{1000 + i: 1000 for i in range(1, 300)}, 5001: 5000}


def test_license_scan(odd, none):
    extra = [
        (20, "mit license, MIT\nLicense; general  public-license apache"), (21, "commit licenses mitlicense"),
        (22, "Intro.\nLicensed under the\nApache License, version 2.0 (the thing).\nEnd."),
        (23, "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby given"),
        (24, "Released under the BSD License."), (25, "\u212Aey mit\u212A license"),
    ]
    data = TEXTS + extra
    df = rows(odd.sparkSession, data)
    wanted = brute.licenses(
        data, license_scan.PHRASES, license_scan.TEMPLATES, license_scan.THRESHOLD,
        r"\n[ \t\r]*\n|(?<=[.!?:;])[ \t\r]*\n")
    assert tuples(license_scan.scan(df)) == sorted(wanted, key=repr)
    assert license_scan.scan(none).count() == 0


URLS = [
    (1, "https://a.example.org/en/12?x#y"), (2, "http://EXAMPLE.org"), (3, None), (4, ""), (5, "no scheme/en"), (6, "x://notexample.org/es/"),
    (7, "x://example.org/es/"), (8, "://com/fr/"), (9, "a://b://c.com/de/x"), (10, "http://a.com?u=http://b.org/"), (11, "http://org./"),
    (12, "http://a..org/"), (13, "http://a.net/" + "p/" * 5000), (1, "https://a.example.org/en/12?x#y"), (None, "http://z.com/de/"),
    (None, None), (14, "http://example.org/en/1"), (15, "http://user@example.org:80/en/1"), (16, "HTTP://Example.ORG/ES/"),
]


@pytest.mark.parametrize("most", [100_000, 0])
def test_url_filters(spark, most):
    df = rows(spark, URLS, "page_id bigint, url string")
    rules = spark.createDataFrame([*queries.RULES, (None, "/", "block"), ("", "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    plain = [*queries.RULES, ("net", "", "block")]
    got = tuples(url_filters.judge(df, rules, broadcast_rules=most))
    assert got == sorted([(i, *brute.judge(u, plain)) for i, u in URLS], key=repr)
    assert url_filters.judge(df.where("false"), rules).count() == 0
    assert {r["verdict"] for r in url_filters.judge(df, rules.where("false")).collect()} == {"allow"}
    assert url_filters.judge(df, rules.where("false")).count() == len(URLS)
    # A path without a slash is no part of the host, though both write the same rule.
    odd_rules = spark.createDataFrame([("o", "rg/", "block"), ("net", "/", "allow")], "host string, path string, verdict string")
    one = spark.createDataFrame([(1, "https://x.org/a")], "page_id bigint, url string")
    assert tuples(url_filters.judge(one, odd_rules)) == [(1, "x.org", "/a", None, "allow")]


def test_html(spark):
    pages = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "plain words only, without any markup at all, " * 9),
        (4, "u", "<article>a &amp b &lt;c&gt; &#x2014;<!-- <p>no --><script>var x = '</p>';</script><p>d\n\t e<br>f</article>"),
        (5, "u", "<article><p title='a>b'>kept</p><aside>gone</aside><section id=comments><p>gone</p></section><p>also"),
        (6, "u", "<main><header><h1>Own head</h1></header><p>Body &nbsp; text</p></main><footer>gone</footer>"),
        (7, "u", "<article>" + "<p>word</p>" * 20000 + "</article>"), (7, "u", "<article><p>again</article>"), (8, "u", "<style>x"),
        (9, "u", "<body class='no-sidebar comments-open'><div class='site-header'>gone</div><div class='post'><div class='entry-header'><h1>Head"
                 "</h1></div><p>One.<p>Two.</div><div id=sidebar>gone</div>"), (10, "u", "<p>1 ² Ⅷ</p>"),
        (11, "u", "<div class='page has-sidebar'><article class='post no-comments'><p>Kept.</p><article class=comment><p>gone</p></article>"
                  "</article><div class='left-sidebar'>gone</div></div>"),
    ]
    df = rows(spark, pages, "page_id bigint, url string, html string")
    got = {(r["page_id"], r["text"][:40], r["n_chars"]) for r in html_extract.extract(df).collect()}
    assert html_extract.extract(df).count() == len(pages)
    assert {(1, "", 0), (2, "", 0), (None, "", 0), (8, "", 0), (7, "again", 5)} <= got
    assert (4, "a & b <c> —\n\nd e f", 18) in got
    assert (5, "kept\n\nalso", 10) in got
    assert (6, "Own head\n\nBody text", 19) in got
    assert (11, "Kept.", 5) in got
    assert (9, "Head\n\nOne.\n\nTwo.", 16) in got
    assert any(i == 7 and n == 20000 * 4 + 19999 * 2 for i, _, n in got)
    assert html_extract.extract(df.where("false")).count() == 0


def test_language_id(spark, odd, none):
    labelled = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr"), (None, "en"), ("", "fr"), ("x", None)] * 5)]
    model = language_id.train(rows(spark, labelled, "doc_id bigint, text string, lang string"))
    assert model.languages == ["en", "fr"]
    got = tuples(language_id.identify(odd, model))
    assert len(got) == len(TEXTS)
    assert [g for g in got if g[0] in (2, 3, 5, 8)] == sorted(((i, "und", 0.0) for i in (2, 3, 5, 8)), key=repr)
    assert (6, "fr", 1.0) in got
    empty = language_id.train(rows(spark, [], "doc_id bigint, text string, lang string"))
    assert {r["lang_pred"] for r in language_id.identify(odd, empty).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0
    kept = language_id.accepted(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 4, None, 6, 7, 9, 10}


def test_pieces_of_long_texts_lose_no_gram(monkeypatch):
    text = "".join(random.Random(1).choices("abcdeé ", k=5000))
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 97)
    assert all((a == b).all() for a, b in zip(whole, language_id.gram_counts(text)))


def test_decontamination(spark, odd, none):
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcdefg", k=4))
    passage = [word() for _ in range(40)]
    short = ["only", "three", "words"]
    items = [(1, " ".join(passage)), (2, " ".join(short)), (3, None), (None, " ".join(passage)), (4, ""), (5, " ".join(passage[:20]))]
    changed = passage.copy()
    changed[0], changed[39] = "zzz", "yyy"
    broken = passage.copy()
    broken[20] = broken[10] = broken[30] = "zzz"
    docs = TEXTS + [
        (30, " ".join([word() for _ in range(50)] + passage + [word() for _ in range(50)])),
        (31, ", ".join(w.upper() for w in changed)), (32, " ".join(broken)), (33, "x only THREE words y"), (34, " ".join(passage[:37])),
        (35, " ".join((passage + ["q"]) * 300)),
    ]
    df = rows(spark, docs)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("_text", F.lit(1))
    got = sorted((tuple(r)[:5] for r in decontaminate.leaks(df, bench).collect()), key=repr)
    small = [(i, t) for i, t in docs if len(t or "") < 100_000]
    wanted = brute.leaks(small, [i for i in items if i[0] is not None])
    assert got == sorted(wanted, key=repr)
    assert {g[0] for g in got} == {30, 31, 32, 33, 34, 35} or {30, 31, 33, 34, 35} <= {g[0] for g in got}
    assert decontaminate.leaks(none, bench).count() == 0 and decontaminate.leaks(df, bench.where("false")).count() == 0
    kept = decontaminate.cleaned(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(
        i or -1 for i, _ in docs if i not in {g[0] for g in got})


def test_benchmark_in_several_blocks(spark):
    items = spark.createDataFrame([(i, f"word{i} one two three four five six seven eight {i}") for i in range(30)], "item_id bigint, text string")
    docs = rows(spark, [(i, f"before word{i} one two three four five six seven eight {i} after") for i in range(30)])
    whole = tuples(decontaminate.leaks(docs, items))
    monkey = list(decontaminate.indexes(items, block_chars=500))
    assert len(monkey) > 2 and sum(len(g.ids) for x in monkey for g in x.classes.values()) == 30
    assert {(a, b) for a, b, *_ in whole} >= {(i, i) for i in range(30)}


def library():
    tokenizers = pytest.importorskip("tokenizers")
    made = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    made.no_truncation()
    made.no_padding()
    return made


def test_bpe(odd, none):
    vocabulary, made = queries.vocabulary(), library()
    got = sorted((r["doc_id"] or -1, r["ids"], r["decoded"]) for r in bpe.encode(odd, vocabulary).collect())
    wanted = []
    for i, text in TEXTS:
        ids = made.encode(text or "", add_special_tokens=False).ids
        wanted.append((i or -1, ids, made.decode(ids, skip_special_tokens=False)))
    assert got == sorted(wanted)
    assert bpe.digests(odd, vocabulary).count() == len(TEXTS) and bpe.digests(none, vocabulary).count() == 0


def test_bpe_on_random_texts():
    vocabulary, made = queries.vocabulary(), library()
    encoder = bpe.Encoder(vocabulary)
    pick = random.Random(11)
    letters = "abcdefghij ABC éÈñß 0123 '!?.-_ \n\t\u00a0\u2003\x1c\x85 ΣςΑ ИЖ 中文 ½² ǅ 'll 's ' ﬁ \u0301 😀"
    for _ in range(400):
        text = "".join(pick.choices(letters, k=pick.randint(0, 60)))
        assert encoder.encode(text) == made.encode(text, add_special_tokens=False).ids, repr(text)
    for n in (1, 2, 300, 3000):
        word = "".join(pick.choices("abcdeinrst", k=n))
        assert encoder.encode(word) == made.encode(word, add_special_tokens=False).ids
        parts = [vocabulary.first[b] for b in word.encode()]
        assert bpe.merge_short(list(parts), vocabulary.merges) == bpe.merge_long(list(parts), vocabulary.merges)


PERSONAL = (
    "Mail jo.90@mail2.example.com or JO.90@mail2.example.com, call +1 (017) 555-7713, card 4225039295678253, from 169.122.221.182. "
    "token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" Mr. John Smith met Mrs. Anna Jones; John Smith left. SSN 123-45-6789. "
    "Иван Петров. Version 1.2.3 of 2010-03-05 has 100 pages."
)


def test_surrogates(odd, none):
    key = b"k" * 32
    replace = pii._replacer(key)
    made, found = replace(PERSONAL)
    kinds = [k for k, _, _ in found]
    assert kinds == ["email", "email", "phone", "card", "ip", "secret", "person", "person", "person", "ssn", "person"]
    for kind, value, surrogate in found:
        assert value not in made and surrogate != value
        if kind != "ip":
            assert [c.isdigit() for c in value] == [c.isdigit() for c in surrogate] or kind in ("secret", "person")
    by_value = {v: s for _, v, s in found}
    assert by_value["Mr. John Smith"].split(" ")[1:] == by_value["John Smith"].split(" ")  # coreference
    given = by_value["John Smith"].split(" ")[0]
    assert given in pii.GIVEN["m", "latin"] and by_value["Mrs. Anna Jones"].split(" ")[1] in pii.GIVEN["f", "latin"]
    assert by_value["Иван Петров"].split(" ")[0] in pii.GIVEN["m", "cyrillic"]
    assert "Version 1.2.3 of 2010-03-05 has 100 pages." in made
    assert pii._replacer(b"other key")(PERSONAL)[0] != made
    near = "+1 (826) 555-4081 190.137.223.204 and 555 1234 4225039295678253, 12 34 56 78 90 12 34 56 78, a@b.org 030 1234 5678"
    assert [k for k, _, _ in replace(near)[1]] == ["phone", "ip", "phone", "card", "phone", "phone", "email", "phone"]
    got = pii.anonymise(rows(odd.sparkSession, TEXTS + [(40, PERSONAL)]), "s")
    assert got.count() == len(TEXTS) + 1 and pii.anonymise(none, "s").count() == 0
    assert {r["text"] for r in got.where("n_entities = 0").collect()} == {t or "" for _, t in TEXTS}


def test_surrogates_are_distinct(spark):
    """Over whole small formats the map is one cycle; over a corpus the check finds nothing."""
    for size in (2, 3, 10, 100, 1000):
        seen, x = set(), 0
        while x not in seen:
            seen.add(x)
            x = pii.permuted(x, size, b"k")
        assert len(seen) == size
    phones = [f"555-{i:04d}" for i in range(10_000)]
    assert len({pii.surrogate(p, "phone", b"k") for p in phones}) == 10_000
    cards = [pii.surrogate(f"4225 0392 9567 {i:04d}", "card", b"k") for i in range(500)]
    assert len(set(cards)) == 500 and [pii._luhn(c) for c in cards] == [pii._luhn(f"4225 0392 9567 {i:04d}") for i in range(500)]
    docs = rows(spark, [(i, f"{PERSONAL} and user{i}@example.org") for i in range(50)])
    found = pii.mentions(docs, "s")
    assert found.count() == 61 and pii.collisions(found).count() == 0
    broken = spark.createDataFrame([("email", "a", "x"), ("email", "b", "x"), ("ip", "a", "x"), ("ip", "a", "y")], "kind string, value string, surrogate string")
    assert sorted(tuple(r) for r in pii.collisions(broken).collect()) == [("email", "x", 2), ("ip", "a", 2)]


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def test_chat(spark):
    data = [
        (1, 0, "user", "find"), (1, 1, "assistant", call(("c1", "search", {"query": "x", "limit": 2}))),
        (1, 2, "tool", '{"tool_call_id": "c1", "content": "found"}'), (1, 3, "assistant", "done"),
        # A result before its call, and a call that waits for a later result.
        (2, 0, "tool", '{"tool_call_id": "a", "content": 1}'), (2, 1, "assistant", call(("b", "calculate", {"expression": {"$result": "a"}}))),
        (2, 2, "assistant", call(("a", "calculate", {"expression": "1+1"}))), (2, 3, "tool", '{"tool_call_id": "b", "content": 2}'),
        (3, 0, "tool", '{"tool_call_id": "nowhere"}'), (3, 1, "assistant", '{"tool_calls": "text"}'), (3, 2, None, None), (None, None, "tool", '{"tool_call_id": "c1"}'),
        (3, 3, "assistant", '{"tool_calls": [{"id": 7, "function": {"name": "search", "arguments": "{\\"limit\\": 0, \\"z\\": 1}"}}]}'),
        # Two calls that wait for each other.
        (4, 0, "assistant", call(("p", "search", {"query": {"$result": "q"}}))), (4, 1, "tool", '{"tool_call_id": "p"}'),
        (4, 2, "assistant", call(("q", "search", {"query": {"$result": "p"}}))), (4, 3, "tool", '{"tool_call_id": "q"}'),
        (5, 0, "user", ""), (5, 0, "user", ""), (5, 1, "assistant", "{broken"), (5, 2, "tool", "{}"),
    ]
    df = rows(spark, data, "conv_id bigint, turn bigint, role string, text string")
    got = chat.format_messages(df).collect()
    assert len(got) == len(data)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    order = lambda conv: [r["turn"] for r in sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["place"], r["level"], r["turn"]))]
    assert order(1) == [0, 1, 2, 3] and order(2) == [2, 0, 1, 3]
    assert [by[1, t]["kind"] for t in range(4)] == ["message", "call", "result", "message"] and by[1, 2]["call_turn"] == 1
    assert by[1, 1]["errors"] == "" and by[1, 1]["json"] == (
        '{"content":null,"role":"assistant","tool_calls":[{"arguments":{"limit":2,"query":"x"},"id":"c1","name":"search"}]}')
    assert by[3, 0]["kind"] == by[None, None]["kind"] == "orphan" and by[3, 2]["json"] == '{"content":"","role":null}'
    assert by[3, 3]["errors"] == "call 0: no id; call 0: $.query: missing; call 0: $.limit: too small; call 0: $.z: unknown"
    assert {by[4, t]["kind"] for t in range(4)} == {"cycle"}
    assert chat.format_messages(df.where("false")).count() == 0


def test_bpe_splits_and_lowers_characters_of_every_age_as_the_library_does():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    encoder = bpe.Encoder(queries.vocabulary())
    # Letters of Unicode 15, 16 and 17, capitals of 16 and 17, and places without a character.
    for c in "ᲉꟋꟚꟜ\U00010D50\U00010D70\U00016EA0\U00016EBB՘₟࢏\U000323B0\U00031350\U000105C0":
        for text in (f"a{c}", f"!{c}", f"{c}b {c}", f"😤{c}1"):
            assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_decontamination_works_on_long_runs_piece_by_piece(monkeypatch):
    """A text full of benchmark passages is one long run of windows; its pieces give the same matches."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=12 + i % 3))) for i in range(9)]
    texts = [(k, " ".join(body for i in rng.sample(range(9), 9) for body in (items[i][1], "w1 w2"))) for k in range(4)]
    texts.append((4, " ".join([items[0][1]] * 30)))
    wanted = sorted(brute.leaks(texts, items))
    index = decontaminate.build_index(items)

    def found():
        return sorted((k, *hit[:4]) for k, text in texts for hit in decontaminate.search(text, index))

    assert found() == wanted and len(wanted) > 30
    monkeypatch.setattr(decontaminate, "TABLE", 20)
    assert found() == wanted
