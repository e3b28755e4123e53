"""Layouts and silent elements that must not cost the article."""

import pytest

from newsflow.llm import html_extract

TREE = html_extract.trained_tree()
BODY = "<h1>Kept head</h1><p>Kept " + "word " * 30 + "</p><p>Kept.</p>"


def kept(page):
    return html_extract.main_text(page, TREE)


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main>{}</main><div class='sidebar'>gone</div></div>",
    "<div class='page-with-sidebar'><article>{}</article></div><footer>gone</footer>",
    "<div class='page-with-sidebar'><div class='post'>{}</div></div>",
    "<div class='entry-content comments-open'>{}</div><div class='comments'><p>gone</p></div>",
    "<form id='aspnetForm'><nav>gone</nav><article>{}</article><p>gone</p></form>",
    "<main><div class='content-sidebar-wrap'><article>{}<div class='share'>gone</div></article></div></main>",
    "<div class='sticky-header-layout'><div class='search-page'><article>{}</article></div></div>",
])
def test_an_article_ends_layout_around_it(page):
    text = kept(page.format(BODY))
    assert text.count("Kept") == 3 and "gone" not in text


@pytest.mark.parametrize("around", [
    "nav", "aside", "footer", "header", "div class='comments-area'", "div id=sidebar", "div class='related-posts'", "div role=navigation",
    "form class='comment-form'", "aside class='page-with-sidebar'",
])
@pytest.mark.parametrize("inner", ["article", "main", "div class='content-sidebar-wrap'><article"])
def test_strict_furniture_stays(around, inner):
    page = f"<article>{BODY}</article><{around}><{inner}><p>gone {'word ' * 30}</p></{inner.split('<')[-1]}></{around.split()[0]}>"
    assert kept(page).count("Kept") == 3 and "gone" not in kept(page)


AFTER = "<p>Kept one.</p><p>Kept two.</p>"


@pytest.mark.parametrize("page", [
    "<article><p>Kept <svg class=\"icon\"/> on.</p>{}</article>",
    "<article><p>Kept <math/> on.</p>{}</article>",
    "<article><p>Kept <svg><path d='M0'/><title/><g/></svg> on.</p>{}</article>",
    "<article><p>Kept <svg viewBox='0'><text>gone</text><svg><text>gone</text></svg><text>gone</text></svg> on.</p>{}</article>",
    "<article><p>Kept on.</p><div><object><object>gone</object><p>gone</p></object></div>{}</article>",
    "<article><p>Kept on.</p><div><select><option>gone<option>gone</div>{}</article>",
    "<article><p>Kept on.</p><div><noscript><img src=x>gone</div>{}</article>",
    "<article><p>Kept on.</p><div><object data=x><p>gone</p></div>{}</article>",
    "<article><p>Kept on.</p><div><template><div>gone</div></div>{}</article>",
    "<article><p>Kept on.</p><div><canvas>gone</div>{}</article>",
    "<article><p>Kept on.</p><div><svg class=icon><path d='M0'></div>{}</article>",
    "<article><p>Kept on.</p><svg class=icon><path d='M0'>{}</article>",
    "<article><p>Kept on.</p><svg><a>gone</a><foreignObject><p>gone</p></foreignObject></svg>{}</article>",
    "<article><p>Kept on.</p><svg class=icon/>gone</svg>{}</article>",
    "<article><p>Kept on.</p><script>'<p>gone</p><svg>'</script><style>gone</style><textarea><p>gone</textarea>{}</article>",
    "<title>gone</title><article><p>Kept on.</p><iframe><p>gone</p></iframe>{}</article>",
])
def test_silent_elements_end_where_they_end(page):
    text = kept(page.format(AFTER))
    assert text.split("\n\n")[1:] == ["Kept one.", "Kept two."] and "gone" not in text
    assert text.split("\n\n")[0].split() == ["Kept", "on."]


def test_a_block_goes_on_behind_a_silent_element():
    assert [b[:3] for b in html_extract.blocks("<p><a>one <svg><g>x</g></svg>two</a> three<select><option>x</select> four</p>")] == [
        ("one two three four", 4, 2)]
