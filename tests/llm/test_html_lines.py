import pytest

from sabermill.llm.extraction import main_text
from sabermill.llm.html_lines import ARTICLE, MAIN, OPEN, lines_of


def text(page):
    return main_text(lines_of(page), None)[0]


@pytest.mark.parametrize(
    "tag",
    [
        "div style='overflow:hidden'", 'div aria-hidden="false"', 'p title="a hidden gem"', "div data-hidden=1", 'h2 id="related-work"', 'section id="search-methods"',
        'section id="search"', 'p id=share', 'h2 id="comments"', 'div class="content has-sidebar"', 'div class="post share-enabled"', "div class='section' id='search'",
        'div data-class="ad"', 'dt id="cookies"', "p title='class=ad'",
    ],
)
def test_only_whole_tokens_and_attributes_name_a_part(tag):
    name = tag.split()[0]
    assert text(f"<article>a<{tag}>b</{name}>c</article>") == "a b c"
    assert text(f"<{tag}><article>b</article></{name}>") == "b"


@pytest.mark.parametrize("tag", ["div hidden", "p hidden=''", "div aria-hidden='true'", "div class='x Ad'", "div role=navigation", "div id=comments", "div class=cookie_notice", "ul class='site-nav'"])
def test_parts_stay_excluded(tag):
    assert text(f"<article>a<{tag}>b</{tag.split()[0]}>c</article>") == "a c"


def test_an_element_around_the_article_is_not_excluded():
    assert text("<form><div>menu</div><article>body</article></form>") == "body"
    assert lines_of("<form><main>x<form>y</main></form>z") == [("x", MAIN), ("y", MAIN), ("z", OPEN)]
    assert text("<main>m<form><article>body</article></form></main>") == "body"
    assert text("<div class=sidebar>menu<article>the body</article></div>") == "the body"
    assert text("<form><article>body</article><aside><article>teaser</article></aside></form>") == "body"
    assert lines_of("<article>body<form>f</form></article><aside><article>teaser</article></aside>") == [("body", ARTICLE)]
    assert text("<main>body<aside><article>teaser</article></aside></main>") == "body"
    assert text("<div>a long body of text</div><aside><article>teaser</article></aside>") == "a long body of text"
    assert text("<article class='comment'>c</article><div>body</div>") == "body"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p class=ad>buy<p>one</p><p>two</p>", "one two"),
        ("<p class=ad>buy<div>one</div>two", "one two"),
        ("<p class=ad>buy<b>now<hr>one", "one"),
        ("<ul><li class=ad>buy<ul><li>now</ul>more<li>one<li>two</ul>three", "one two three"),
        ("<ul><li class=ad>buy</ul>one", "one"),
        ("<dl><dt class=ad>buy<dd>one<dd class=ad>x<dt>two</dl>", "one two"),
        ("<table><tr class=ad><td>buy<td>x<tr><td>one<th hidden>y<td>two</table>three", "one two three"),
        ("<table><tr><td class=ad>buy<table><tr><td>x<tr><td>y</table>z<td>one<tbody hidden><tr><td>u<tbody><tr><td>two</table>", "one two"),
        ("<div><nav>menu</div>one", "one"),
        ("<datalist><option class=ad>x<option>one</datalist><br>two", "one two"),
        ("<p class=ad>buy<button>x<p>y</button>more<p>one", "one"),
        ("<p class=ad>buy<span>x</p>one<span class=ad>y<p>z</span>two", "one two"),
        ("<h2 class=ad>buy<h2>one</h3>two", "one two"),
    ],
)
def test_end_tags_left_out(page, want):
    assert text(f"<article>{page}</article>after") == want


def test_a_head_without_end_tag():
    assert lines_of("<html><head><title>T</title><style>s</style><body>one") == [("one", OPEN)]


def test_many_open_elements_are_quick():
    assert len(lines_of("<div>" * 20_000 + "<p>x" * 20_000 + "<b>y" * 20_000)) == 20_000
