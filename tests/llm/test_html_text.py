import re
from html import unescape

import pytest

from brooklet.llm import html_text
from brooklet.llm.catalog import QUERIES

ARTICLE = (
    "<h1>A title &amp; more</h1><p>The first  paragraph\n is long enough to be read, with <b>bold</b> and <a href='x'>a link</a> in it.</p>"
    "<p>The second one has a break<br>in it, and some more words after that so that it is dense.")
TEXT = (
    "A title & more\nThe first paragraph is long enough to be read, with bold and a link in it.\n"
    "The second one has a break in it, and some more words after that so that it is dense.")
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(12)) + "</ul>"


@pytest.mark.parametrize("page", [
    f"<html><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>&copy; nobody</footer></body></html>",
    f"<body><div id=menu>{MENU}</div><div class='content'>{ARTICLE}</div></div><div class=sidebar>{MENU}</div></body>",
    f"<main><div class='cookie-notice'>We use cookies, and so on and on.</div>{ARTICLE}</p><form>Name <input><select><option>a<option>b</select></form></main>",
    f"<article>{ARTICLE}</p><section class='comments'><p>A reader says that this is a long and dense comment, really.</p></section></article>",
    f"<script>var a = '<p>not text</p>';</script><style>p {{ }}</style><article><!-- <p>hidden</p> -->{ARTICLE}<aside>beside</aside></article>",
    f"<ARTICLE>{ARTICLE}<div class=\"ad\">Buy now, buy now, buy now and never stop buying.</div><p hidden>no</p></ARTICLE><p",
    f"<header>The site<p>with its long, long motto that is dense too</header><article><header>{ARTICLE}</header></article>",
])
def test_articles_among_other_parts(page):
    assert html_text.main_text(page) == TEXT


def test_all_sections_of_a_page_without_article_or_main():
    first, second = [f"{i} one " + "first " * 16 for i in range(10)], [f"{i} two " + "other " * 16 for i in range(8)]
    title, lead = "A title outside the sections", "A lead with <a href=x>a link</a>."
    sections = "".join(f"<div>{''.join(f'<p>{t}</p>' for t in part)}</div>" for part in (first, second))
    content = f"<div class=content><h1><a href=y>{title}</a></h1><p>{lead}</p>{sections}</div>"
    links = "".join(f"<a href='/{i}'>Entry {i}</a> | " for i in range(9))
    want = "\n".join([title, "A lead with a link.", *(t.strip() for t in first + second)])
    assert html_text.main_text(content) == want
    assert html_text.main_text(f"<html><body><div>{MENU}</div>{links}{content}<div><p>{links}</p></div></body></html>") == want
    # A wrapper that is mostly links, with a dense section in it.
    mixed = f"<div>{MENU * 30}<div>{'<p>' + 'dense ' * 30 + '</p>'}</div></div>"
    assert html_text.main_text(f"<body>{content}{mixed}</body>") == want + "\n" + ("dense " * 30).strip()


@pytest.mark.parametrize("page", [
    *(f"<body class='{c}'><nav>{MENU}</nav><div class=content>{ARTICLE}</div></body>" for c in ("no-sidebar", "nav", "has-header with-comments")),
    *(f"<body><div class='{c}'><article class='post {c}'>{ARTICLE}</article></div></body>" for c in (
        "overflow-hidden", "no-sidebar", "has-header", "with-comments", "content-related", "notice", "hidden")),
    *(f"<html id=pageHeader><main class='widget modal'>{ARTICLE}</main></html>" for _ in range(1)),
    f"<div class='content'><div class='article-header' id=pageHeader>{ARTICLE.replace('</h1>', '</h1></div>')}</div>",
    f"<article><div class=header>{ARTICLE.replace('</h1>', '</h1></div>')}</article>",
    f"<body><form action=x><input name=state><div class=menu>{MENU}</div><div>{ARTICLE}</p></div><form>Name</form></form></body>",
    f"<body><form action=x><div id=main>{ARTICLE}</p></div><fieldset>Your name</fieldset></form></body>",
    f"<article>{ARTICLE}</p></article><ol class=comment-list><li><article class=comment>{'<p>A reader has more to say. ' * 30}</article></ol>",
    f"<article>{ARTICLE}</p></article><div class=ad>{'<p>Buy now and never stop buying. ' * 30}</div>",
    f"<article><form>{ARTICLE}</p></form></article><article class=comment>A reader</article>",
    f"<div class=content>{ARTICLE}</p></div><div id='user-comments'><article>A reader</article></div><div class='site-header'>The site</div>",
])
def test_names_cut_no_more_than_their_parts(page):
    assert html_text.main_text(page) == TEXT


def test_characters_and_white_space():
    page = "<article><p>&lt;b&gt; &eacute;&#233;&#x1F44D; a \t b</p><ul><li>one<li>two</ul><table><tr><td>c<td>d</table><pre> x\n  y </pre></article>"
    assert html_text.main_text(page) == "<b> éé👍 a b\none\ntwo\nc\nd\nx y"


def test_pages_that_are_hardly_pages():
    assert html_text.main_text("") == html_text.main_text("<html></html>") == html_text.main_text("<!-- x") == ""
    assert html_text.main_text("only text") == "only text"
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"
    assert html_text.main_text("a < b and <3 <p>c") == "a < b and <3\nc"


def test_query_on_its_whole_table(spark, sf, database):
    def plain(page):
        body = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(b for b in blocks if b)

    rows = QUERIES["op3_html_extraction"](spark, sf).collect()
    pages = {i: (u, h) for i, u, h in database.execute("SELECT page_id, url, html FROM pages").fetchall()}
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == {i: (u, plain(h)) for i, (u, h) in pages.items()}
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "v", f"<article>{ARTICLE}", None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0), (2, "v", TEXT, len(TEXT))], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0
