"""Main text of pages."""

import pytest

from feedwell.llm.html_text import extract_text, main_text, smoothed

LONG = "The council met on Tuesday to talk about the new bridge across the river and its cost over many years."
MENU = "".join(f'<li><a href="/{n}">Item {n}</a></li>' for n in range(12))


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body><nav><ul>{MENU}</ul></nav><article><h1>Bridge</h1><p>{LONG}</p><p>Short.</p>"
    f"<p>{LONG}</p></article><footer>Imprint &copy;</footer></body></html>",
    # No article element: the ratios alone find the region.
    f"<body><div><ul>{MENU}</ul></div><div><h1>Bridge</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    f"<div><a href=x>About</a> <a href=y>Contact</a></div></body>",
    # Everything that is not the article, by name.
    f'<body><header><h2>Site</h2></header><div class="top-menu">{MENU}</div><div id="cookie-notice">We use cookies. {LONG}</div><main>'
    f'<div class="ad">Buy {LONG}</div><article><h1>Bridge</h1><p>{LONG}</p><script>var x = "<p>no</p>";</script><style>p{{}}</style>'
    f"<p>Short.</p><form><label>Name</label><input><button>Go</button></form><p>{LONG}</p></article>"
    f'<section id="comments"><article><p>Reader says {LONG}</p></article></section></main><aside>{LONG}</aside>'
    f'<div role="complementary">{LONG}</div></body>',
    # Broken markup: nothing is ended, an advert is left open before the article.
    f'<body><nav><ul>{MENU}<div class="advert">Buy now<article><h1>Bridge<p>{LONG}<p>Short.<p>{LONG}</article><footer>x',
    # References, comments, entities, white space.
    f"<body><article><h1>\n Bri&#100;ge </h1><!-- <p>no</p> --><p>{LONG.replace(' ', '&#32;&#10; ')}</p><p>Sh<b>or</b>t.</p><p>{LONG}</p>",
])
def test_article_only(page):
    assert main_text(page) == f"Bridge\n\n{LONG}\n\nShort.\n\n{LONG}"


OTHER = "Its engineers showed drawings of the piers and answered questions from the people who live close by for two hours."


@pytest.mark.parametrize("page", [
    # Two sections of one article, of which one holds most of the text.
    f"<body><div><ul>{MENU}</ul></div><div class=content><section><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section>"
    f"<section><p>{OTHER}</p></section></div><div><a href=x>About</a> <a href=y>Contact</a></div></body>",
    # An article in two elements.
    f"<body><div><ul>{MENU}</ul></div><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article><article><p>{OTHER}</p></article></body>",
    # Wrappers whose names hold words of other elements, in one another, around other skipped elements.
    f'<body><div class="layout-with-sidebar"><div id="post-comments-open"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{OTHER}</p></div>'
    f'<div class="sidebar"><p>{OTHER}</p><ul>{MENU}</ul></div></div></body>',
    f'<body><ul>{MENU}</ul><div class="widget"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{OTHER}</p></div></body>',
])
def test_no_part_of_the_article_is_lost(page):
    assert main_text(page) == "\n\n".join([LONG] * 4 + [OTHER])


def test_references_are_decoded_and_markup_inside_words_is_not_a_break():
    assert main_text("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#x20ac; w<i>or</i>d<br>next&nbsp;one</p></article>") == "a <b> &amp; é€ word next one"


@pytest.mark.parametrize("page", ["", " ", "<html></html>", "<nav>x</nav>", "<script>x", "<!-- x -->", "<", "&", "</p></div>"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "<", "&")


def test_plain_text_is_kept():
    assert main_text("just text") == "just text"


def test_smoothing_keeps_constants():
    assert smoothed([5.0] * 9) == pytest.approx([5.0] * 9) and smoothed([]) == []
    assert max(smoothed([0, 0, 9, 0, 0])) < 9


def test_rows(spark):
    rows = [(1, "u", None), (2, None, "<article><p>x</p></article>"), (None, "u", "<p>y</p>"), (2, None, "<article><p>x</p></article>"),
            (3, "long", "<article>" + "<p>some words here</p>" * 20000 + "</article>"), (4, "deep", "<div>" * 3000 + "text")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    found = extract_text(df).collect()
    assert sorted(((r.page_id, r.url, r.text) for r in found if len(r.text) < 99), key=repr) == sorted(
        [(1, "u", ""), (2, None, "x"), (None, "u", "y"), (2, None, "x"), (4, "deep", "text")], key=repr)
    assert all(r.n_chars == len(r.text) for r in found)
    assert next(r.text for r in found if r.page_id == 3).count("\n\n") == 19999
    assert extract_text(df.limit(0)).count() == 0
