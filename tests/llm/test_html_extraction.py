import html as entities
import re

import pytest

from runlens.llm import queries
from runlens.llm.html_extraction import extract, main_text

from .helpers import DATA

FRAME = ('<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>x";</script></head><body>'
         '{0}</body></html>')
LONG = "A sentence that is long enough to look like the running text of an article on some page. "


@pytest.mark.parametrize("page,text", [
    (None, ""),
    ("", ""),
    ("<p></p>", ""),
    ("plain text\n only", "plain text only"),
    ("<p>a<b>b</b>c</p>", "abc"),
    ("<p>one<br>two</p>", "one two"),
    ("<p>fish &amp; chips &#233;&lt;</p>", "fish & chips é<"),
    ("<p>a \n\t b&nbsp;c</p><p>d</p>", "a b c d"),
])
def test_blocks_and_references(page, text):
    assert extract(page) == text


def test_furniture_goes_and_short_paragraphs_stay():
    page = FRAME.format(
        '<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad -->'
        '<div class="ad">Buy this now, it is cheap and good and cheap and good and cheap</div>'
        '<div class="cookie-notice">We use cookies and need your consent for that, of course</div>'
        f'<article><h1>Head</h1><p><b>{LONG}<br><p>Ti.</p><p>{LONG}</p><p>End</p>'
        '<form><label>Mail</label><input></form><aside>Also read this</aside></article>'
        '<div id="comments"><p>First! What a great article this is, I liked it a lot, thank you</p></div>'
        '<footer>&copy; me</footer>')
    assert extract(page) == f"Head {LONG.strip()} Ti. {LONG.strip()} End"


def test_without_article_the_content_container_is_found():
    paragraphs = "".join(f"<p>{LONG}</p>" for _ in range(5))
    page = FRAME.format('<div class="menu"><a href="a">x</a></div>'
                        f'<div class="col"><h2>Head</h2>{paragraphs}<p>Bye.</p></div>'
                        '<div class="col2"><p>short</p><ul><li><a href="1">one link</a></li></ul></div>')
    assert extract(page) == " ".join(["Head", *[LONG.strip()] * 5, "Bye."])


def test_frame_classes_and_headers_of_articles_are_not_furniture():
    page = FRAME.format('<div class="page-with-sidebar"><main><div class="entry-header"><h1>Head</h1></div>'
                        f'<header><p>By me</p></header><p>{LONG}</p></main><div class="sidebar">{LONG}</div></div>')
    assert extract(page) == f"Head By me {LONG.strip()}"


def test_links_within_the_article():
    page = FRAME.format(f'<article><p>{LONG}</p><p><b><a href="x">one link</a></b></p><p><a href="1">a</a> | <a href="2">b</a></p>'
                        f'<p>See <a href="1">this</a> and <a href="2">that</a>.</p></article>')
    assert extract(page) == f"{LONG.strip()} one link a | b See this and that."  # entries of a list of references stay


def test_links_beside_the_article_are_menus():
    page = f'<body><div><p><a href="1">a</a> | <a href="2">b</a></p><p>{LONG}</p><p>{LONG}</p></div></body>'
    assert extract(page) == f"{LONG.strip()} {LONG.strip()}"


def test_formulas_and_controls_within_the_article():
    page = FRAME.format(f'<article><p>Let <math><mi>x</mi></math> be a number.</p><p>{LONG}</p>'
                        '<p>Press <button>Save</button> to go on.</p></article>')
    assert extract(page) == f"Let x be a number. {LONG.strip()} Press Save to go on."
    assert extract(f"<body><button>Menu</button><div><p>{LONG}</p></div></body>") == LONG.strip()


def test_deep_and_unclosed_nesting_takes_linear_time():
    import time
    start = time.process_time()
    assert len(extract("<div>some words of text " * 130_000)) == 130_000 * len('some words of text ') - 1  # a page of 3 MB
    extract("<div>" * 40_000 + "<span>a </b>" * 40_000)
    assert time.process_time() - start < 20


def test_truncated_and_unclosed_markup():
    assert extract(f"<body><nav><ul><li><a>m</a><article><p>{LONG}<p>tail <b>x") == f"{LONG.strip()} tail x"
    assert extract("<script>never closed <p>x</p>") == ""
    assert extract("<p>deep" + "<div>" * 5000 + "end") == "deep end"


def test_very_long_page():
    text = " ".join(["word"] * 300_000)
    assert extract(f"<article><p>{text}</p></article>") == text


def test_table_of_pages_whole_and_extra_columns(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG}</p>", "old"), (2, None, None, "x"), (2, None, None, "x"), (None, "u", "", None)],
                                  "page_id long, url string, html string, text string")
    found = sorted((r["page_id"] or 0, r["text"]) for r in main_text(pages).collect())
    assert found == [(0, ""), (1, LONG.strip()), (2, ""), (2, "")]
    assert main_text(pages.limit(0)).count() == 0


def test_query_against_plain_cutting_of_the_article(spark):
    """The pages of the test tables hold one article element each; cut it out and strip its tags."""
    rows = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    found = {r["page_id"]: r for r in queries.QUERIES["op1_html_extraction"](spark, DATA).collect()}
    assert len(found) == len(rows)
    for row in rows:
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", row["html"], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", body)]
        text = " ".join(b for b in blocks if b)
        assert found[row["page_id"]]["text"] == text
        assert found[row["page_id"]]["n_chars"] == len(text)


def paragraphs(n):
    return "".join(f"<p>{LONG}</p>" for _ in range(n)), " ".join([LONG.strip()] * n)


@pytest.mark.parametrize("sizes", [(1, 3), (2, 6), (1, 2, 9), (5, 1)])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_without_article_sibling_parts_of_unequal_size_stay(tag, sizes):
    parts = "".join(f"<{tag} class=c{n}><h2>Head</h2>{paragraphs(n)[0]}<p>Bye.</p></{tag}>" for n in sizes)
    page = FRAME.format(f'<div class="menu"><a href="a">x</a></div><div class="wrap">{parts}</div>'
                        f'<div class="sidebar">{LONG}</div>')
    assert extract(page) == " ".join(f"Head {paragraphs(n)[1]} Bye." for n in sizes)


def test_a_lead_right_before_the_container_stays():
    page = FRAME.format(f'<h1>Head</h1><p>{LONG}</p><div class="text">{paragraphs(4)[0]}</div>')
    assert extract(page) == f"Head {paragraphs(5)[1]}"


def test_teaser_articles_do_not_replace_the_text():
    page = FRAME.format(f'<div class="story"><h1>Head</h1>{paragraphs(6)[0]}</div><article class="teaser"><p>{LONG}</p></article>')
    assert f"Head {paragraphs(6)[1]}" in extract(page)


def test_a_standfirst_in_main_before_the_article_stays():
    page = FRAME.format(f'<main><div class="lead"><p>{LONG}</p></div><article>{paragraphs(5)[0]}</article></main><div><p>{LONG}</p></div>')
    assert extract(page) == paragraphs(6)[1]


@pytest.mark.parametrize("frame", ["<article>{0}</article>", '<div class="body">{0}</div>'])
def test_ids_made_from_headings_are_no_furniture(frame):
    parts = "".join(f'<section id="{name}"><h2 id="{name}-rules">{name}</h2><p id="{name}">{LONG}</p></section>'
                    for name in ("social-history", "form-validation", "related-work", "alert-rules", "sharing-data"))
    names = ("social-history", "form-validation", "related-work", "alert-rules", "sharing-data")
    assert extract(FRAME.format(frame.format(parts))) == " ".join(f"{n} {LONG.strip()}" for n in names)


def test_furniture_within_an_article_still_goes():
    page = FRAME.format(f'<article><h1>Head</h1><p>{LONG}</p><div class="share-buttons"><p>Share this</p></div>'
                        f'<div class="ad"><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div>'
                        f'<div class="alert alert-info"><p>Mind the gap</p></div><p>{LONG}</p></article>')
    assert extract(page) == f"Head {LONG.strip()} Mind the gap {LONG.strip()}"


@pytest.mark.parametrize("inner", ["<article>{0}</article>", '<div class="text">{0}</div>'])
@pytest.mark.parametrize("form", ['<form method="post" action="./p.aspx" id="aspnetForm">', '<form id="form1">', "<form>"])
def test_a_form_around_the_page_is_a_frame(form, inner):
    body, text = paragraphs(4)
    page = FRAME.format(f'{form}<nav><ul><li><a href="a">menu</a></li></ul></nav>{inner.format(body)}'
                        '<div id="footer">&copy; me</div></form>')
    assert extract(page) == text
    page = FRAME.format(f'<div class="text">{body}</div><form><label>Mail</label><input><p>We send you letters</p></form>')
    assert extract(page) == text
