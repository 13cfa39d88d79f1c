"""Pages as they are found: open elements, forms around the page, declared parts, deep nesting."""

import time

import pytest

from facilitymetrics.llm.html_text import main_text
from facilitymetrics.llm.queries import op4_html_extraction

LONG = [f"Paragraph {k} tells at some length what happened, who was there and why it matters to the reader of today." for k in range(4)]
BODY = "".join(f"<p>{x}</p>" for x in LONG)
ARTICLE = f"<article><h1>Title</h1>{BODY}</article>"
TEXT = "\n".join(["Title", *LONG])
BOX = "This text is long enough to look like an article, with hardly a tag in it, and yet it is none of it. " * 4


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><body>{ARTICLE}</body></html>",  # no </head>
    f"<head><meta charset=x><style>p{{}}</style>{ARTICLE}",
    f"<body><select><option>a<option>b</select>{ARTICLE}</body>",
    f"<body><button>Menu{ARTICLE}</body>",
    f"<body><select><option>a{ARTICLE}</body>",
    f"<body><form action=x><div>{ARTICLE}</div></form></body>",
    f"<body><form id=aspnetForm><div class=menu><a href=x>Home</a></div>{ARTICLE}<div id=footer>Imprint</div></form></body>",
    f"<body><form><form class=search><input>Find</form>{ARTICLE}</form></body>",
    f"<body><a href=x>Home<a href=y>News</a>{ARTICLE}</body>",
], ids=range(9))
def test_open_elements_and_forms_lose_nothing(page):
    assert main_text(page) == TEXT


def test_a_form_around_plain_paragraphs():
    assert main_text(f"<form runat=server><h1>Title</h1>{BODY}</form>") == TEXT


def test_a_form_beside_the_article_stays_out():
    assert main_text(f"{ARTICLE}<form><h2>Write to us</h2><p>{BOX}</p></form>") == TEXT
    assert main_text(f"<h1>Title</h1>{BODY}<form><p>Your name and what you think</p></form>") == TEXT


@pytest.mark.parametrize("part", ["class=notice", "class=related", "class=newsletter", "id=discussion", "class='cookie-notice'", "class=comments"])
@pytest.mark.parametrize("before", [True, False])
def test_declared_parts_outside_the_article_stay_out(part, before):
    box = f"<div {part}><p>{BOX}</p><p>{BOX}</p></div>"
    page = f"{box}{ARTICLE}" if before else f"{ARTICLE}{box}"
    assert main_text(f"<body><div id=page>{page}</div></body>") == TEXT
    # Without an article element.
    plain = f"<h1>Title</h1>{BODY}"
    assert main_text(f"<body><div>{box + plain if before else plain + box}</div></body>") == TEXT


@pytest.mark.parametrize("part", ["id=discussion", "class=notice", "id=social", "class=related"])
def test_topics_inside_the_article_stay_in(part):
    inner = f"<section {part}><h2>Discussion</h2><p>{BOX.strip()}</p></section>"
    expected = "\n".join(["Title", *LONG[:2], "Discussion", BOX.strip(), *LONG[2:]])
    halves = ["".join(f"<p>{x}</p>" for x in y) for y in (LONG[:2], LONG[2:])]
    assert main_text(f"<article><h1>Title</h1>{halves[0]}{inner}{halves[1]}</article>") == expected
    assert main_text(f"<body><div><h1>Title</h1>{halves[0]}{inner}{halves[1]}</div></body>") == expected


def test_short_boxes_of_links_in_an_article_stay_out():
    links = "<div class=related>" + "<a href=x>More on this</a> " * 5 + "</div>"
    assert main_text(f"<article><h1>Title</h1>{BODY}{links}</article>") == TEXT


def test_the_header_of_an_article_keeps_its_lead():
    page = f"<body><header><p>{BOX}</p></header><article><header><h1>Title</h1><p>{LONG[0]}</p></header>" + "".join(
        f"<p>{x}</p>" for x in LONG[1:]) + "</article></body>"
    assert main_text(page) == TEXT


def test_a_page_of_nothing_but_a_declared_part():
    assert main_text(f"<div class=notice>{BODY}</div>") == "\n".join(LONG)
    assert main_text(f"<div class=ad>{BODY}</div>") == "\n".join(LONG)
    assert main_text("<nav><a href=x>Home</a></nav>") == ""


@pytest.mark.parametrize("unit", [
    "<b>x ", "<div>x ", "<p>x</i>", "<span class=ad>x ", "<div class=ad>x", "<nav><article>y ", "<form>x ", "<select><option>",
    "<a>x ", "</div>x", "<ul><li>x", "<table><tr><td>x", "<h1>x", "<div class=notice><article>x",
])
def test_time_is_in_proportion_to_the_page(unit):
    def seconds(size):
        page = unit * (size // len(unit))
        began = time.process_time()
        main_text(page)
        return time.process_time() - began

    small = min(seconds(1 << 16) for _ in range(2))
    assert seconds(1 << 19) < 8 * small * 3 + 1


def test_every_given_page_against_its_own_article(spark):
    """The given pages hold their text in one flat article: what it says is what is found."""
    import re
    from html import unescape

    def brute(html):
        inner = re.search("(?s)<article>(.*?)</article>", html or "")
        if not inner:
            return None
        blocks = re.sub(r"(?s)<(script|style).*?</\1>|<(\w+) class=\"ad\".*?</\2>", "", inner[1])
        blocks = re.split(r"</?(?:p|h1|h2|div|ul|li)\b[^>]*>", blocks)
        lines = [" ".join(unescape(re.sub("<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks]
        return "\n".join(x for x in lines if x)

    found = {r["page_id"]: r["text"] for r in op4_html_extraction(spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    expected = {r["page_id"]: brute(r["html"]) for r in pages}
    with_article = {k: v for k, v in expected.items() if v is not None}
    assert len(found) == len(pages) and with_article
    assert {k: found[k] for k in with_article} == with_article
