import html as entities
import re

import numpy as np
import pytest

from utterflow.llm.extraction import extracted, main_text, smoothed

LONG = "Words of an article that go on for a while, with commas and a full stop."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain  text\nonly", "plain text only"),
        ("a &lt; b &amp; c &eacute; &#233; &nosuch;", "a < b & c é é &nosuch;"),
        ("<p>one<p>two<br>three", "one\ntwo three"),
        ("<p><b>bold.<br><p>next</p>", "bold.\nnext"),
        ("<nav>menu</nav><footer>end</footer>", ""),
        ("<script>var a = '</p>';</script><style>p{}</style><p>x</p><!-- no -->", "x"),
        ("<article><header>top</header><h1>Title</h1><p>x</p><aside>no</aside></article>", "Title\nx"),
        (f"<body><div class='side-bar'>x</div><div><p>{LONG}<p>Short.</div></body>", f"{LONG}\nShort."),
        (f"<div class='ad'>Buy</div><main><p>{LONG}</main><div id=comments><p>{LONG}</div>", LONG),
        (f"<article><p>{LONG}<form>f<p>g</form><p>End.</article><p>{LONG}", f"{LONG}\nEnd."),
        ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", "one\ntwo\ndeep\nthree"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>in<i>line</i> <a href='x'>li</a>nk", "inline link"),
        ("</div></p>stray <p>ends</b></p>", "stray\nends"),
        ("<div hidden>no</div><p>yes", "yes"),
        ("<p class='header-note readable'>kept? no</p><p class='lead'>kept", "kept"),
        ("<p>unclosed <b attr", "unclosed"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_smoothing_keeps_a_constant_and_the_length():
    for n in (1, 2, 5, 20):
        assert smoothed(np.full(n, 3.0)) == pytest.approx([3.0] * n)


def test_articles_of_the_tables_are_whole(sample):
    rows = {r.page_id: r.text for r in extracted(sample("pages")).collect()}
    for page in sample("pages").collect():
        inside = page.html[page.html.index("<article>") + 9 : page.html.index("</article>")]
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inside)
        blocks = [entities.unescape(re.sub("<[^>]+>", " ", b)) for b in blocks]
        blocks = [" ".join(b.split()) for b in blocks]
        assert rows[page.page_id] == "\n".join(b for b in blocks if b)


def test_rows_and_columns(spark):
    rows = [(1, "u", "<p>héllo</p>", "x"), (1, "u", "<p>héllo</p>", "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    result = sorted(tuple(r) for r in extracted(pages).where("page_id = 1").collect())
    assert result == [(1, "u", "héllo", 5)] * 2
    assert [tuple(r) for r in extracted(pages).where("page_id IS NULL").collect()] == [(None, None, "", 0)]
    assert extracted(pages.limit(0)).count() == 0


def test_a_very_long_page():
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(page).count("\n") == 19_999


BODY = f"<div><p>{LONG}<p>{LONG}<p>{LONG}</div>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><div><p>A lead of some words.</div>{BODY}</body>", ["A lead of some words."] + [LONG] * 3),
        (f"<body>{BODY}<section><p>An ending of some words.</section></body>", [LONG] * 3 + ["An ending of some words."]),
        (f"<body>{BODY}<article><p>A teaser of a card.</article></body>", [LONG] * 3 + ["A teaser of a card."]),
        (f"<body><nav>menu</nav><main>{BODY}</main><div><p>A few words.</div></body>", [LONG] * 3),
    ],
)
def test_content_in_several_sections_stays(page, text):
    assert main_text(page) == "\n".join(text)
