"""Main text of pages: layouts with and without names, broken markup, edge cases; the given pages against their articles."""

import html as references
import re

import pytest
from pyspark.sql import functions as F

from pressledger.llm import html_text
from pressledger.llm.html_text import main_text

WORDS = "the quick brown fox jumps over a lazy dog while many small birds sing in tall green trees near old stone walls"
LONG = [f"Paragraph {i}: {WORDS}, and {WORDS}." for i in range(6)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in LONG)
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(8)) + "</ul>"
BODY = "\n\n".join(LONG)


@pytest.mark.parametrize("page", [
    f"<body><nav>{MENU}</nav><article>{PARAGRAPHS}</article><footer>imprint</footer></body>",
    f"<body><header><h1>Site</h1>{MENU}</header><main>{PARAGRAPHS}<form>Search <input><button>go</button></form></main></body>",
    f'<body><div class="site-header">Site</div><div id="content">{PARAGRAPHS}<div class="ad">Buy now</div></div><div class="sidebar">About us</div></body>',
    f'<body><div role="navigation">{MENU}</div><div class="x1"><div class="x2">{PARAGRAPHS}</div></div><div class="x3">{MENU}</div></body>',
    f'<body><article>{PARAGRAPHS}<section id="comments"><h2>Comments</h2>' + "<article class='comment'><p>I agree with all of this</p></article>" * 40 + "</section></article></body>",
    f'<body class="no-sidebar has-comments"><div class="cookie-notice">We use cookies <p>{WORDS * 5}</p></div>{PARAGRAPHS}</body>',
    f"<body><form action='x'><div id='main'><article>{PARAGRAPHS}</article></div></form></body>",
    f"<body><script>var t = '</p>';</script><style>p {{}}</style><noscript>enable</noscript>{PARAGRAPHS}<!-- <p>no</p> --></body>",
    f"<body><div hidden><p>{WORDS}</p></div><div style='display: none'>{WORDS}</div>{PARAGRAPHS}<aside>{WORDS}</aside></body>",
    f"<html>{PARAGRAPHS}",
    PARAGRAPHS,
])
def test_layouts(page):
    assert main_text(page) == BODY


def test_sections_of_unequal_length_and_headings_stay():
    sections = "".join(f"<div class='s'><h2>Part {i}</h2>{''.join(f'<p>{p}</p>' for p in LONG[:n])}</div>" for i, n in enumerate((6, 1, 2)))
    page = f"<body><nav>{MENU}</nav><div class='t'><h1>Title of it</h1></div><div class='wrap'>{sections}<p>Fin.</p></div><footer>x</footer></body>"
    got = main_text(page).split("\n\n")
    assert got[0] == "Title of it" and got[-1] == "Fin."
    assert [g for g in got if g.startswith("Part")] == ["Part 0", "Part 1", "Part 2"] and len(got) == 14


def test_links_in_running_text_stay_and_menus_without_names_go():
    linked = f'<p>See <a href="/a">this</a> and <a href="/b">that</a>: {WORDS}</p>'
    page = f"<body><div class='q'>{MENU}</div><div class='r'>{PARAGRAPHS}{linked}{MENU}</div></body>"
    assert main_text(page) == BODY + f"\n\nSee this and that: {WORDS}"


def test_blocks_white_space_and_references():
    page = f"<article><h1>A&amp;B &copy; &#x41;&nbsp;c</h1><p>one<br>two <b>th</b>ree\n\t four</p>bare<table><tr><td>x<td>y</table><ul><li>i<li>j</ul>tail &lt;p&gt;{PARAGRAPHS}</article>"
    assert main_text(page) == "A&B © A c\n\none two three four\n\nbare\n\nx\n\ny\n\ni\n\nj\n\ntail <p>\n\n" + BODY


def test_broken_markup():
    assert main_text("<body><article><p><b>One.<br><p>Two.</p></b></div><p>Three</i>.</article></span></body></html></html>") == "One.\n\nTwo.\n\nThree."
    assert main_text("<article><p>cut in the mid") == "cut in the mid"
    assert main_text("<article><p>cut in a tag <a href='x") .startswith("cut in a tag")


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<body><nav><a href=x>menu</a></nav></body>", "<!-- -->", "<script>x"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_one_short_paragraph_and_plain_text():
    assert main_text("<nav><a href=a>Home</a></nav><article><h1>T</h1><p>Ok.</p></article><footer>f</footer>") == "T\n\nOk."
    assert main_text("no markup at all,\n 1 < 2") == "no markup at all, 1 < 2"


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>word</p>" * 100_000 + "</article>").count("word") == 100_000
    assert main_text("<div>" * 50_000 + WORDS + "</div>" * 50_000) == WORDS
    assert len(main_text(f"<article><p>{'word ' * 1_000_000}</p></article>")) == 4_999_999


def test_table_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "u", f"<article>{PARAGRAPHS}</article>"), (1, "u", f"<article>{PARAGRAPHS}</article>"), (None, None, None), (3, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("_html", F.lit("y"))
    got = sorted(map(tuple, html_text.extracted(pages).collect()), key=str)
    assert got == sorted([(1, "u", BODY, len(BODY))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert html_text.extracted(pages.limit(0)).collect() == []


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extracted(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        plain = (references.unescape(re.sub(r"</?b>", "", part).replace("<br>", " ")) for part in re.split(r"</?(?:p|h1)>", article))
        assert got[row.page_id] == "\n\n".join(p for p in (" ".join(p.split()) for p in plain) if p)
