import html
import random
import re
import time

import pytest

from tidewire.llm.html_extract import extract, main_text

LONG = (
    "This is a paragraph of the article and it has a lot of the words that are to be found in any "
    "text of the kind, so that it is long enough for the rules of the extraction."
)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {row["page_id"]: row for row in extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        blocks = [re.sub(r"<[^>]+>", "", part) for part in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(block).split()) for block in blocks]
        want = "\n".join(block for block in blocks if block)
        assert got[row["page_id"]]["text"] == want
        assert got[row["page_id"]]["n_chars"] == len(want)
        assert got[row["page_id"]]["url"] == row["url"]


def test_edge_rows(spark):
    rows = [
        (1, "u", None, "a"),
        (2, None, "", "b"),
        (None, "u", "<p>x", "c"),
        (3, "u", "<p>x", "d"),
        (3, "u", "<p>x", "d"),
        (4, "u", "<article><p>" + (LONG + "</p><p>") * 5000, "e"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = [(row["page_id"], row["text"], row["n_chars"]) for row in extract(pages).collect()]
    whole = "\n".join([LONG] * 5000)
    want = [(1, "", 0), (2, "", 0), (None, "x", 1), (3, "x", 1), (3, "x", 1), (4, whole, len(whole))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert extract(pages.limit(0)).count() == 0


def test_boilerplate_by_name_and_by_place():
    page = f"""<html><head><title>no</title><style>p{{x}}</style></head><body class="no-sidebar">
    <div id="cookie-notice"><p>{LONG}</p></div><header><h2>Site</h2></header><nav><a href=x>Home</a></nav>
    <main><h1>Title</h1><p>{LONG}</p><p>Short.</p><aside><p>{LONG}</p></aside>
    <form><p>{LONG}</p></form><script>var t = "</p>{LONG}";</script>
    <p>A &lt;b&gt; caf&eacute;<br>and
    more&#33;</p><ul class="share-links"><li>Tweet</li></ul>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section></main>
    <div class="sidebar"><p>{LONG}</p></div><footer><p>{LONG}</p></footer></body></html>"""
    assert main_text(page) == f"Title\n{LONG}\nShort.\nA <b> café and more!"


def test_pages_without_an_article():
    page = f"""<body><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div>
    <h1>Title</h1><p>{LONG}</p><p>Between.</p><p>{LONG}</p>
    <div><a href=x>{LONG}</a></div><p>Lorem {'ipsum ' * 60}</p></body>"""
    assert main_text(page) == f"Title\n{LONG}\nBetween.\n{LONG}"


def test_malformed_pages():
    assert main_text("plain < text & more") == "plain < text & more"
    assert main_text("<nav><a>x</a><article><p>kept<p>too</article></nav>") == "kept\ntoo"
    assert main_text("<p><b>a<br><p>b</p></b>c</i>") == "a\nb\nc"
    assert main_text("<p>hello <script>x</script> world") == "hello world"
    assert main_text("<!-- <p>no</p> --><p>yes<!-- no") == "yes"


def test_markup_that_no_parser_knows():
    for mark in ("<![foo[ x ]]>", "<![CDATA[ x ]]>", "<![if !IE]>", "<![", "<!foo bar>", "<?php x ?>", "<!--->"):
        page = f"<p>{LONG}</p>{mark}<p>{LONG}</p>"
        assert main_text(page).startswith(LONG), mark
    assert main_text(f"<article><p>{LONG} &#{'9' * 6000}; &#{'0' * 5000}65; &#x{'f' * 6000};</p></article>") == (
        f"{LONG} \ufffd A \ufffd"
    )
    assert main_text(f"<a href='&#{'9' * 6000};'>x</a><p>{LONG}</p>") == LONG


def test_one_malformed_page_stops_no_job(spark):
    pages = spark.createDataFrame([(1, "u", "<![foo[ x ]]><p>x</p>"), (2, "u", "<p>y</p>")], "page_id long, url string, html string")
    assert [(row["page_id"], row["text"]) for row in sorted(extract(pages).collect())] == [(1, "x"), (2, "y")]


PARTS = (
    "<p> </p> <div> </div> <article> </article> <nav> </nav> <form> </form> <script> </script> <a href=x> </a> <h1> </h1>"
    " <![foo[ ]]> <![CDATA[ <!-- --> <!x <? ?> </ < > & &amp; &#; &#x; &#99999999999; &#xD800; <br/> <li> <td> </table>"
    " <b </b <svg> </svg> <textarea> <title> word the and of \x00 é 日本語 \ud800 = ' \" <p/class='nav'> <main hidden>"
    " <plaintext> </body> <!DOCTYPE <!ELEMENT <![if ]> <a<b> <p =x> <p a='"
).split()


@pytest.mark.parametrize("seed", range(10))
def test_random_markup_never_raises(seed):
    draw = random.Random(seed)
    for _ in range(1000):
        glue = draw.choice(["", " "])
        text = main_text(glue.join(draw.choices(PARTS, k=draw.randint(1, 40))))
        assert isinstance(text, str) and text == text.strip()


def test_languages_that_are_not_listed():
    russian = "Сегодня утром в городе прошёл сильный дождь, и многие улицы оказались под водой. " * 3
    japanese = "今日は朝から強い雨が降り続き、町の多くの通りが水に浸かりました。" * 9
    for prose in (russian.strip(), japanese):
        page = f"<body><ul><li><a href=a>x</a></li></ul><h1>x</h1><p>{prose}</p><p>y</p><div><a href=x>{prose}</a></div></body>"
        assert main_text(page) == f"x\n{prose}\ny"


def test_an_article_in_a_form_around_the_page():
    page = f"<body><form id=page><nav><a href=a>no</a></nav><article><p>{LONG}</p></article></form></body>"
    assert main_text(page) == LONG
    assert main_text(f"<form><article class=comment><p>{LONG}</p></article></form>") == ""
    assert main_text(f"<div class=sidebar><form><article><p>{LONG}</p></article></form></div><p>{LONG} x</p>") == f"{LONG} x"


def test_a_heading_that_is_a_link():
    page = f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><p><a href=x>More of this</a></p></article>"
    assert main_text(page) == f"Title\n{LONG}"


def test_deep_pages_take_no_longer_than_flat_ones():
    deep = 9000
    page = f"<nav>{'<div>x' * deep}{'</div>' * deep}</nav><p>{LONG}</p>" + "<p>y</p>" * deep
    start = time.perf_counter()
    assert main_text(page).startswith(LONG)
    assert time.perf_counter() - start < 2
