"""Copies of pages do not make a template, and an article keeps its parts."""

from __future__ import annotations

from helixframe.llm import html


def texts(spark, rows):  # noqa: ANN001, ANN201
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def body(k: int, rest: str = "") -> str:
    return f"<body><div>Site name</div><p>content {k} first<p>content {k} second</p>{rest}</body>"


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(k, f"http://h/{k}", body(0)) for k in range(5)]
    assert set(texts(spark, rows).values()) == {"Site name\ncontent 0 first\ncontent 0 second"}


def test_copies_that_differ_in_excluded_parts_only(spark):
    rows = [(k, f"http://h/{k}", body(0, f"<aside>advert {k}</aside>")) for k in range(5)]
    assert set(texts(spark, rows).values()) == {"Site name\ncontent 0 first\ncontent 0 second"}


def test_half_of_a_host_are_copies(spark):
    rows = [(k, f"http://h/{k}", body(max(0, k - 3))) for k in range(8)]  # pages 0 to 3 are copies
    got = texts(spark, rows)
    assert got == {k: f"content {max(0, k - 3)} first\ncontent {max(0, k - 3)} second" for k in range(8)}


def test_a_page_of_template_alone_keeps_its_slots(spark):
    rows = [(k, f"http://h/{k}", body(k)) for k in range(5)] + [(9, "http://h/", "<body><div>Site name</div></body>")]
    got = texts(spark, rows)
    assert got[9] == "Site name" and got[1] == "content 1 first\ncontent 1 second"


def test_an_article_keeps_parts_whose_names_hold_a_hint(spark):
    kept = "<h2 id='market-share'>Share</h2><section id='related-work'><p>Work</p></section><p id='social-history'>History</p><h2 class='notice'>Notice</h2><p class='share'>Of all</p><div class='ad-hoc'>Query</div>"
    gone = "<div class='box share'>x</div><ul class='Related'><li>x</ul><div role='navigation'>x</div><section id='comments'>x</section><div hidden>x</div><div class=notice><p>x</div><nav>x</nav>"
    assert texts(spark, [(1, "http://h/", f"<article>{kept}{gone}</article>")]) == {1: "Share\nWork\nHistory\nNotice\nOf all\nQuery"}
    outside = "<p>Text</p><div id='social-links'>x</div>"
    assert texts(spark, [(1, "http://h/", f"<body>{outside}</body>")]) == {1: "Text"}


def test_references_are_decoded_before_markup_is_taken_out():
    page = html.Page("<article><p>a &lt;b&gt; &amp;lt; &am<i>p;</i> &#<b>65;</b> &#x41;&#65; 1 < 2&nbsp;</p></article>")
    assert [x for _, x in page.content()] == ["a <b> &lt; &amp; &#65; AA 1 < 2"]
