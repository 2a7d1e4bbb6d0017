"""Pages with embedded content, unclosed parts and stray quotes lose no text of the article."""

import pytest

from docindex.llm import html_crf

FIRST, LAST = "The first paragraph says a few things at length.", "And the last paragraph ends the story well."
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"


@pytest.fixture(scope="module")
def model():
    return html_crf.train()


@pytest.mark.parametrize("inner, want", [
    ('<p>An icon <svg class="i"/> stands in this line here.</p>', "An icon stands in this line here."),
    ("<p>A root <math display='block'/> and so on we go now.</p>", "A root and so on we go now."),
    ("<video src=a.mp4><p>No film for you today, dear reader.</p>", "No film for you today, dear reader."),
    ("<p>Hear <audio src=a.ogg> this now, dear reader.</p>", "Hear this now, dear reader."),
    ("<div><canvas id=c></div><p>A drawing was there before this.</p>", "A drawing was there before this."),
    ("<p>See <svg><path d='M0'><g> this line of text now.</p>", "See this line of text now."),
    ("<svg><path d='M0'><p>The drawing above was never closed.</p>", "The drawing above was never closed."),
    ("<p>Then <object data=a><object data=b>the inner</object> and the outer text</object> came.</p>", "Then the inner and the outer text came."),
    ("<p>One <svg><svg><path/></svg><text>label</text></svg> and on it went.</p>", "One label and on it went."),
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x=2</annotation></math> holds for all of us.</p>", "So x=2 holds for all of us."),
    ("<p>Icon <svg><title>Tip</title><defs><text>no</text></defs></svg>with a tip inside.</p>", "Icon with a tip inside."),
    ("<noscript><p>The plain form of the text is here.</p></noscript>", "The plain form of the text is here."),
    ('<p class=x">A stray quote opens nothing here.</p><p title="y">It goes on after that.</p>', "A stray quote opens nothing here.\nIt goes on after that."),
    ("<p it's>An apostrophe in a tag is harmless.</p><p>That's all there is to it.</p>", "An apostrophe in a tag is harmless.\nThat's all there is to it."),
    ('<p title="a > b">A sign in a value is no end.</p>', "A sign in a value is no end."),
    ('<p>Before it.<script src="a.js"/> After it all went on.</p><script>var no = "</p>"</script>', "Before it. After it all went on."),
    ("<script src=/a/>var no = 1</script><p>Code is still left out of it.</p>", "Code is still left out of it."),
    ("<template><template><p>no</p></template><p>nor this</p></template><p>Templates are still left out.</p>", "Templates are still left out."),
    ("<!--><p>An empty comment hides nothing here.</p><!-- no -->", "An empty comment hides nothing here."),
])
def test_nothing_is_swallowed(model, inner, want):
    page = f"<body>{NAV}<article><p>{FIRST}</p>{inner}<p>{LAST}</p></article><footer>Imprint</footer></body>"
    assert html_crf.main_texts([page], model) == [f"{FIRST}\n{want}\n{LAST}"]


def test_inline_elements_cut_no_block(spark):
    body = "<p>The <ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby> sign, the <label>name</label> of <my-term>a thing</my-term>, <nobr>kept</nobr> in <output>one</output> line of text.</p>"
    html = "<html><body><article><h1>About signs</h1>" + body + "<p>A second paragraph follows the first one here.</p></article></body></html>"
    out = html_crf.extract(spark.createDataFrame([(1, html)], "page_id long, html string")).first()["text"]
    assert "The 漢(kan) sign, the name of a thing, kept in one line of text." in out.split("\n")


@pytest.mark.parametrize("before, after", [('<p class="related-work">', "</p>"), ('<div class="notice-board"><p>', "</p></div>"), ('<aside class="pullquote"><p>', "</p></aside>"),
                                           ('<p class="comment-worthy">', "</p>"), ('<section id="popular-science"><p>', "</p></section>")])
def test_names_of_more_than_one_word_drop_no_paragraph(spark, before, after):
    inside = "A paragraph that belongs to the article and says something of its own."
    html = f"<html><body>{NAV}<article><h1>Heading</h1><p>{FIRST}</p>{before}{inside}{after}<p>{LAST}</p></article><footer>Imprint</footer></body></html>"
    out = html_crf.extract(spark.createDataFrame([(1, html)], "page_id long, html string")).first()["text"].split("\n")
    assert inside in out and FIRST in out and LAST in out and "Imprint" not in out


@pytest.mark.parametrize("name", ["kopf", "fuss", "werbung", "kommentare", "pied-page", "publicidad", "site-header", "related-posts", "cookie-notice", "ad-slot-3"])
def test_layout_of_other_languages_goes(spark, name):
    noise = "Words of the layout that stand on each page of the site, whatever it says."
    html = f"<html><body>{NAV}<div class='content'><h1>Heading</h1><p>{FIRST}</p><p>{LAST}</p></div><div class='{name}'><p>{noise}</p></div></body></html>"
    out = html_crf.extract(spark.createDataFrame([(1, html)], "page_id long, html string")).first()["text"]
    assert noise not in out and FIRST in out and LAST in out
