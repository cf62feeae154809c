"""Main text of pages with everything that is not the article."""

import pytest

from keelson.llm import html_text

P = "<p>A first paragraph, long enough, with a few commas, to score points &amp; more.</p>"
T = "A first paragraph, long enough, with a few commas, to score points & more."


@pytest.mark.parametrize(("source", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("plain words only", "plain words only"), ("a < b and c > d", "a < b and c > d"),
    (f"<html><body><nav><a href=x>Menu item, one</a></nav><article><h1>Head</h1>{P}<p>Short.</p></article><footer>Foot, of the page, quite long</footer>", f"Head {T} Short."),
    (f"<body><div class='sidebar'>{P.replace('first', 'other')}</div><div id=content>{P}</div>", T),
    (f"<body><main>{P}<form>Your name, please, and your long address<input></form><div class=ad>Buy, buy, buy this long advert now</div></main>", T),
    (f"<body><article>{P}</article><section class='comments'><p>A reader comment, which is long, and wordy, to score.</p></section>", T),
    (f"<body><header>Site name, long enough to be a paragraph</header><div class=post>{P}</div><div id=cookie-notice>We use cookies, many, many cookies here</div>", T),
    (f"<article><p>Un<b>bro</b>ken, words&nbsp;and\n\t space and more of it here<br>next line</p>{P}", f"Unbroken, words and space and more of it here next line {T}"),
    (f"<article><script>var a='<p>not, this, text, at all, never</p>';</script><style>p{{}}</style>{P}<!-- <p>nor this</p> --></article>", T),
    (f"<article>{P}<ul class=x><li><a href=1>Linked, one</a><li><a href=2>Linked, two</a></ul></article>", T),
    (f"<article>{P}<ul><li>An entry<li>Another</ul></article>", f"{T} An entry Another"),
    (f"<article><p><b>Open, bold paragraph that is never closed at all<br>{P}</article>", f"Open, bold paragraph that is never closed at all {T}"),
    (f"<article title='a > b'>{P}<script>never closed <p>x</p>", T),
    ("<article><p>tiny</p></article>", "tiny"),
    ("&lt;p&gt; &#233;&#x1F600; &notanentity; &amp;amp;", "<p> é\U0001f600 ¬anentity; &amp;"),
])
def test_pages(source, text):
    assert html_text.main_text(source) == text


def test_long_and_deep_pages():
    deep = "<div>" * 5000 + P + "</div>" * 5000
    assert html_text.main_text(deep) == T
    assert html_text.main_text("<article>" + P * 3000 + "</article>") == " ".join([T] * 3000)
    assert html_text.main_text("<a b='" * 2000) is not None


def test_table(spark):
    rows = [(1, "u", f"<article>{P}"), (1, "u", f"<article>{P}"), (None, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = html_text.extract(df)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", T, len(T)), (1, "u", T, len(T)), (None, None, "", 0)], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(("source", "text"), [
    (f"<body><div>{P * 6}</div><div><p>A second section, with a short paragraph.</p></div>", " ".join([T] * 6) + " A second section, with a short paragraph."),
    (f"<body><div>{P * 6}</div><h2>Part two</h2><ul><li>One</li><li>Two</li></ul><table><tr><td>Cell</table><div>{P}</div>",
     " ".join([T] * 6) + f" Part two One Two Cell {T}"),
    (f"<article>{P}<h2>References</h2><ol><li><a href=1>A linked title</a></li><li><a href=2>Another title</a></li></ol></article>",
     f"{T} References A linked title Another title"),
    (f"<article>{P}<ol><li>Doe (2020). <a href=1>A rather long linked title</a>.<li>Roe (2021). <a href=2>Another long linked title</a>.</ol></article>",
     f"{T} Doe (2020). A rather long linked title. Roe (2021). Another long linked title."),
    (f"<body><div>{P * 6}</div><div><ul><li><a href=1>A long link, elsewhere, to go to</a><li><a href=2>One more, of the long links</a></ul></div>", " ".join([T] * 6)),
])
def test_sections_and_reference_lists(source, text):
    assert html_text.main_text(source) == text
