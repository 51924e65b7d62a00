"""Main-text extraction: generated pages with known parts, bad markup, and odd rows."""

import time

import numpy as np
import pytest

from beaconframe.llm import html_text

PAGE = "<html><body><nav class=menu><a href=/>Home</a> <a href=/b>News</a></nav><article><h1>A title</h1>%s<p>Second one here, with more words.</article><div class=ad>Buy it now.</div><footer>&copy; all rights</footer>"


def _gold(source: str) -> str:
    page = html_text.parse(source)
    follows = html_text.followers(page)
    chosen = [False] * len(page.tags)
    for k, p in enumerate(page.parents):
        chosen[k] = chosen[p] if follows[k] else (p < 0 or chosen[p]) and page.gold[k] != 1 and page.tags[k] not in html_text.UNSEEN
    return html_text.blocks(page, chosen)


def test_unseen_layouts():
    pages = list(html_text.training_pages(150, seed=99))
    assert np.mean([a == _gold(s) for a, s in zip(html_text.extract(pages, html_text.trained()), pages, strict=True)]) > 0.85


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<p>Water is H<sub>2</sub>O and x<sup>2</sup> <math><mi>y</mi></math> end of it.</p>", "Water is H2O and x2 y end of it."),
        ("<pre>for i in x:\n    print(i)</pre>", "for i in x: print(i)"),
        ('<p>A <a href="x>link</a> in a text of words.</p>', "A link in a text of words."),
        ("<p>If a < b then <span class=share>all of it</span> stays.</p>", "If a < b then all of it stays."),
        ("<p>One<br>two <b><i>three</b></i> four.</i></p>", "One two three four."),
        ("<svg width='9'/><p>After an empty drawing.</p>", "After an empty drawing."),
    ],
)
def test_inline_elements_and_bad_markup(inside, text):
    (got,) = html_text.extract([PAGE % inside], html_text.trained())
    assert got == f"A title\n\n{text}\n\nSecond one here, with more words."


@pytest.mark.parametrize("source", ["<a " * 330_000 + '"', "<b>" * 150_000 + "</i>" * 150_000, "<p><button>" + "<span>" * 90_000 + "<h1></h1>" * 50_000, "<div>" * 200_000 + "x", "<" * 1_000_000, "<li>" * 250_000, '<a title="' * 100_000])
def test_hostile_pages_take_linear_time(source):
    began = time.perf_counter()
    html_text.extract([source], html_text.trained())
    assert time.perf_counter() - began < 20


def test_frames(spark):
    page = PAGE % "<p>First and long paragraph, with words.</p>"
    rows = [(1, "u", page, 1, "t"), (1, "u", page, 1, "t"), (2, None, None, 1, "t"), (None, "v", "", 1, "t"), (4, "w", "<p", 1, "t"), (5, "x", PAGE % ("<p>words and words. </p>" * 20_000), 1, "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, text string")
    out = html_text.main_text(pages, pages.columns).collect()
    assert [(r.page_id, r.url) for r in out] == [(r[0], r[1]) for r in rows] and all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out[2:5]] == ["", "", ""] and out[0].text == out[1].text and len(out[5].text) > 300_000
    assert html_text.main_text(pages.limit(0), ["page_id"]).count() == 0
