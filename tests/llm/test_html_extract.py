import html
import re

from fleetlens.llm import html_extract as H
from fleetlens.llm import queries

from .helpers import SF, rows, texts

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>x</style></head><body><header>Site</header><nav><ul><li>Home</li></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="main-ad" class="ad">Buy</div><article><h1>A &amp; B</h1>
<p>One <b>two</b>
   three<br>four<p>Five<script>var a="</p>";</script> six &#233;&nbsp;&eacute;</p><aside>Related</aside><ul><li>i<li>ii</ul>
<div class="share-buttons">Share</div><form><input>Send</form><section class="comments"><p>Nice!</p></section></article>
<div class="sidebar"><p>Side</p></div><footer>&copy; foot</footer></body></html>"""


def plain(page):
    """Article of the test pages, read plainly."""
    a = page[page.find("<article>") + 9:page.rfind("</article>")]
    parts = re.split(r"</?p>|</?h1>", a)
    out = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
    return "\n".join(x for x in out if x)


def test_query_is_the_article_of_every_page(spark):
    got = {r.page_id: r for r in queries.op2_html_extraction(spark, SF).collect()}
    pages = texts("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for i, url, page in pages:
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, plain(page), len(plain(page)))


def test_parts_of_a_page():
    assert H.main_text(PAGE, set()) == "A & B\nOne two three four\nFive six é é\ni\nii"


def test_template_text_without_article(spark):
    pages = [(i, "http://h.example/%d" % i, f"<div>Same line</div><div>Own words {i} of this page</div><div>Other same line</div>") for i in range(6)]
    got = rows(H.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")))
    assert sorted(r[2] for r in got) == sorted(f"Own words {i} of this page" for i in range(6))


def test_copies_of_a_page_keep_their_article(spark):
    pages = [(i, "http://h.example/x", PAGE) for i in range(8)]
    got = rows(H.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")))
    assert {r[2] for r in got} == {H.main_text(PAGE, set())}


def test_odd_rows(spark):
    kind = "page_id bigint, url string, html string, host string, template string, text string"
    data = [(1, None, None), (2, "no url", ""), (3, "http://a", "<"), (4, "http://a", "<p>a<p>b"), (4, "http://a", "<p>a<p>b"),
            (None, "http://a", "<!-- x"), (5, "http://a", "<div>" * 3000 + "deep"), (6, "http://b", "plain " * 50_000), (7, "", "a &bogus; < b <3 &#0; c")]
    got = rows(H.extract(spark.createDataFrame([(*d, "h", "t", "x") for d in data], kind)))
    assert len(got) == len(data)
    by = {r[0]: r[2] for r in got}
    assert by[1] == by[2] == by[None] == "" and by[4] == "a\nb" and by[5] == "deep" and by[6] == ("plain " * 50_000).strip()
    assert rows(H.extract(spark.createDataFrame([], kind))) == []


def extracted(spark, pages):
    rows_ = [(i, "http://h.example/%d" % i, "".join(f"<div>{t}</div>" if t[0] != "<" else t for t in parts)) for i, parts in enumerate(pages)]
    got = H.extract(spark.createDataFrame(rows_, "page_id bigint, url string, html string")).collect()
    return [r.text.split("\n") for r in sorted(got, key=lambda r: r.page_id)]


def test_lines_that_change_order_are_no_template(spark):
    pages = [["Top", *(["X", "Y"] if i % 2 else ["Y", "X"]), f"Own {i}", "Bottom"] for i in range(8)]
    assert extracted(spark, pages) == [p[1:-1] for p in pages]


def test_tokens_are_told_apart_by_their_slot(spark):
    """The line between Top and Mid is template; the same line after Mid comes on some pages only."""
    pages = [["Top", "More", "Mid", f"Own {i}", *["More"] * (i % 3), "Bottom"] for i in range(9)]
    assert extracted(spark, pages) == [p[3:-1] for p in pages]


def test_pages_without_article_give_its_slot(spark):
    pages = [["Start", f"<article><p>Own {i}</p></article>" if i < 6 else f"<p>Own {i}</p>", "Next", f"Side {i}", "End"] for i in range(8)]
    assert extracted(spark, pages) == [[f"Own {i}"] for i in range(8)]


def test_ranks_and_nesting():
    assert H.ranks([1, 9, 2, 1, 2, 2, 1], {1: (1, 2), 2: (1, 2)}) == {1: (0, 1), 2: (0, 1)}
    members = {t: (1, i, 3) for i, t in enumerate([1, 2, 3])} | {t: (4, i, 2) for i, t in enumerate([4, 5])}
    assert H.nesting([1, 4, 5, 2, 3, 4, 5], members) == (set(), {(4, 1, 0)})
    assert H.nesting([1, 4, 5, 2, 4, 5, 3], members)[1] == {(4, 1, 0), (4, 1, 1)}     # in two gaps
    assert H.nesting([1, 4, 2, 5, 3], members)[0] == {4}
    assert H.nesting([4, 1, 5, 2, 3], members)[0] == {4}
    assert H.slots([1, 4, 7, 5, 2, 8, 3, 9], members) == [(), ((1, 0),), ((1, 0), (4, 0)), ((1, 0),), (), ((1, 1),), (), ()]


def test_classes_in_two_gaps_or_crossing_are_dropped(spark):
    """Pairs that cross on one page of many are not valid; those in two gaps are told apart."""
    lines = [["A", "B", "C", "a", "b"]] * 9 + [["A", "a", "B", "b", "C"]]
    tokens = [[ord(t) for t in x] for x in lines]
    import json

    import numpy as np
    frame = spark.createDataFrame([("h", i + 1, bytearray(np.array(x, np.int64).tobytes()), bytearray(len(x))) for i, x in enumerate(tokens)],
                                  "host string, mark bigint, tokens binary, kinds binary")
    tried = spark.createDataFrame([("h", [65, 66, 67]), ("h", [97, 98])], "host string, tokens array<bigint>")
    assert rows(H.nested(frame, None, tried)) == [("h", [65, 66, 67])]
    template = H.Template(json.dumps({"classes": [{"round": 0, "tokens": [65, 66, 67]}]}))
    assert template.told_apart([65, 97, 66, 97, 67])[1] != template.told_apart([65, 97, 66, 97, 67])[3]
