import html
import random
import re
import time

import pytest

from numprep.llm.html_extract import _layout, extract, fit, labels_of, leaf_blocks, main_text


@pytest.fixture(scope="module")
def pages(spark, tables):
    return spark.read.parquet(f"{tables}/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return fit(pages)


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def test_blocks():
    assert texts("") == [] and texts("just text") == ["just text"]
    assert texts("<p>a<b>b</b>c<br>d\n\te&nbsp;f &amp;&lt;&#233;<p>g") == ["abc d e f &<é", "g"]
    assert texts("<div>a<ul><li>b<li>c</ul>d</div>e") == ["a", "b", "c", "d", "e"]
    assert texts("<script>var a='</p><p>';</script><style>p{}</style><!-- x <p>y --><p>z") == ["z"]
    assert texts("<p title='a>b'>c</p><p class=\"x>y\">d</p><p broken='>e") == ["c", "d", "e"]
    assert texts("<title>t</title>a < b <3 </ p> & &am <x") == ["a < b <3 & &am <x"]
    assert texts("<script>never ends <p>a") == [] and texts("<textarea>a</textarea>b</nothing></p>c") == ["b", "c"]
    assert texts("<TABLE><TR><TD>a<TD>b<TR><TD>c</TABLE>") == ["a", "b", "c"]
    assert texts("<!DOCTYPE html><?php x ?>a\0b") == ["a\0b"]
    assert leaf_blocks("<nav class='Top-Menu'><a href=x>one two</a></nav>")[0].path == ("nav.top.menu",)


def test_only_raw_text_elements_are_silent():
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, and on</p>") == ["so x=2, and on"]
    assert texts("<p><svg><title>t</title><style>s</style><text>a</text></svg> b</p>") == ["a b"]
    for name in ("object", "audio", "video", "canvas"):
        assert texts(f"<p>a</p><{name} x=y>b</{name}><p>c</p>") == ["a", "b", "c"]
        assert texts(f"<p>a</p><{name} x=y><p>b<p>c") == ["a", "b", "c"]
        assert leaf_blocks(f"<p>a<{name}>b</{name}>c</p>")[1].path == ("p", name)
        assert leaf_blocks(f"<p>a<{name}>b</{name}>c</p>")[2].path == ("p",)
    for name in ("svg", "math"):
        assert texts(f"<p>a</p><{name}><p>b<p>c") == ["a", "b", "c"]
        assert leaf_blocks(f"<p>a<{name}>b</{name}></p><p>c</p>")[0].holds == (name,)
        assert leaf_blocks(f"<p>a<{name}>b</{name}></p><p>c</p>")[1].holds == ()


def test_articles_with_formulas_and_unclosed_elements(field):
    menu, end = "<nav><ul><li><a href=x>Home</a></li></ul></nav>", "<footer><p>© us</p></footer>"
    for tag in ("<object data=x>", "<video src=x>", "<svg>"):
        page = f"{menu}<article><h1>One</h1><p>A sentence of some words.</p>{tag}<p>And one more of them.</p></article>{end}"
        assert main_text(field, page) == "One A sentence of some words. And one more of them."
    page = f"{menu}<article><h1>One</h1><p>We know <math><mi>x</mi><mo>=</mo><mn>2</mn></math> of it.</p></article>{end}"
    assert main_text(field, page) == "One We know x=2 of it."


def expected(page):
    """Of the given pages, the article's blocks by another way."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
    return " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_given_pages(pages):
    got = extract(pages).collect()
    truth = {r.page_id: (r.url, expected(r.html)) for r in pages.collect()}
    assert len(got) == len(truth)
    for r in got:
        assert (r.url, r.text) == truth[r.page_id] and r.n_chars == len(r.text)


def test_held_out_layouts(pages, field):
    draw, right, total = random.Random(99), 0, 0
    for r in pages.collect():
        blocks = leaf_blocks(r.html)
        labels = labels_of(blocks)
        parts = [[b for b, y in zip(blocks, labels) if y == wanted] for wanted in (1, 0)]
        other = leaf_blocks(_layout(*parts, draw))
        truth = labels_of(other)
        right += sum(a == b for a, b in zip(field.decode(other), truth))
        total += len(truth)
    assert right / total > 0.97


def test_same_field_again(pages, field):
    again = fit(pages.repartition(3))
    assert again.weights == field.weights


def test_odd_rows(spark, field):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p>"), (2, "u", "<p>"), (3, "u", "<article><p>" + "word. " * 50000)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in extract(df, field).collect()), key=str)
    assert got == sorted([(1, "u", 0), (None, None, 0), (2, "u", 0), (2, "u", 0), (3, "u", 299_999)], key=str)
    assert extract(df.limit(0)).collect() == [] and extract(df.where("html is null")).count() == 1
    assert main_text(field, "<nav><a href=x>Home</a></nav>") == ""


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>a</p><script src=x/>code()</script><p>b</p>", ["a", "b"]),
        ("<style/>p{}</style><p>b</p>", ["b"]),
        ("<p>a</p><script>never closed", ["a"]),
        ("<p>a</p><script>x</script <p>", ["a"]),
        ("<p>a</p><!-- never closed <p>b</p>", ["a"]),
        ("<p>a</p><!-- never closed", ["a"]),
        ("<p>a <b and", ["a <b and"]),
    ],
)
def test_raw_text_and_unclosed_ends(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


@pytest.mark.parametrize("page", ["<a " * 350_000, "<script>" + "</script " * 120_000, "<!-" * 350_000])
def test_unclosed_tags_are_read_once(page):
    before = time.process_time()
    leaf_blocks(page)
    assert time.process_time() - before < 2
