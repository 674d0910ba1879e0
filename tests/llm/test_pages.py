import html
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronolode.llm import pages
from chronolode.llm.queries import op3_main_text

SF = "/root/testdata/sf0.01"


def everything(source):
    page = pages.parse(source)
    return pages.blocks(page, np.ones(len(page.tag), bool))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", []),
        ("plain &amp; simple &lt;b&gt; &#233;&nbsp;x", ["plain & simple <b> é x"]),
        ("<p>one<p>two <b>bold<br>next</b> end", ["one", "two bold next end"]),
        ("<P CLASS='a>b'>x</P >y<!-- <p>no</p> -->z", ["x", "yz"]),
        ("<script>if (a<b) '<p>no</p>'</script>yes<style>p{}</style>", ["yes"]),
        ("<head><title>no</title></head><body>yes", ["yes"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<div>a</span></b></p>b</div>c", ["ab", "c"]),
        ("<div><b>a<p>b</b>c</p></div>", ["a", "bc"]),
        ("a < b and <", ["a < b and <"]),
        ("<a href=x\"y>link</a> text <img alt='no'> <unknown-one>in</unknown-one>", ["link text", "in"]),
        ("<div title=\"a > b\" data-x='<p>'>ok</div>", ["ok"]),
        ("<script>never closed <p>x", []),
        ("<p>cut off <a href=\"", ["cut off"]),
        ("x\n\t y  z", ["x y z"]),
    ],
)
def test_parsing(source, want):
    assert everything(source) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/=\"' ap!-&;divbscript\n", max_size=60))
def test_anything_parses(source):
    page = pages.parse(source)
    assert len(pages.features(page)) == len(page.tag)
    assert all(p < i for i, p in enumerate(page.parent))


def test_deep_and_long_pages():
    assert everything("<div>" * 30_000 + "x" + "</div>" * 30_000) == ["x"]
    assert len(everything("<p>y</i></section>" * 30_000)) == 30_000
    page = pages.parse("<b>" * 3000 + "<div class='ad'>" * 3000)
    assert len(pages.decode(page.parent, np.zeros(len(page.tag)))) == len(page.tag)


@pytest.mark.parametrize("seed", range(20))
def test_decoding_is_the_best_labelling(seed):
    rng = np.random.default_rng(seed)
    parent = [-1, *(int(rng.integers(0, i)) for i in range(1, 9))]
    odds = rng.normal(size=9) * 3
    best, found = -np.inf, None
    for bits in range(256):
        keep = np.array([True, *(bool(bits >> i & 1) for i in range(8))])
        if all(keep[p] or not keep[i] for i, p in enumerate(parent) if i):
            value = -np.logaddexp(0, np.where(keep, -odds, odds))[1:].sum()
            if value > best:
                best, found = value, keep
    assert (pages.decode(parent, odds) == found).all()


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 6))
    labels = ((rows[:, 1] > 0) ^ (rows[:, 4] > 0.3)).astype(float)
    trees = pages.boost(rows[:2000], labels[:2000], np.ones(2000))
    assert ((trees.log_odds(rows[2000:]) > 0) == labels[2000:]).mean() > 0.95


@pytest.fixture(scope="module")
def sources(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def trees(sources):
    return pages.fit(sources[:60], layouts=300)


def article(source):
    """Blocks of the article of a given page, by its known form."""
    body = re.search(r"(?s)<article>(.*?)(?:</article>|<footer>|\Z)", source)[1].replace("<br>", " ")
    found = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|li|div|ul)[^>]*>", body))
    return "\n\n".join(x for x in found if x)


def test_given_pages(sources, trees):
    out = pages.extract(sources[60:], trees)
    assert sum(a == article(s) for a, s in zip(out, sources[60:])) >= 0.98 * len(out)


def test_pages_of_other_structure(sources, trees):
    rng = random.Random(123)
    texts = [b for s in sources[200:] for b in everything(s) if len(b) > 20]
    exact, n = 0, 100
    for _ in range(n):
        marked = pages.layout(rng, rng.sample(texts, 40))
        page = pages.parse(marked)
        inside = np.zeros(len(page.tag), bool)
        for i in range(1, len(page.tag)):
            inside[i] = page.truth[i] == "1" if page.truth[i] is not None else inside[page.parent[i]]
        exact += pages.extract([re.sub(r' data-truth="\d"', "", marked)], trees)[0] == "\n\n".join(pages.blocks(page, inside))
    assert exact >= 0.9 * n


def test_rows(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some text that is long enough.</p></article>"), (4, "u", "<nav><a href=x>menu</a></nav>"), (4, "u", "<nav><a href=x>menu</a></nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' AS main_text", "1 AS page_source", "map('a', 1) AS tags")
    out = pages.main_text(df, trees)
    assert sorted((str(r.page_id), r.main_text) for r in out.collect()) == [("1", ""), ("2", ""), ("4", ""), ("4", ""), ("None", "Some text that is long enough.")]
    assert out.columns == ["page_id", "url", "html", "page_source", "tags", "main_text"]
    assert pages.main_text(df.where("page_id > 9"), trees).collect() == []


def test_query(spark, sources):
    rows = op3_main_text(spark, SF).orderBy("page_id").collect()
    assert len(rows) == len(sources)
    assert sum(r.text == article(s) for r, s in zip(rows, sources)) >= 0.98 * len(rows)
    assert all(r.n_chars == len(r.text) for r in rows)
