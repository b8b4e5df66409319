"""Links and references against a parser in plain Python, and pages made to be slow or to overflow a stack."""

import html
import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skeindex.functions.html import decoded, hrefs, visible
from skeindex.functions.urls import page_links


class Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "area"):
            self.found += [v for n, v in attrs if n == "href" and v is not None][:1]

    handle_startendtag = handle_starttag


def parsed(page):
    parser = Links()
    parser.feed(page)
    return parser.found


FORMS = [
    """<a title="see href='bad' now" href="good">""", "<a href=x>", "<A HREF = 'y'>", "<a\nclass=b\thref=\"z\" id=q>", "<a data-href=p href=q>", "<a name=n>",
    "<a href='/o&#49;&eacute;&amp;' />", '<area shape=rect href="/m">', "<a title='a > b' href=/gt>", "<a href=/first href=/second>", "<abbr href=no>", "<p>text = 1</p>",
    "<a/href=slash>", '<a title=it\'s href="/i">',
]


def test_forms_of_links(spark):
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(FORMS)] + [(99, " ".join(FORMS))], "i int, page string")
    got = {r["i"]: r["l"] for r in rows.select("i", F.transform(hrefs(visible(F.col("page"))), lambda x: decoded(x)).alias("l")).collect()}
    for i, form in enumerate(FORMS):
        assert got[i] == parsed(form), form
    assert got[99] == parsed(" ".join(FORMS))
    assert got[6] == ["/o1é&"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(FORMS + ["&lt;a href=no&gt;", "plain", "\n"]), max_size=6).map("".join), min_size=20, max_size=20))
def test_pages_of_forms(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, page string").coalesce(1)
    got = rows.select("i", F.transform(hrefs(visible(F.col("page"))), lambda x: decoded(x)).alias("l")).collect()
    assert [r["l"] for r in sorted(got)] == [parsed(p) for p in pages]


def test_references_as_python_has_them(spark):
    texts = ["&#49;", "&eacute;", "&#x27;", "&amp;amp;", "&bogus;", "a & b", "&", "&#;", "&#128512;", "&#146;", "&lt;&gt;&quot;&apos;", "&NotEqualTilde;", "&#xD800;", "&#0;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decoded(F.col("t")).alias("d")).collect()
    assert {r["t"]: r["d"] for r in rows} == {t: html.unescape(t) for t in texts}


HOSTILE = {
    "attributes": "<a " + " ".join(f"a{i}='{i}'" for i in range(50_000)) + " href=/end>x</a>",
    "long tag": "<a title='" + "x" * 10_000_000 + "' href=/end>",
    "unclosed quote": "<a href=/end>" + "<a title='" * 20_000,
    "brackets": "<a href=/end>" + "<" * 1_000_000,
    "open comments": "<a href=/end>" + "<!--" * 200_000,
    "open scripts": "<a href=/end>" + "<script>" * 100_000 + "var a = '<a href=no>'",
    "open tags": "<a href=/end>" + "<a " * 200_000,
    "equals": "<a " + "=" * 200_000 + " href=/end>",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages(spark, name):
    start = time.time()
    rows = spark.createDataFrame([(HOSTILE[name],)], "page string")
    assert rows.select(page_links(F.col("page")).alias("l")).first()["l"] == ["/end"]
    assert time.time() - start < 30
