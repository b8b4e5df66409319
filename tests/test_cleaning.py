"""Cleaning goldens, written from the rules."""

import pytest

from skeindex.functions.markup import CleaningRules, html_to_markdown
from skeindex.operators.cleaning import clean_pages, failed_pages

CASES = {
    "main content with inner wrapper": (
        '<p>out</p><div id="mw-content-text"><p>outer</p><div class="x mw-parser-output"><p>in</p></div></div>',
        "in",
    ),
    "main content without inner wrapper": (
        '<p>out</p><div id="mw-content-text"><p>outer</p></div>', "outer",
    ),
    "end tag inside a script string": ('<p>a<script>var t="</p>";</script>b</p>', "ab"),
    "bold that is never closed": ("<div><p><b>x<br>y</div><p>z</p>", "**x  \ny**\n\nz"),
    "nested element of a dropped class": (
        '<p>a</p><div class="noprint big"><div><p>gone</p></div></div><footer>kept</footer>', "a\n\nkept",
    ),
    "dropped id, first match only": (
        '<div id="siteSub">gone</div><div id="siteSub">kept</div>', "kept",
    ),
    "navigation table beside a factual one": (
        '<table class="vertical-navbox"><tr><td>nav</td></tr></table>'
        "<table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>2</td></tr></table>",
        "| k | v |\n| --- | --- |\n| 1 | 2 |",
    ),
    "section ends at the next h3": (
        "<p>a</p><h2>Trivia</h2><p>gone</p><h3>Next</h3><p>kept</p>", "a\n\n### Next\n\nkept",
    ),
    "section name is matched inside words": (
        "<h3>Cross-references</h3><p>gone</p><h2>B</h2><p>b</p>", "## B\n\nb",
    ),
    "heading in a wrapper removes only itself": (
        "<div><h2>References</h2></div><p>kept</p>", "kept",
    ),
    "link text stays, link goes": ('<p>see <a href="/x">this</a> now</p>', "see this now"),
    "lists": (
        "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><ol><li>d</li><li>e</li></ol>",
        "* a\n  + b\n* c\n\n1. d\n2. e",
    ),
    "text marks are escaped": ("<p>a_b *c*</p>", r"a\_b \*c\*"),
    "headings": ("<h1> A  b </h1><h4>c</h4>", "# A b\n\n#### c"),
    "entities": ("<p>&lt;x&gt; &amp; &copy;</p>", "<x> & ©"),
    "code": ("<pre>a\n  b</pre><p>run <code>x_y</code></p>", "```\na\n  b\n```\n\nrun `x_y`"),
}


@pytest.mark.parametrize("name", CASES)
def test_golden(name):
    html, expected = CASES[name]
    assert html_to_markdown(html) == expected


def test_rules_are_options():
    html = '<p class="toc">toc</p><h2>Trivia</h2><p>t</p>'
    keep = CleaningRules(classes=(), sections=())
    assert html_to_markdown(html, keep) == "toc\n\n## Trivia\n\nt"


def test_very_deep_page():
    depth = 20_000
    assert html_to_markdown("<div>" * depth + "deep" + "</div>" * depth) == "deep"


def test_failing_page_is_set_apart(spark):
    rows = [("a", "<p>x</p>"), ("b", None), ("c", "<p>y</p>")]
    cleaned = clean_pages(spark.createDataFrame(rows, "source_file string, html string"))
    found = {r["source_file"]: r["markdown"] for r in cleaned.collect()}
    assert found == {"a": "x", "b": None, "c": "y"}
    assert [r["source_file"] for r in failed_pages(cleaned).collect()] == ["b"]
