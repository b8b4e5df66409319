"""Links, reach, page keys, change detection."""

import pytest
from pyspark.sql import functions as F

from skeindex.functions.urls import absolute, host, page_key
from skeindex.operators import intake
from skeindex.plans import flows
from skeindex.sources.keyed import KeyedTable

BASE = "https://w.example.org/wiki/Deep/Page?x=1#y"


@pytest.mark.parametrize(
    "link, expected",
    [
        ("/a/b", "https://w.example.org/a/b"),
        ("c", "https://w.example.org/wiki/Deep/c"),
        ("../c?q=1", "https://w.example.org/wiki/c?q=1"),
        ("./", "https://w.example.org/wiki/Deep/"),
        ("/a/../../b/.", "https://w.example.org/b/"),
        ("//other.example.org/x", "https://other.example.org/x"),
        ("http://z.example.org/", "http://z.example.org/"),
        ("?q=2", "https://w.example.org/wiki/Deep/Page?q=2"),
        ("mailto:a@b.example", "mailto:a@b.example"),
    ],
)
def test_absolute_links(spark, link, expected):
    row = spark.range(1).select(absolute(F.lit(link), F.lit(BASE)).alias("u")).first()
    assert row["u"] == expected


def test_host_and_page_key(spark):
    row = spark.range(1).select(
        host(F.lit("https://u@W.Example.org:80/x")).alias("h"), page_key(F.lit(BASE)).alias("k")
    ).first()
    assert (row["h"], row["k"]) == ("w.example.org", "Page")


def test_link_predicate(spark):
    urls = [
        "https://w.example.org/wiki/A_(Kind)", "https://sub.w.example.org/wiki/B_(Kind)",
        "https://badw.example.org/wiki/C_(Kind)", "https://w.example.org/wiki/Talk:D_(Kind)",
        "https://w.example.org/wiki/E",
    ]
    links = spark.createDataFrame([(u,) for u in urls], "dst_url string")
    kept = intake.filter_links(links, r"wiki/.*_\(Kind\)", ("w.example.org",), r"wiki/.*:.*")
    assert sorted(r["dst_url"] for r in kept.collect()) == sorted(urls[:2])


def test_reach_takes_the_least_depth(spark):
    edges = [("s", "a"), ("s", "b"), ("a", "b"), ("b", "c"), ("c", "d"), ("c", "s"), ("a", "a")]
    links = spark.createDataFrame(edges, "src_url string, dst_url string")
    seeds = spark.createDataFrame([("s",)], "url string")
    found = {r["url"]: r["depth"] for r in intake.link_depth(links, seeds, 2).collect()}
    assert found == {"s": 0, "a": 1, "b": 1, "c": 2}


RAW = "url string, html string, n int"


def test_change_detection_and_upsert(spark, scratch):
    store = KeyedTable(scratch + "/pages", "source_file", 4)
    first = [("https://e.example/x/A?v=1", "old", 1), ("https://e.example/y/A", "new", 2), ("https://e.example/B", "b", 3)]
    day = lambda d: F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp")
    fresh = flows.intake_pages(spark.createDataFrame(first, RAW), store, "p", "n", day(1))
    assert sorted(r["source_file"] for r in fresh.collect()) == ["p/A.html", "p/B.html"]
    again = [("https://e.example/y/A", "new", 1), ("https://e.example/B", "b2", 2), ("https://e.example/C", "c", 3)]
    fresh = flows.intake_pages(spark.createDataFrame(again, RAW), store, "p", "n", day(2))
    assert sorted(r["source_file"] for r in fresh.collect()) == ["p/B.html", "p/C.html"]
    stored = {r["source_file"]: (r["html"], r["scrape_time"][:10]) for r in store.read(spark).collect()}
    assert stored == {
        "p/A.html": ("new", "2024-01-01"),
        "p/B.html": ("b2", "2024-01-02"),
        "p/C.html": ("c", "2024-01-02"),
    }


def test_last_row_without_and_with_equal_orders(spark):
    rows = [("k", None, "a"), ("k", 1, "b"), ("k", None, "c"), ("n", None, "d"), ("n", None, "e"), (None, 5, "f"), ("t", 2, "g"), ("t", 2, "h")]
    df = spark.createDataFrame(rows, "id string, seq int, v string")
    found = [{r["id"]: r["v"] for r in intake.last_per_key(df.repartition(n), "id", "seq").collect()} for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2]
    assert found[0]["k"] == "b" and found[0]["n"] in "de" and found[0]["t"] in "gh" and len(found[0]) == 3


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<A HREF='c'>x</A>", ["c"]),
        ('<a class="z" href="/d?a=1&amp;b=2">x</a><area href=/e>', ["/d?a=1&b=2", "/e"]),
        ('<link href="s.css"><a href="mailto:a@b">m</a><a href="#top">t</a><a href="javascript:x()">j</a>', []),
        ("<script>var a = '<a href=\"no\">';</script><!-- <a href='no'> --><a href='HTTP://x/y'>y</a>", ["HTTP://x/y"]),
        ("<a\nhref = \"f\">f</a><a name='href'>n</a><abbr href='q'>", ["f"]),
        (None, None),
    ],
)
def test_links_of_a_page(spark, html, expected):
    from skeindex.functions.urls import page_links

    row = spark.createDataFrame([(html,)], "html string").select(page_links(F.col("html")).alias("l")).first()
    assert row["l"] == expected
