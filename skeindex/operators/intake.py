"""Page intake: links, depth-limited reach, change detection, keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeindex.functions.urls import absolute, host, page_key, page_links
from skeindex.session import durable

# How far links are followed, and the stamp format of a scrape.
DEPTH_LIMIT = 2
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def extract_links(pages: DataFrame) -> DataFrame:
    """``(src_url, dst_url)`` for every link of ``pages(url, html)``, in absolute form."""
    found = pages.select(F.col("url").alias("src_url"), F.explode_outer(page_links(F.col("html"))))
    return found.where(F.col("col").isNotNull()).select(
        "src_url", absolute(F.col("col"), F.col("src_url")).alias("dst_url")
    )


def link_allowed(
    url: Column, allow: str | None = None, domains: tuple = (), deny: str | None = None
) -> Column:
    """Allow-pattern AND allowed domain (or a subdomain of it) AND NOT deny-pattern."""
    test = F.lit(True)
    if allow:
        test = test & url.rlike(allow)
    if domains:
        site = host(url)
        inside = F.lit(False)
        for domain in domains:
            inside = inside | (site == domain.lower()) | site.endswith("." + domain.lower())
        test = test & inside
    if deny:
        test = test & ~url.rlike(deny)
    return test


def filter_links(links: DataFrame, allow=None, domains=(), deny=None) -> DataFrame:
    return links.where(link_allowed(F.col("dst_url"), allow, domains, deny))


def link_depth(links: DataFrame, seeds: DataFrame, depth: int = DEPTH_LIMIT) -> DataFrame:
    """``(url, depth)`` of every URL within ``depth`` links of ``seeds(url)``, at its least depth.

    One join per level; each level is made durable, so that the plan of a level stays small.
    """
    edges = links.select("src_url", "dst_url")
    level = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    reached = level
    for step in range(1, depth + 1):
        frontier = level.select(F.col("url").alias("src_url"))
        found = edges.join(frontier, "src_url", "left_semi").select(F.col("dst_url").alias("url"))
        fresh = found.distinct().join(reached, "url", "left_anti")
        level = durable(fresh.withColumn("depth", F.lit(step)))
        reached = reached.unionByName(level)
    return reached


def crawl_frontier(links: DataFrame, pages: DataFrame) -> DataFrame:
    """``(url)`` discovered through links but not stored among ``pages(url)``."""
    found = links.select(F.col("dst_url").alias("url")).distinct()
    return found.join(pages.select("url"), "url", "left_anti")


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP_FORMAT)


def with_page_keys(pages: DataFrame, prefix: str, scrape_time: Column | None = None) -> DataFrame:
    """Raw ``pages(url, html)`` as page rows keyed by ``{prefix}/{page}.html``, with fingerprint."""
    moment = F.current_timestamp() if scrape_time is None else scrape_time
    known = {"url", "html"}
    return pages.select(
        F.concat(F.lit(prefix + "/"), page_key(F.col("url")), F.lit(".html")).alias("source_file"),
        "html",
        F.col("url").alias("original_url"),
        stamp(moment).alias("scrape_time"),
        F.md5("html").alias("fingerprint"),
        *[c for c in pages.columns if c not in known],
    )


def place(order: str, columns: list[str]) -> Column:
    """Sorts rows by ``order``, nulls first, and rows of equal order by a hash of ``columns``."""
    return F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("order"), F.xxhash64(*columns).alias("tie"))


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of every key. Rows without key are ignored.

    A null order counts as the smallest; among equal orders a hash of the row decides, so reruns agree. The aggregate
    keeps one row per key and task before the shuffle.
    """
    kept = df.where(F.col(key).isNotNull())
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in rest])
    found = kept.groupBy(key).agg(F.max_by(row, place(order, df.columns)).alias("__row"))
    return found.select(*[F.col(c) if c == key else F.col("__row").getField(c).alias(c) for c in df.columns])


def changed_pages(stored: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Incoming pages (last one per key) that are new or whose fingerprint differs.

    Which pages changed is decided on keys and fingerprints; only changed pages are then gathered with their text.
    """
    light = incoming.select("source_file", order, "fingerprint")
    latest = last_per_key(light, "source_file", order)
    known = stored.select("source_file", F.col("fingerprint").alias("__stored"))
    differs = F.col("__stored").isNull() | ~F.col("__stored").eqNullSafe(F.col("fingerprint"))
    changed = latest.join(known, "source_file", "left").where(differs).select("source_file")
    return last_per_key(incoming.join(changed, "source_file", "left_semi"), "source_file", order)


def upsert_rows(stored: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``stored`` with the rows of ``delta`` inserted or replaced by key; nothing is deleted."""
    untouched = stored.join(delta.select(key), key, "left_anti")
    return untouched.unionByName(delta)


def upsert_pages(stored: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """The page table after an intake: unchanged pages keep their row and their scrape time."""
    fresh = changed_pages(stored, incoming, order).select(*stored.columns)
    return upsert_rows(stored, fresh, "source_file")
