"""URL expressions: links in a page, absolute form, host, page key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeindex.functions.html import decoded, hrefs, visible

# The parts of an absolute URL.
SCHEME_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*):"
SITE_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def page_links(html: Column) -> Column:
    """Targets of the links of a page, in order: hrefs of ``a`` and ``area``, in any case and quotes, references decoded.

    Scripts, styles and comments hold no links. Fragments alone and schemes other than http(s) are left out.
    """
    links = F.transform(hrefs(visible(html)), lambda x: F.trim(decoded(x)))
    other = lambda x: x.rlike(SCHEME_PATTERN) & ~x.rlike("(?i)^https?:")
    return F.filter(links, lambda x: (x != "") & ~x.startswith("#") & ~other(x))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_PATTERN, 1))


def _without_dots(path: Column) -> Column:
    """Path with ``.`` and ``..`` segments resolved."""
    step = lambda kept, part: (
        F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part)))
    )
    parts = F.split(path, "/")
    ends_open = F.element_at(parts, -1).isin(".", "..")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step
    )
    joined = F.array_join(F.when(ends_open, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), joined).otherwise(path)


def absolute(link: Column, base: Column) -> Column:
    """``link`` found on page ``base`` as an absolute URL (without fragment)."""
    trimmed = F.regexp_replace(F.trim(link), "#.*$", "")
    site = F.regexp_extract(base, SITE_PATTERN, 1)
    path = F.regexp_extract(base, PATH_PATTERN, 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    query = F.regexp_extract(trimmed, r"(\?.*)$", 1)
    target = F.regexp_replace(trimmed, r"\?.*$", "")
    return (
        F.when(trimmed.rlike(SCHEME_PATTERN), trimmed)
        .when(
            trimmed.startswith("//"),
            F.concat(F.regexp_extract(base, SCHEME_PATTERN, 1), F.lit(":"), trimmed),
        )
        .when(trimmed.startswith("/"), F.concat(site, _without_dots(target), query))
        .when(trimmed.startswith("?"), F.concat(site, path, trimmed))
        .when(trimmed == "", F.regexp_replace(base, "#.*$", ""))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, target)), query))
    )


def page_key(url: Column) -> Column:
    """Last segment of a URL without its query."""
    return F.split_part(F.element_at(F.split(url, "/"), -1), F.lit("?"), F.lit(1))
