"""HTML as column expressions, in time that follows the length of a page: visible part, targets of links, references.

No pattern has a group whose repetition the engine could take back, so that neither the stack nor the time grows with the
number of attributes, and what is never closed reaches to the end of the page instead of being looked for again.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of a page without text or links.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
# An attribute with its value: quoted, or bare up to the next white space or bracket.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
ATTRIBUTE = rf"([^\s>/=][^\s=>/]*+)(?:\s*+=\s*+({VALUE})?+)?+"
# The attributes of an a or area tag, values passed over whole.
LINK_TAG = rf"(?i)<(?:a|area)(?=[\s/])((?:[\s/]++|=|{ATTRIBUTE})*+)"
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)"
# Characters of the numbers 128 to 159, which pages mean as windows-1252.
C1 = "€\u0081‚ƒ„…†‡ˆ‰Š‹Œ\u008dŽ\u008f\u0090‘’“”•–—˜™š›œ\u009džŸ"
NAMES = {n: c for n, c in html5.items() if n.endswith(";")}


def visible(html: Column) -> Column:
    """A page without comments, scripts and styles; one that is not closed ends the page."""
    return F.regexp_replace(html, HIDDEN, "")


def hrefs(shown: Column) -> Column:
    """The values of the first ``href`` of each ``a`` and ``area`` tag, in order, without quotes; tags without one left out."""
    tags = F.regexp_extract_all(shown, F.lit(LINK_TAG), F.lit(1))

    def target(tag: Column) -> Column:
        part = lambda i: F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(i))
        own = F.filter(F.arrays_zip(part(1).alias("name"), part(2).alias("value")), lambda x: (F.lower(x["name"]) == "href") & (x["value"] != ""))
        return F.get(own, F.lit(0)).getField("value")

    found = F.filter(F.transform(F.filter(tags, lambda t: t.rlike("(?i)href")), target), lambda x: x.isNotNull())
    return F.transform(found, lambda x: F.regexp_replace(x, r"(?s)^([\"'])(.*)\1$", "$2"))


def _character(digits: Column, base: int) -> Column:
    """The character of a number; what is no character becomes U+FFFD."""
    digits = F.regexp_replace(digits, "^0+", "")
    n = F.when(F.length(digits).between(1, 7), F.conv(digits, base, 10).cast("int"))
    n = F.when((n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF), n).otherwise(F.lit(0xFFFD))
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.when(n.between(128, 159), F.substring(F.lit(C1), n - 127, F.lit(1))).otherwise(wide)


def _replaced(part: Column, names: dict[str, str]) -> Column:
    """What stood behind an ampersand, with the reference that it begins with replaced."""
    ref = F.regexp_extract(part, REFERENCE, 1)
    number = F.regexp_extract(ref, "([0-9a-fA-F]+);?$", 1)
    named = F.from_json(F.lit(json.dumps(names)), "map<string,string>")
    char = (
        F.when(ref.rlike("^#[xX]"), _character(number, 16)).when(ref.startswith("#"), _character(number, 10))
        .when(ref != "", F.try_element_at(named, ref))
    )
    return F.coalesce(F.concat(char, F.substring(part, F.length(ref) + 1, F.length(part))), F.concat(F.lit("&"), part))


def decoded(text: Column, own: dict[str, str] | None = None) -> Column:
    """Character references replaced, each once: names as HTML has them, numbers in decimal and hexadecimal.

    ``own``: characters for some names (with their semicolon) in place of those of HTML.
    """
    parts = F.transform(F.split(text, "&"), lambda x, i: F.when(i == 0, x).otherwise(_replaced(x, NAMES | (own or {}))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)
