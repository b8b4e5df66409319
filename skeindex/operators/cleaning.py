"""Cleaning job: page HTML to Markdown, one Arrow pass, failures kept apart."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.functions.batches import by_pieces
from skeindex.functions.markup import CleaningRules, html_to_markdown

# Fixed value: script and style blocks as they stand in HTML.
SCRIPT_STYLE_PATTERN = r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>"


def strip_script_style(html: Column) -> Column:
    """Page text without script and style blocks, as a plain expression."""
    return F.regexp_replace(html, SCRIPT_STYLE_PATTERN, "")


def clean_pages(pages: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Replace ``html`` by ``markdown`` and ``error``; a failing page has no markdown, only an error.

    Only the ``html`` column travels to Python; about a megabyte of it is worked on at a time.
    """
    schema = T.StructType(
        [T.StructField("markdown", T.StringType()), T.StructField("error", T.StringType())]
    )

    def one(html):
        try:
            return (None, "no content") if html is None else (html_to_markdown(html, rules), None)
        except Exception as error:  # the page yields no chunks and is reported
            return None, f"{type(error).__name__}: {error}"

    def some(htmls: pa.Array) -> pa.Array:
        found = [one(html) for html in htmls.to_pylist()]
        columns = [pa.array([x[i] for x in found], pa.string()) for i in range(2)]
        return pa.StructArray.from_arrays(columns, names=schema.names)

    # Non-deterministic only in name: filters on the result must not run the cleaning twice.
    convert = F.arrow_udf(by_pieces(some), schema).asNondeterministic()
    kept = [c for c in pages.columns if c != "html"]
    cleaned = pages.select(*kept, convert(F.col("html")).alias("__c"))
    return cleaned.select(*kept, F.col("__c.markdown"), F.col("__c.error"))


def failed_pages(cleaned: DataFrame) -> DataFrame:
    """Quarantine rows of the cleaning job."""
    return cleaned.where(F.col("error").isNotNull()).select("source_file", "error")
