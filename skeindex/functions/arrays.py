"""Row-local array algebra: counting the values of a sorted array without a shuffle.

Every step names its input in a projection of its own and refers to it more than once, so the
optimizer keeps it as a computed value. The result leaves through a one-row generator, which later
filters cannot be pushed beneath: without it a filter on the counts would recompute them per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_starts(sorted_array: Column) -> Column:
    """First position of every run of equal values in a sorted array, as ``(at, key)``."""
    return F.filter(
        F.transform(sorted_array, lambda x, i: F.struct(i.alias("at"), x.alias("key"))),
        lambda s: (s["at"] == 0) | (F.get(sorted_array, s["at"] - 1) != s["key"]),
    )


def with_counts(df: DataFrame, sorted_column: str, out: str, total: str) -> DataFrame:
    """Replace a sorted array by its runs ``out array<struct<term_id, tf>>`` and its ``total``."""
    kept = [F.col(c) for c in df.columns if c != sorted_column]
    starts = df.select(
        *kept,
        run_starts(F.col(sorted_column)).alias("__starts"),
        F.size(sorted_column).cast("long").alias("__n"),
    )
    runs = F.transform(
        F.col("__starts"),
        lambda s, i: F.struct(
            s["key"].alias("term_id"),
            (F.coalesce(F.get(F.col("__starts"), i + 1)["at"], F.col("__n")) - s["at"]).alias("tf"),
        ),
    )
    row = F.struct(runs.alias(out), F.col("__n").alias(total))
    return starts.select(*kept, F.inline(F.array(row)))
