"""Vector expressions: norms, scores and hashed features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The distance measures an index may be created with, and its two norms.
DISTANCE_MEASURES = {
    "DOT_PRODUCT_DISTANCE": "dot",
    "COSINE_DISTANCE": "cosine",
    "L2_DISTANCE": "l2",
}
FEATURE_NORMS = ("UNIT_L2_NORM", "NONE")


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    squares = F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def unit(v: Column, length: Column) -> Column:
    """``v`` scaled to unit length; a zero vector stays as it is."""
    return F.when(
        length > 0, F.transform(v, lambda x: x.cast("double") / length)
    ).otherwise(F.transform(v, lambda x: x.cast("double")))
