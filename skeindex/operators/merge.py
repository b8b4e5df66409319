"""Merging chunks with their vectors into datapoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeindex.operators.intake import last_per_key

# Chunk columns that are not metadata.
NOT_METADATA = ("id", "embedding", "sparse_embedding", "restricts", "numeric_restricts", "chunk")


def dedupe_last(vectors: DataFrame, order: str) -> DataFrame:
    """The last vector row of every id; rows without an id are ignored."""
    return last_per_key(vectors.where(F.col("id").cast("string") != ""), "id", order).drop(order)


def rename_dimensions(sparse: DataFrame) -> DataFrame:
    """Sparse vectors with ``dimensions`` in place of ``indices``."""
    names = sparse.schema["sparse_embedding"].dataType.fieldNames()
    ids = "dimensions" if "dimensions" in names else "indices"
    vector = F.struct(
        F.col("sparse_embedding.values").alias("values"),
        F.col(f"sparse_embedding.{ids}").alias("dimensions"),
    )
    kept = F.when(F.col("sparse_embedding").isNotNull(), vector)
    return sparse.withColumn("sparse_embedding", kept)


def has_sparse(df: DataFrame) -> DataFrame:
    """Rows with at least one sparse value; the others may not enter an index."""
    return df.where(F.size("sparse_embedding.values") > 0)


def as_datapoints(df: DataFrame) -> DataFrame:
    """Rows with chunk columns and both vectors, shaped as datapoints."""
    metadata = [F.col(c) for c in df.columns if c not in NOT_METADATA]
    nothing = F.lit(None).cast("array<string>")
    empty = F.coalesce(nothing, F.array().cast("array<string>"))
    return df.select(
        "id",
        empty.alias("restricts"),
        empty.alias("numeric_restricts"),
        F.struct(*metadata).alias("embedding_metadata"),
        "sparse_embedding",
        "embedding",
    )


def merge_embeddings(
    chunks: DataFrame, sparse: DataFrame, dense: DataFrame, order: str = "seq"
) -> DataFrame:
    """Datapoints of ``chunks`` with the last sparse and dense vector of their id.

    Every chunk row gives a row, unless it has no sparse values; the dense vector may be missing.
    The chunk text does not take part in the shuffle.
    """
    light = chunks.select(*[c for c in chunks.columns if c not in NOT_METADATA or c == "id"])
    left = has_sparse(rename_dimensions(dedupe_last(sparse.select("id", "sparse_embedding", order), order)))
    right = dedupe_last(dense.select("id", "embedding", order), order)
    return as_datapoints(light.join(left, "id").join(right, "id", "left"))

