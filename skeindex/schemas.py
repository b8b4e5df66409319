"""Explicit schemas of the datasets that cross a file boundary."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

CHUNK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("original_url", T.StringType()),
        T.StructField("scrape_time", T.StringType()),
        T.StructField("headers", STRINGS),
        T.StructField("chunk", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("chunking_strategy_version", T.StringType()),
        T.StructField("chunk_gcs_uri", T.StringType()),
        T.StructField("chunk_line_offset", T.LongType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("original_url", T.StringType()),
        T.StructField("scrape_time", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)

ARTIFACT = T.StructType(
    [
        T.StructField("display_name", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("state", T.StringType()),
    ]
)

INDEX = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("dims", T.IntegerType()),
        T.StructField("metric", T.StringType()),
        T.StructField("norm", T.StringType()),
        T.StructField("leaf_size", T.IntegerType()),
        T.StructField("probe_pct", T.IntegerType()),
        T.StructField("approximate_neighbors", T.IntegerType()),
    ]
)

# A reply of a search service: only the parts that queries use.
NEIGHBOR_REPLY = """
struct<nearestNeighbors: array<struct<
  id: string,
  neighbors: array<struct<
    distance: double,
    sparse_distance: double,
    datapoint: struct<
      datapointId: string,
      embeddingMetadata: struct<chunk_gcs_uri: string, chunk_line_offset: bigint>>>>>>>
"""
