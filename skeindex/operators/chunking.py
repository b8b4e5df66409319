"""Chunking job: header sections, overlapping chunks, records, dataset-wide line offsets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from skeindex.functions.batches import by_pieces
from skeindex.functions.splitting import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    header_sections as sections_of,
    split_text,
)
from skeindex.session import durable

# Fixed value: default version of the chunking strategy.
DEFAULT_VERSION = "v1"

_STRINGS = T.ArrayType(T.StringType())


def _per_text(make, name: str):
    """An Arrow function from one text to an array of ``struct<headers, name>``; a missing text gives none."""
    schema = T.StructType([T.StructField("headers", _STRINGS), T.StructField(name, T.StringType())])
    kind = pa.list_(pa.struct([("headers", pa.list_(pa.string())), (name, pa.string())]))

    def some(texts: pa.Array) -> pa.Array:
        return pa.array([[] if text is None else make(text) for text in texts.to_pylist()], kind)

    return F.arrow_udf(by_pieces(some), T.ArrayType(schema)).asNondeterministic()


def header_sections(df: DataFrame, text: str = "markdown") -> DataFrame:
    """One row per section: ``(…, section, h1, h2, h3, text)``."""

    def make(value):
        return [{"headers": h, "text": t} for h, t in sections_of(value)]

    kept = [c for c in df.columns if c != text]
    listed = df.select(*kept, _per_text(make, "text")(F.col(text)).alias("__s"))
    rows = listed.select(*kept, F.posexplode("__s").alias("section", "__x"))
    path = [F.get("__x.headers", F.lit(i)).alias(f"h{i + 1}") for i in range(3)]
    return rows.select(*kept, "section", *path, F.col("__x.text").alias("text"))


def chunk_text(
    df: DataFrame, text: str = "markdown", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, empty: bool = False
) -> DataFrame:
    """One row per chunk: ``(…, i, headers, chunk)``; ``i`` counts over the whole text.

    With ``empty``, a text without chunks is a row without ``i``, ``headers`` and ``chunk``. Sections and windows come from one Arrow pass; a chunk never crosses a section.
    """

    def make(value):
        return [
            {"headers": [h for h in headers if h is not None], "chunk": chunk}
            for headers, section in sections_of(value)
            for chunk in split_text(section, size, overlap)
        ]

    kept = [c for c in df.columns if c != text]
    listed = df.select(*kept, _per_text(make, "chunk")(F.col(text)).alias("__c"))
    spread = F.posexplode_outer if empty else F.posexplode
    rows = listed.select(*kept, spread("__c").alias("i", "__x"))
    return rows.select(*kept, F.col("i").cast("long").alias("i"), F.col("__x.headers"), F.col("__x.chunk"))


def chunk_records(cleaned: DataFrame, version: str = DEFAULT_VERSION, empty: bool = False, **split) -> DataFrame:
    """Chunk records (without dataset pointer) of ``cleaned(source_file, original_url, scrape_time, markdown)``.

    With ``empty``, a page without chunks is a row without ``chunk``, and all rows have the ``error`` of their page.
    """
    error = ["error"] if empty else []
    rows = chunk_text(
        cleaned.select("source_file", "original_url", "scrape_time", "markdown", *error), empty=empty, **split
    )
    return rows.select(
        *error,
        F.concat("source_file", F.lit("_chunk_"), F.col("i").cast("string")).alias("id"),
        "original_url",
        "scrape_time",
        "headers",
        "chunk",
        "source_file",
        F.lit(version).alias("chunking_strategy_version"),
        "i",
    )


def running_offsets(df: DataFrame, order: list[str], weight: Column, out: str = "base") -> DataFrame:
    """Add the sum of ``weight`` over all rows that sort before this one.

    Rows are range-partitioned by ``order`` and made durable with their partition number. Sums per
    partition (one row each) give the start of every partition; inside it a window does the rest.
    No task ever holds more than its own range.
    """
    ranged = df.withColumn("__w", weight.cast("long")).repartitionByRange(*order)
    placed = durable(ranged.withColumn("__part", F.spark_partition_id()))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__part")
        .agg(F.sum("__w").alias("__s"))
        .select("__part", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__start"))
    )
    earlier = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__w").over(earlier), F.lit(0))
    # One row per range partition: bounded by the number of shuffle partitions.
    joined = placed.join(F.broadcast(starts), "__part")
    return joined.withColumn(out, F.col("__start") + inside).drop("__part", "__w", "__start")


def with_line_offsets(records: DataFrame, uri: str, file: str = "source_file", i: str = "i") -> DataFrame:
    """Add the dataset pointer ``(chunk_gcs_uri, chunk_line_offset)``: files in name order, then ``i``.

    Only one small row per file takes part in the global numbering.
    """
    counts = records.groupBy(file).agg(F.count("*").alias("__n"))
    bases = running_offsets(counts, [file], F.col("__n"), "__base").select(file, "__base")
    return (
        records.join(bases, file)
        .withColumn("chunk_gcs_uri", F.lit(uri))
        .withColumn("chunk_line_offset", F.col("__base") + F.col(i))
        .drop("__base", i)
    )


def reuse_chunks(previous: DataFrame, uri: str, file: str = "file_path") -> DataFrame:
    """Earlier chunks under a new dataset pointer: renumbered from 0 in file and old-offset order."""
    order = [file, "chunk_line_offset", "id"]
    numbered = running_offsets(previous, order, F.lit(1), "__new")
    return (
        numbered.withColumn("chunk_gcs_uri", F.lit(uri))
        .withColumn("chunk_line_offset", F.col("__new"))
        .drop("__new", file)
    )


def counted(df: DataFrame, name: str, column: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with a counter of rows, or of values of a column, that is read after the next action, at no extra pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1) if column is None else F.col(column)).alias("rows")), observation
