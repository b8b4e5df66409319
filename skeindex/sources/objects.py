"""Writing and listing objects, and scanning HTML pages, under a prefix."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skeindex.sources.commits import local_path

# Which objects are pages, and the part of a path before the object name.
PAGE_GLOB = "*.{html,htm}"
OBJECT_ROOT_PATTERN = "^[A-Za-z][^:/]*:(//[^/]*)?/"
# Objects in a folder, about: a scan lists the folders by tasks, and each folder has a cost of its own.
FOLDER_OBJECTS = 256


def check_scheme(uri: str, scheme: str | None) -> str:
    if scheme is not None and not uri.startswith(scheme + "://"):
        raise ValueError(f"URI {uri} must start with {scheme}://")
    return uri


def list_objects(spark: SparkSession, uri: str, scheme: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of every object under ``uri``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(check_scheme(uri, scheme)).select("path", "length", "modificationTime")


def write_objects(rows: DataFrame, uri: str, key: str, text: str) -> None:
    """Write one object for each value of ``key`` under ``uri``, which is new, with the value in its path as ``<key>=<value>``.

    An object holds the texts of its rows in order, each with a line end; a missing text is empty. On a local file system
    the tasks put the objects themselves: for each one, Spark's writer would start three processes that set modes. Every object
    is written under a hidden name and then moved, so a task that runs again leaves it whole.
    """
    spark = rows.sparkSession
    folders = rows.count() // FOLDER_OBJECTS + 1
    folder = F.pmod(F.xxhash64(key), F.lit(folders)).alias("folder")
    placed = rows.repartition(key).select(folder, key, F.coalesce(F.col(text), F.lit("")).alias("value"))
    root = local_path(spark, uri)
    if root is None:
        placed.sortWithinPartitions("folder", key, "value").write.partitionBy("folder", key).text(uri)
        return
    value = F.coalesce(F.url_encode(F.col(key).cast("string")), F.lit(""))
    name = F.concat(F.lit("folder="), F.col("folder"), F.lit(f"/{key}="), value, F.lit(".txt"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        texts = ((name.as_py(), text.as_buffer()) for batch in batches for name, text in zip(*batch.columns))
        for name, own in groupby(texts, itemgetter(0)):
            target = os.path.join(root, name)
            hidden = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with open(hidden, "wb") as out:
                for _, text in own:
                    out.write(text)
                    out.write(b"\n")
            os.replace(hidden, target)
            written += 1
        yield pa.record_batch({"written": [written]})

    named = placed.select(name.alias("name"), "value").sortWithinPartitions("name", "value")
    named.mapInArrow(put, "written long").agg(F.sum("written")).collect()


def scan_pages(
    spark: SparkSession, uri: str, metadata: DataFrame | None = None, scheme: str | None = None,
    glob: str = PAGE_GLOB,
) -> DataFrame:
    """Pages ``(source_file, html, original_url, scrape_time)`` under ``uri``.

    ``metadata(source_file, original_url, scrape_time)`` is the optional user metadata of the
    objects; where it is missing, both are empty strings.
    """
    text = spark.read.text(
        check_scheme(uri, scheme), wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True
    )
    path = F.regexp_replace(F.col("_metadata.file_path"), OBJECT_ROOT_PATTERN, "")
    # Reported paths are percent-encoded; a plus sign stands for itself in them.
    name = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    pages = text.select(name.alias("source_file"), F.col("value").alias("html"))
    if metadata is None:
        return pages.select("*", F.lit("").alias("original_url"), F.lit("").alias("scrape_time"))
    known = metadata.select("source_file", "original_url", "scrape_time")
    return pages.join(known, "source_file", "left").select(
        "source_file",
        "html",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("original_url", "scrape_time")],
    )


def read_if_present(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
