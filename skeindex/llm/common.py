"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeindex.session import fits_broadcast, shared_dir, ship_package

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: it is computed once and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int | Column = 64) -> DataFrame:
    """``df`` marked for broadcasting if its measured size is within the limit, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, row_bytes) else df


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; an id of null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, ... in the given order: a range-partitioned sort, then one offset per partition."""
    part, seq = "__part", "__seq"
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(rows.withColumns({part: F.spark_partition_id(), seq: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "numbered")
    return offset_by(rows, [F.col(part)], seq, name).drop(part, seq)


def offset_by(rows: DataFrame, order: list[Column], seq: str, name: str) -> DataFrame:
    """Add to ``seq`` (0, 1, ... within a group of equal ``order`` values) the rows of all groups before.

    The table of groups has one row per group; callers have at most a few groups per task.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    rows = rows.withColumns(dict(zip(keys, order)))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return rows.join(small(starts), keys).withColumn(name, F.col("__start") + F.col(seq)).drop(*keys, "__start")


def session_of(spark: SparkSession) -> SparkSession:
    """Send the package to the workers once, and have the shared folder ready."""
    ship_package(spark)
    shared_dir(spark)
    return spark
