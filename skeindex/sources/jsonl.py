"""JSONL datasets: tolerant and strict readers, chunk and datapoint writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.operators.context import offset_block
from skeindex.schemas import CHUNK
from skeindex.session import stage
from skeindex.sources.rejects import BROKEN_LINE, RejectLog

CORRUPT = "_corrupt"
JSONL_GLOB = "*.jsonl"


def _reader(spark: SparkSession, schema: T.StructType | None, glob: str):
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader if schema is None else reader.schema(schema)


def read_tolerant(
    spark: SparkSession, path: str, schema: T.StructType = CHUNK, glob: str = JSONL_GLOB
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: parsed records with their ``file_path``, and the lines that are not JSON."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    good = (
        _reader(spark, with_corrupt, glob)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("file_path", F.col("_metadata.file_path"))
        .where(F.col(CORRUPT).isNull())
        .drop(CORRUPT)
    )
    lines = _reader(spark, None, glob).text(path)
    parsed = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    bad = lines.where((F.trim("value") != "") & parsed[CORRUPT].isNotNull())
    return good, bad.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))


def read_reporting(
    spark: SparkSession, path: str, rejects: RejectLog, schema: T.StructType = CHUNK, glob: str = JSONL_GLOB
) -> DataFrame:
    """Parsed records with their ``file_path``; lines that are not JSON become rejects. Files are read once."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = _reader(spark, None, glob).text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    rows = stage(lines.select(parsed.alias("r"), F.col("_metadata.file_path").alias("file_path")), "lines")
    broken = F.col(f"r.{CORRUPT}")
    rejects.write(rows.where(broken.isNotNull()), BROKEN_LINE, F.col("file_path"), broken)
    return rows.where(broken.isNull()).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], "file_path")


def read_strict(
    spark: SparkSession, path: str, schema: T.StructType | None = CHUNK, glob: str = JSONL_GLOB
) -> DataFrame:
    """Records of a dataset that must be clean; without ``schema`` unknown keys become columns."""
    return _reader(spark, schema, glob).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; null fields are left out. Read back with ``glob="*.json"``."""
    df.write.mode(mode).json(path)


def datapoint_path(path: str) -> str:
    """Where datapoints go: the given file name, or ``batch.json`` in the given folder."""
    return path if path.endswith((".json", ".jsonl")) else path.rstrip("/") + "/batch.json"


def write_datapoints(datapoints: DataFrame, path: str) -> str:
    target = datapoint_path(path)
    datapoints.write.mode("overwrite").json(target)
    return target


def write_chunk_store(chunks: DataFrame, path: str) -> None:
    """Chunk table partitioned by offset block, so that a lookup by pointer reads few files."""
    blocked = chunks.withColumn("offset_block", offset_block(F.col("chunk_line_offset")))
    spread = blocked.hint("rebalance", "offset_block")
    spread.write.mode("overwrite").partitionBy("offset_block").parquet(path)


def read_chunk_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The chunk table at ``path``; ``schema`` is that of its rows, so that a table without rows can be read too."""
    return spark.read.schema(T.StructType(schema.fields).add("offset_block", T.LongType())).parquet(path)
