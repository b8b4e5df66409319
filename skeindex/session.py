"""Session helpers: settings, durable intermediate results, size-checked broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side (in bytes) that operators may broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "skeindex", cores: str = "*") -> SparkSession:
    """A local session with the settings used by the tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without the setting; it gets a folder under the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/skeindex-{uuid.uuid4().hex}"
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so later stages survive executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back with its columns prunable.

    For results that several branches of one query use: each branch reads only what it needs. Zstandard makes lists of
    terms, vectors and texts smaller than the default codec does.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give data from few files one partition per core before text is expanded; no job is run to find out.

    Data from at least as many files as there are cores is returned unchanged, so large inputs are not shuffled.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= wanted:
        return df
    return df.repartition(wanted, *keys)


def fits_broadcast(df: DataFrame, row_bytes, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (``row_bytes`` is a column or a constant) against the broadcast limit."""
    size = row_bytes if not isinstance(row_bytes, (int, float)) else F.lit(int(row_bytes))
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total")).first()["total"]
    return total <= limit


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever the driver runs."""
    context = spark.sparkContext
    if getattr(context, "_skeindex_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="skeindex-"), "skeindex")
    archive = shutil.make_archive(
        target, "zip", root_dir=os.path.dirname(package), base_dir="skeindex"
    )
    context.addPyFile(archive)
    context._skeindex_shipped = True
