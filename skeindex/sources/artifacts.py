"""Artifact registry: named, versioned results and how the newest or live one is found."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeindex.schemas import ARTIFACT
from skeindex.sources.objects import read_if_present

log = logging.getLogger(__name__)

# State of an artifact in use, and the default name of a fitted model.
LIVE = "LIVE"
MODEL_NAME = "bm25_index"


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_present(spark, root, ARTIFACT)
    return spark.createDataFrame([], ARTIFACT) if found is None else found


def register_artifact(
    spark: SparkSession, root: str, name: str, uri: str, when: datetime | None = None, state: str = LIVE
) -> None:
    moment = when or datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(name, uri, moment, state)], ARTIFACT)
    row.coalesce(1).write.mode("append").parquet(root)


def latest_artifacts(artifacts: DataFrame) -> DataFrame:
    """``(display_name, uri, create_time)``: the newest artifact of every name; ties by uri."""
    newest = F.max(F.struct("create_time", "uri"))
    rows = artifacts.groupBy("display_name").agg(newest.alias("n"))
    return rows.select("display_name", "n.uri", "n.create_time")


def live_artifacts(artifacts: DataFrame) -> DataFrame:
    return latest_artifacts(artifacts.where(F.col("state") == LIVE))


def latest_uri(artifacts: DataFrame, name: str) -> str | None:
    """Uri of the newest artifact called ``name``; None, with a warning, when there is none."""
    row = latest_artifacts(artifacts.where(F.col("display_name") == name)).first()
    if row is None:
        log.warning("no artifact named %s", name)
        return None
    return row["uri"]


def live_uri(artifacts: DataFrame, name: str = MODEL_NAME) -> str:
    """Uri of the live artifact called ``name``; an error when there is none."""
    row = live_artifacts(artifacts.where(F.col("display_name") == name)).first()
    if row is None:
        raise LookupError(f"no live artifact named {name}")
    return row["uri"]


def versioned_path(root: Column, version: Column) -> Column:
    return F.concat_ws("/", F.rtrim(root, F.lit("/")), version)


def versioned_model_name(version: Column) -> Column:
    return F.concat(F.lit(MODEL_NAME + "_"), version)


def versioned_index_name(base: Column, version: Column, model: Column) -> Column:
    safe = F.translate(model, "./", "--")
    return F.concat(base, F.lit("_index_"), version, F.lit("_"), safe)
