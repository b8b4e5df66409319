"""Stored BM25 models: two tables and the list of ids they were fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeindex.operators.bm25 import Model
from skeindex.sources.objects import read_if_present


class EmptyCorpus(ValueError):
    """There is no text to fit a model on."""


def write_model(model: Model, ids: DataFrame | None, uri: str) -> None:
    """Persist ``stats``, ``df`` (sorted by term in every file, so that lookups skip row groups) and ``doc_ids``.

    Nothing is written for an empty corpus.
    """
    row = model.stats.first()  # the statistics are one row
    if row["n_docs"] == 0:
        raise EmptyCorpus("no text found to fit a model on")
    model.df.sortWithinPartitions("term_id").write.mode("overwrite").parquet(uri + "/df")
    if ids is not None:
        ids.write.mode("overwrite").parquet(uri + "/doc_ids")
    # Written last: its presence marks a complete model.
    stats = model.df.sparkSession.createDataFrame([row], model.stats.schema)
    stats.coalesce(1).write.mode("overwrite").parquet(uri + "/stats")


def load_model(spark: SparkSession, uri: str | None) -> Model | None:
    """The model stored at ``uri`` or in a folder below it, up to two levels down; None when there is none.

    Of several models on one level the one in the folder with the greatest name is taken.
    """
    if not uri:
        return None
    for folder in (uri, uri + "/*", uri + "/*/*"):
        stats = read_if_present(spark, folder + "/stats")
        if stats is None:
            continue
        # One small file per model.
        newest = stats.select(F.max(F.col("_metadata.file_path"))).first()[0]
        if newest is None:
            continue
        home = newest.rsplit("/stats/", 1)[0]
        df = read_if_present(spark, home + "/df", "term_id bigint, df bigint")
        return None if df is None else Model(df, spark.read.parquet(home + "/stats"))
    return None


def load_doc_ids(spark: SparkSession, uri: str) -> DataFrame | None:
    return read_if_present(spark, uri + "/doc_ids")
