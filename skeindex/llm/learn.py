"""What the learned scores share: the rows to learn from, and scoring of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skeindex.llm.common import crc32_fold, staged

def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, folds: int = 5) -> DataFrame:
    """``text, label`` of at most about ``max_rows`` labelled rows outside the held-out fold, chosen by a hash of the id.

    The bound is on what a model is fitted to. An id's text counts once, however often it was delivered; should ids have
    so many different texts that the rows exceed the bound, these are chosen by their hash as well. The chosen ids are
    few enough to broadcast, so texts are not moved. Rows without id or label are not used.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (crc32_fold(F.col("doc_id"), folds) != 0))
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = _share(rows, F.xxhash64("doc_id"), max_rows / max(1, rows.count()))
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(rows), "doc_id")
    keys = found.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"), F.first("label").alias("label"))
    keys = staged(keys, "labelled")
    return _share(keys, F.xxhash64("text_hash", F.lit(1)), max_rows / max(1, keys.count() / 2)).select("text", "label")


def _share(rows: DataFrame, hashed: Column, share: float) -> DataFrame:
    """The rows whose 64-bit hash is in the lowest ``share`` of all values; all if the share is 1 or more."""
    return rows if share >= 1 else rows.where(hashed < int(share * (1 << 64)) - (1 << 63))


def scored(docs: DataFrame, score: Callable[[list[str]], np.ndarray], at_least: float, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``score`` gets the texts of a part of a batch (null: empty)."""
    rows = docs.select("text", "doc_id")
    schema = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = score([t or "" for t in part.column(0).to_pylist()])
                yield pa.record_batch([part.column(1), pa.array(found, pa.float64())], names=["doc_id", "score"])

    found = rows.mapInArrow(run, schema)
    held_out = (crc32_fold(F.col("doc_id"), folds) == 0).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= at_least).cast("int").alias("predicted"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> tuple[float, float]:
    """Slope (not negative) and intercept of a one-feature logistic regression, by Newton steps."""
    if not len(y) or y.min() == y.max():
        return 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    design = np.column_stack([x, np.ones_like(x)])
    weights = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(design @ weights)
        slope = design.T @ (p - y) / len(y) + penalty * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design / len(y) + penalty * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(weights[0])), float(weights[1])
