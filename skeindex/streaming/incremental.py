"""Scheduled incremental runs: new page or chunk files become index updates, each file once.

A micro-batch is known to the index by its stream and number, which are committed with its rows: one that is repeated
after a failure commits nothing if its first run did, and starts over if it did not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeindex.plans.flows import Embedder, incremental_update, ingest_chunks
from skeindex.operators.bm25 import Analyzer
from skeindex.schemas import CHUNK, PAGE
from skeindex.sources import artifacts
from skeindex.sources.indexes import IndexCatalog
from skeindex.sources.rejects import RejectLog


def run_available(stream: DataFrame, handle, checkpoint: str) -> None:
    """Process what has arrived since the last run over ``checkpoint``, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def update_from_pages(
    catalog: IndexCatalog, index_name: str, pages_dir: str, chunks_root: str, registry: str,
    checkpoint: str, model_name: str = artifacts.MODEL_NAME, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), replace_files: bool = False, rejects: RejectLog | None = None,
) -> None:
    """Index the page files (Parquet) that appeared in ``pages_dir``; ``checkpoint`` names the stream."""
    stream = catalog.spark.readStream.schema(PAGE).parquet(pages_dir)
    handle = page_batches(catalog, index_name, chunks_root, registry, checkpoint, model_name, embedder, analyzer, replace_files, rejects)
    run_available(stream, handle, checkpoint)


def page_batches(
    catalog: IndexCatalog, index_name: str, chunks_root: str, registry: str, stream: str,
    model_name: str = artifacts.MODEL_NAME, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), replace_files: bool = False, rejects: RejectLog | None = None,
):
    """What is done with each batch of pages."""

    def handle(batch: DataFrame, number: int) -> None:
        incremental_update(
            catalog, index_name, batch, f"{chunks_root}/batch={number}", registry, model_name,
            embedder=embedder, analyzer=analyzer, replace_files=replace_files, batch=(stream, number), rejects=rejects,
        )

    return handle


def update_from_chunks(
    catalog: IndexCatalog, index_name: str, chunks_dir: str, registry: str, checkpoint: str,
    model_name: str = artifacts.MODEL_NAME, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), glob: str = "*.jsonl",
) -> None:
    """Index the chunk files (JSONL) that appeared in ``chunks_dir``; ``checkpoint`` names the stream."""
    reader: SparkSession = catalog.spark
    stream = reader.readStream.schema(CHUNK).option("pathGlobFilter", glob).json(chunks_dir)
    run_available(stream, chunk_batches(catalog, index_name, registry, checkpoint, model_name, embedder, analyzer), checkpoint)


def chunk_batches(
    catalog: IndexCatalog, index_name: str, registry: str, stream: str, model_name: str = artifacts.MODEL_NAME,
    embedder: Embedder = Embedder(), analyzer: Analyzer = Analyzer(),
):
    """What is done with each batch of chunks."""

    def handle(batch: DataFrame, number: int) -> None:
        ingest_chunks(catalog, index_name, batch, registry, model_name, embedder, analyzer, batch=(stream, number))

    return handle
