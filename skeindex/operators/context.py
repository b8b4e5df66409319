"""From neighbours to prompt: reply parsing, chunk lookup by pointer, context text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeindex.schemas import NEIGHBOR_REPLY
from skeindex.session import fits_broadcast

# The prompt around the context.
PROMPT_HEAD = (
    "You are a helpful assistant. Answer the user's question using only the provided context.\n\n"
    "Context:\n"
)
PROMPT_QUESTION = "\n\nQuestion:\n"
PROMPT_TAIL = "\n\nAnswer:\n"


def parse_neighbors(replies: DataFrame, body: str = "body") -> DataFrame:
    """``(qid, rank, id, distance, sparse_distance, metadata)`` of saved JSON replies ``(qid, body)``.

    Only the first query of a reply counts; a reply without neighbours gives no row.
    """
    parsed = replies.select("qid", F.from_json(body, NEIGHBOR_REPLY).alias("r"))
    first = F.get("r.nearestNeighbors", F.lit(0))["neighbors"]
    rows = parsed.select("qid", F.posexplode(first).alias("at", "n"))
    return rows.select(
        "qid",
        (F.col("at") + 1).alias("rank"),
        F.col("n.datapoint.datapointId").alias("id"),
        F.col("n.distance").alias("distance"),
        F.col("n.sparse_distance").alias("sparse_distance"),
        F.col("n.datapoint.embeddingMetadata").alias("metadata"),
    )


def fetch_chunks(neighbors: DataFrame, chunks: DataFrame) -> DataFrame:
    """``(qid, rank, id, chunk)`` by pointer; missing pointers and empty texts give no row.

    ``neighbors`` needs ``metadata.chunk_gcs_uri`` and ``metadata.chunk_line_offset``. A chunk store
    partitioned by offset block is read only in the blocks that the neighbours point to.
    """
    pointers = neighbors.select(
        "qid",
        "rank",
        "id",
        F.col("metadata.chunk_gcs_uri").alias("chunk_gcs_uri"),
        F.col("metadata.chunk_line_offset").cast("long").alias("chunk_line_offset"),
    ).where(F.col("chunk_gcs_uri").isNotNull() & F.col("chunk_line_offset").isNotNull())
    keys = ["chunk_gcs_uri", "chunk_line_offset"]
    texts = chunks.where(F.col("chunk") != "")
    if "offset_block" in chunks.columns:
        pointers = pointers.withColumn("offset_block", offset_block(F.col("chunk_line_offset")))
        keys.append("offset_block")
    width = F.coalesce(F.octet_length("chunk_gcs_uri"), F.lit(0)) + F.octet_length(F.col("id").cast("string")) + 64
    if fits_broadcast(pointers, width):
        # A broadcast on the partition column lets Spark skip the other blocks.
        pointers = F.broadcast(pointers)
    return texts.select(*keys, "chunk").join(pointers, keys).select("qid", "rank", "id", "chunk")


def offset_block(offset, rows: int = 1_000_000):
    """Partition number of a line offset in the chunk store."""
    return F.floor(offset / F.lit(rows)).cast("long")


def build_context(fetched: DataFrame) -> DataFrame:
    """``(qid, context)``: numbered chunks in rank order, one per line. A query has at most k rows."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "chunk")))
    lines = F.transform(
        "c", lambda x, i: F.concat(F.lit("Context "), (i + 1).cast("string"), F.lit(": "), x["chunk"])
    )
    grouped = fetched.groupBy("qid").agg(ordered.alias("c"))
    return grouped.select("qid", F.array_join(lines, "\n").alias("context"))


def build_prompts(context: DataFrame, queries: DataFrame, text: str = "text") -> DataFrame:
    """``(qid, prompt)`` for every query that has context."""
    prompt = F.concat(
        F.lit(PROMPT_HEAD), F.col("context"), F.lit(PROMPT_QUESTION), F.col(text), F.lit(PROMPT_TAIL)
    )
    return context.join(queries.select("qid", text), "qid").select("qid", prompt.alias("prompt"))
