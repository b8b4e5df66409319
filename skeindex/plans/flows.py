"""Flows: the compositions a user runs. Each stage that several others read is written once."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeindex.functions.markup import CleaningRules
from skeindex.operators import bm25, chunking, cleaning, context, dense, intake, merge, search
from skeindex.operators.bm25 import Analyzer, Model
from skeindex.session import spread, stage
from skeindex.sources import artifacts, commits, jsonl, models, objects
from skeindex.sources.indexes import IndexCatalog, IndexSettings
from skeindex.sources.keyed import KeyedTable
from skeindex.sources.postings import PostingStore
from skeindex.sources.rejects import FAILED_PAGE, FAILED_TEXT, NO_TERMS, RejectLog

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Embedder:
    """Which dense model to use. ``loader`` None means the built-in hashed embedder."""

    loader: dense.Loader | None = None
    dims: int = dense.DEFAULT_DIMENSIONS

    @staticmethod
    def named(registry: dense.ModelRegistry, model: str, dims: int = dense.DEFAULT_DIMENSIONS):
        """The embedder of a model name; ``local`` is the built-in one unless registered."""
        if model == dense.LOCAL_NAME and not registry.knows(model):
            return Embedder(None, dims)
        return Embedder(registry.resolve(model), dims)

    def apply(self, df: DataFrame, text: str, role: str = dense.DOCUMENT) -> DataFrame:
        """Add ``embedding`` (and, for a model, ``embedding_error``) to rows with ``terms``."""
        if self.loader is not None:
            return dense.embed(df, self.loader, text, role)
        return dense.densify(dense.hashed_features(df, self.dims), self.dims)


def chunk_dataset(
    pages: DataFrame, uri: str, version: str = chunking.DEFAULT_VERSION,
    rules: CleaningRules = CleaningRules(), rejects: RejectLog | None = None,
) -> DataFrame:
    """Clean and chunk ``pages``; write the chunk table at ``uri`` and return it.

    Cleaning and splitting run once; numbering works on what they wrote, and so does the report of pages that failed.
    """
    spark = pages.sparkSession
    cleaned = cleaning.clean_pages(pages.drop("fingerprint"), rules)
    counted, seen = chunking.counted(chunking.chunk_records(cleaned, version, empty=True), "chunks", "chunk")
    whole = stage(counted, "chunks")
    log.info("%d chunks for %s", seen.get["rows"], uri)
    if rejects is not None:
        rejects.write(whole.where(F.col("error").isNotNull()), FAILED_PAGE, F.col("source_file"), F.col("error"))
    numbered = chunking.with_line_offsets(whole.where(F.col("chunk").isNotNull()).drop("error"), uri)
    jsonl.write_chunk_store(numbered, uri)
    return jsonl.read_chunk_store(spark, uri, numbered.schema)


def reuse_dataset(previous: DataFrame, uri: str) -> DataFrame:
    """Chunks of an earlier run (with ``file_path``) re-pointed to a new table at ``uri``."""
    chunks = chunking.reuse_chunks(previous, uri)
    jsonl.write_chunk_store(chunks, uri)
    return jsonl.read_chunk_store(previous.sparkSession, uri, chunks.schema)


def fit_model(
    chunks: DataFrame, uri: str, registry: str | None = None, name: str = artifacts.MODEL_NAME,
    when: datetime | None = None, analyzer: Analyzer = Analyzer(), termed: DataFrame | None = None,
) -> Model:
    """Corpus statistics only: fit, persist, register. ``termed``: the chunks with their terms, if they were made before."""
    spark = chunks.sparkSession
    if termed is None:
        records = bm25.coalesce_text(chunks.select([c for c in ("id", "chunk", "text") if c in chunks.columns]))
        termed = stage(bm25.with_terms(spread(records), "chunk", analyzer).drop("chunk"), "terms")
    terms = termed.select("id", "terms", "doc_len")
    fitted = Model(bm25.document_frequency(terms), bm25.corpus_stats(terms))
    models.write_model(fitted, terms.select("id"), uri)
    if registry is not None:
        artifacts.register_artifact(spark, registry, name, uri, when)
    return models.load_model(spark, uri)


def termed_chunks(chunks: DataFrame, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """The chunks that have text with their terms, written once for the model and for the vectors."""
    light = spread(bm25.coalesce_text(chunks.drop("offset_block")))
    return stage(bm25.with_terms(light, "chunk", analyzer), "encoded")


def encode_chunks(
    chunks: DataFrame, model: Model | None, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), rejects: RejectLog | None = None, termed: DataFrame | None = None,
) -> DataFrame:
    """Chunks with ``sparse_embedding`` and ``embedding``, both computed on the row itself.

    The result is written once: the token work is not repeated by later filters, nor is a model run again for the report
    of texts that it failed on.
    """
    termed = termed_chunks(chunks, analyzer) if termed is None else termed
    sparse = bm25.encode_documents(termed, model, drop_terms=False)
    found = embedder.apply(sparse, "chunk")
    if rejects is not None:
        rejects.write(termed.where(F.col("doc_len") == 0), NO_TERMS, F.col("id"), F.lit(None).cast("string"))
        if "embedding_error" in found.columns:
            found = stage(found, "vectors")
            rejects.write(found.where(F.col("embedding_error").isNotNull()), FAILED_TEXT, F.col("id"), F.col("embedding_error"))
    return found.drop("terms", "doc_len", "embedding_error")


def build_datapoints(
    chunks: DataFrame, model: Model | None, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), rejects: RejectLog | None = None, termed: DataFrame | None = None,
) -> DataFrame:
    """Datapoints of chunks whose ids are distinct: no join, since both vectors sit on the row."""
    if model is None:
        log.warning("no model: no chunk gets a sparse vector, so none can enter an index")
    encoded = encode_chunks(chunks, model, embedder, analyzer, rejects, termed)
    # The sparse vector has values exactly when the staged terms are not empty.
    return merge.as_datapoints(merge.has_sparse(merge.rename_dimensions(encoded)))


def merged_datapoints(
    chunks: DataFrame, model: Model | None, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(),
) -> DataFrame:
    """Like ``build_datapoints`` for chunks that may repeat an id: vectors are merged by id."""
    encoded = stage(encode_chunks(chunks, model, embedder, analyzer), "vectors")
    keyed = encoded.withColumn("seq", F.col("chunk_line_offset"))
    return merge.merge_embeddings(
        encoded.drop("sparse_embedding", "embedding"),
        keyed.select("id", "sparse_embedding", "seq"),
        keyed.select("id", "embedding", "seq"),
    )


def full_rebuild(
    catalog: IndexCatalog, index_name: str, chunks_uri: str, model_uri: str,
    pages: DataFrame | None = None, previous: DataFrame | None = None,
    version: str = chunking.DEFAULT_VERSION, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), registry: str | None = None,
    model_name: str = artifacts.MODEL_NAME, when: datetime | None = None, rejects: RejectLog | None = None,
) -> int:
    """Create the index if absent, chunk (or reuse chunks), fit, encode, overwrite the index."""
    catalog.create(index_name, IndexSettings(dims=embedder.dims))
    if previous is not None:
        chunks = reuse_dataset(previous, chunks_uri)
    else:
        chunks = chunk_dataset(pages, chunks_uri, version, rejects=rejects)
    termed = termed_chunks(chunks, analyzer)
    model = fit_model(chunks, model_uri, registry, model_name, when, analyzer, termed)
    points = build_datapoints(chunks, model, embedder, analyzer, rejects, termed)
    return catalog.update(index_name, points, overwrite=True)


def incremental_update(
    catalog: IndexCatalog, index_name: str, pages: DataFrame, chunks_uri: str, registry: str,
    model_name: str = artifacts.MODEL_NAME, version: str = chunking.DEFAULT_VERSION,
    embedder: Embedder = Embedder(), analyzer: Analyzer = Analyzer(), replace_files: bool = False,
    batch: tuple[str, int] | None = None, rejects: RejectLog | None = None,
) -> int:
    """Chunk new pages, encode them with the newest stored model, upsert the index.

    A ``batch`` of a stream, as ``(stream, number)``, that the index has already changes nothing.
    """
    catalog.find(index_name)
    if catalog.applied(index_name, batch):
        return catalog.table(index_name).manifest(catalog.spark).version
    chunks = chunk_dataset(pages, chunks_uri, version, rejects=rejects)
    return ingest_chunks(
        catalog, index_name, chunks, registry, model_name, embedder, analyzer, replace_files, batch, rejects
    )


def ingest_chunks(
    catalog: IndexCatalog, index_name: str, chunks: DataFrame, registry: str,
    model_name: str = artifacts.MODEL_NAME, embedder: Embedder = Embedder(),
    analyzer: Analyzer = Analyzer(), replace_files: bool = False, batch: tuple[str, int] | None = None,
    rejects: RejectLog | None = None, termed: DataFrame | None = None,
) -> int:
    """Encode chunks that exist already with the newest stored model and upsert the index.

    A ``batch`` of a stream that the index has already changes nothing. ``termed``: the chunks with their terms, if
    they were made before, as by ``termed_chunks``.
    """
    spark = chunks.sparkSession
    if catalog.applied(index_name, batch):
        return catalog.table(index_name).manifest(spark).version
    uri = artifacts.latest_uri(artifacts.read_artifacts(spark, registry), model_name)
    points = build_datapoints(chunks, models.load_model(spark, uri), embedder, analyzer, rejects, termed)
    return catalog.update(index_name, points, replace_files=replace_files, batch=batch)


def intake_pages(
    raw: DataFrame, store: KeyedTable, prefix: str, order: str, scrape_time=None
) -> DataFrame:
    """Store the changed pages among ``raw(url, html, order)``; returns those pages."""
    spark = raw.sparkSession
    keyed = intake.with_page_keys(raw, prefix, scrape_time)
    columns = ["source_file", "html", "original_url", "scrape_time", "fingerprint"]
    if store.exists(spark):
        fresh = intake.changed_pages(store.read(spark), keyed, order)
    else:
        fresh = intake.last_per_key(keyed, "source_file", order)
    fresh = stage(fresh.select(*columns), "pages")
    store.upsert(fresh)
    return fresh


def scan_and_chunk(spark: SparkSession, uri: str, chunks_uri: str, metadata=None, **options) -> DataFrame:
    """Chunk only: HTML objects under ``uri`` to a chunk table."""
    return chunk_dataset(objects.scan_pages(spark, uri, metadata), chunks_uri, **options)


def chunk_tables(found: DataFrame) -> DataFrame:
    """The chunks of all tables that the neighbours ``found`` point to, read by one scan of the blocks that they name.

    A table is listed once, to see which of its blocks are there; a table that is gone has no chunks.
    """
    spark = found.sparkSession
    block = context.offset_block(F.col("metadata.chunk_line_offset").cast("long")).alias("block")
    pairs = found.select(F.col("metadata.chunk_gcs_uri").alias("uri"), block).where("uri is not null and block is not null")
    wanted: dict[str, list[str]] = {}
    for row in pairs.distinct().orderBy("uri", "block").collect():  # blocks of a million chunks, of tables of whole runs
        wanted.setdefault(row["uri"], []).append(f"offset_block={row['block']}")
    paths = []
    for uri, blocks in wanted.items():
        there = set(commits.names(spark, uri))
        paths += [f"{uri}/{b}" for b in blocks if b in there]
    schema = "chunk_gcs_uri string, chunk_line_offset bigint, chunk string"
    if not paths:
        return spark.createDataFrame([], schema + ", offset_block bigint")
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
    return rows.withColumn("offset_block", context.offset_block(F.col("chunk_line_offset")))


@dataclass(frozen=True)
class SearchOptions:
    k: int = search.NEIGHBOR_COUNT
    alpha: float = search.RRF_ALPHA
    depth: int | None = None  # candidates per list; None means k
    metric: str = "dot"
    approximate: bool = False  # search the cells of an index that has them


def hybrid_topk(
    queries: DataFrame, index: DataFrame, model: Model,
    options: SearchOptions = SearchOptions(), analyzer: Analyzer = Analyzer(),
    by_vector: DataFrame | None = None, postings: PostingStore | None = None,
) -> DataFrame:
    """Fused top-k of ``queries(qid, text, dense)`` over ``index(id, embedding, sparse_embedding)``.

    ``by_vector``: the dense list, if it was searched elsewhere; ``postings``: an inverted index of the same rows.
    """
    depth = options.depth or options.k
    # Query text bounds the number of query terms.
    small = bm25.queries_are_small(queries)
    terms = bm25.query_terms(queries, model, "text", analyzer, small)
    by_terms = search.sparse_topk_rows(index, terms, depth) if postings is None else postings.search(terms, depth)
    if by_vector is None:
        by_vector = search.dense_topk(index, queries, depth, options.metric)
    return search.reciprocal_rank_fusion(by_vector, by_terms, options.k, options.alpha)


def answer_queries(
    catalog: IndexCatalog, index_name: str, queries: DataFrame, chunks: DataFrame | None, registry: str,
    model_name: str = artifacts.MODEL_NAME, embedder: Embedder = Embedder(),
    options: SearchOptions = SearchOptions(), analyzer: Analyzer = Analyzer(),
) -> DataFrame:
    """From ``queries(qid, text)`` to ``(qid, prompt)``: live model, hybrid search, chunk lookup.

    Without ``chunks``, the chunk tables that the neighbours point to are read.
    """
    spark = catalog.spark
    catalog.find(index_name)
    uri = artifacts.live_uri(artifacts.read_artifacts(spark, registry), model_name)
    model = models.load_model(spark, uri)
    termed = bm25.with_terms(queries.select("qid", "text"), "text", analyzer)
    ready = embedder.apply(termed, "text", dense.QUERY).select(
        "qid", "text", F.col("embedding").alias("dense")
    )
    ready = stage(ready, "queries")
    index = catalog.read(index_name)
    by_vector = catalog.search(index_name, ready, options.depth or options.k, options.approximate)
    fused = hybrid_topk(ready, index, model, options, analyzer, by_vector, catalog.postings(index_name))
    # The pointers are used several times: written once.
    found = stage(search.shape_results(fused, index), "found")
    if chunks is None:
        chunks = chunk_tables(found)
    texts = context.fetch_chunks(found, chunks)
    return context.build_prompts(context.build_context(texts), queries)
