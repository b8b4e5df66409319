"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeindex.operators import ann, bm25, chunking, cleaning, context, dense, intake, merge, quantise, search
from skeindex.operators.bm25 import Analyzer, Model
from skeindex.plans import flows
from skeindex.plans.flows import Embedder, SearchOptions
from skeindex.schemas import CHUNK
from skeindex.session import shared_dir, ship_package, spread, stage
from skeindex.sources import artifacts, jsonl, models, objects
from skeindex.sources.indexes import IndexCatalog, IndexSettings
from skeindex.sources.keyed import KeyedTable
from skeindex.sources.postings import PostingStore
from skeindex.sources.rejects import RejectLog
from skeindex.streaming import incremental

# SQL has no stemmer, so the compared queries run without one.
PLAIN = Analyzer(stem=False)
HASH_DIMS = 256
PREFIX = "site"
STAMP = "2024-01-01 00:00:00"
LATER = "2024-02-01 00:00:00"
DATASET = "chunks/v1"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("chunk"))
    return spread(rows, "id")


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def moment(text: str):
    return F.lit(text).cast("timestamp")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def terms_of(spark: SparkSession, sf: str) -> DataFrame:
    """Document terms, written once because fit and encoding both read them."""
    return stage(bm25.with_terms(documents(spark, sf), "chunk", PLAIN).drop("chunk"), "terms")


def model_of(terms: DataFrame) -> Model:
    return Model(bm25.document_frequency(terms), bm25.corpus_stats(terms))


# --- BM25 ---------------------------------------------------------------------------------------


def term_frequency(spark, sf):
    return bm25.term_frequency(documents(spark, sf), "chunk", PLAIN)


def bm25_doc_freq(spark, sf):
    return bm25.fit(documents(spark, sf), PLAIN).df


def bm25_stats(spark, sf):
    stats = bm25.fit(documents(spark, sf), PLAIN).stats
    return stats.withColumn("avgdl", F.round("avgdl", 6))


def bm25_stats_stemmed(spark, sf):
    """With the default analyzer: stems replace words, so lengths stay as they are."""
    stats = bm25.fit(documents(spark, sf), Analyzer()).stats
    return stats.withColumn("avgdl", F.round("avgdl", 6))


def bm25_encode_docs(spark, sf):
    terms = terms_of(spark, sf)
    rows = bm25.postings(bm25.encode_documents(terms, model_of(terms)))
    return rows.withColumn("weight", F.round("weight", 6))


def bm25_encode_queries(spark, sf):
    model = model_of(terms_of(spark, sf))
    packed = bm25.encode_queries(benchmark(spark, sf), model, "text", PLAIN)
    pairs = F.explode(F.arrays_zip("sparse.dimensions", "sparse.values"))
    rows = packed.select("qid", pairs.alias("p"))
    return rows.select(
        "qid", F.col("p.dimensions").alias("term_id"), F.round("p.values", 6).alias("weight")
    )


def stored_model(spark, sf):
    """Fit, persist, load again: document frequencies as read from the store."""
    uri = scratch(spark, "model")
    flows.fit_model(documents(spark, sf), uri, analyzer=PLAIN)
    return models.load_model(spark, uri).df


def sparse_topk(spark, sf):
    terms = terms_of(spark, sf)
    model = model_of(terms)
    index = bm25.encode_documents(terms, model)
    queries = benchmark(spark, sf)
    small = bm25.queries_are_small(queries)
    wanted = bm25.query_terms(queries, model, "text", PLAIN, small)
    return search.sparse_topk_rows(index, wanted, 10)


def _posting_store(spark, sf, slice_docs=64):
    """A stored inverted index of all documents, and the terms of the benchmark questions."""
    terms = terms_of(spark, sf)
    model = model_of(terms)
    store = PostingStore(scratch(spark, "postings"), buckets=16)
    store.write(bm25.encode_documents(terms, model), slice_docs)
    return store, bm25.query_terms(benchmark(spark, sf), model, "text", PLAIN)


def sparse_topk_blocks(spark, sf):
    """The same search in an inverted index: blocks that cannot enter a top list are not read."""
    store, wanted = _posting_store(spark, sf)
    return store.search(wanted, 10)


def posting_lists(spark, sf):
    """What the stored inverted index holds of each term."""
    store, _ = _posting_store(spark, sf)
    lists = store.blocks(spark).groupBy("term_id")
    return lists.agg(F.sum("n").alias("df"), F.round(F.max("top"), 6).alias("most"), F.round(F.min("low"), 6).alias("least"))


def sparse_topk_join(spark, sf):
    """The same search by joining on terms, as for query sets too large to broadcast."""
    terms = terms_of(spark, sf)
    model = model_of(terms)
    wanted = bm25.query_terms(benchmark(spark, sf), model, "text", PLAIN, False)
    return search.sparse_topk_rows(bm25.encode_documents(terms, model), wanted, 10, limit=4096)


def _two_spellings(spark, sf):
    """Documents whose text sits under either key, or under none."""
    rows = table(spark, sf, "documents")
    return rows.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") == "en", F.col("text")).otherwise(F.lit("")).alias("chunk"),
        F.when(F.col("lang") != "de", F.col("text")).alias("text"),
    )


def text_coalesce(spark, sf):
    return bm25.coalesce_text(_two_spellings(spark, sf)).select("id", F.md5("chunk").alias("digest"))


def doc_ids(spark, sf):
    return bm25.doc_ids(_two_spellings(spark, sf))


# --- dense vectors ------------------------------------------------------------------------------


def label_means(spark, sf):
    """One query vector per label: the mean of its vectors."""
    cells = vectors(spark, sf).select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(F.col("label").alias("qid")).agg(ordered["x"].alias("dense"))


def _dense_topk(metric):
    def run(spark, sf):
        return search.dense_topk(vectors(spark, sf), label_means(spark, sf), 10, metric)

    return run


def l2_normalize(spark, sf):
    scaled = vectors(spark, sf).withColumn(
        "embedding", F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    )
    rows = dense.l2_normalize(scaled).select("id", F.posexplode("embedding").alias("pos", "x"))
    return rows.select("id", "pos", F.round("x", 6).alias("x"))


def hash_embed(spark, sf):
    embedded = dense.hash_embed(documents(spark, sf), "chunk", dense.DEFAULT_DIMENSIONS, PLAIN)
    rows = embedded.select("id", F.posexplode("embedding").alias("dim", "x")).where(F.col("x") != 0)
    return rows.select("id", "dim", F.round(F.col("x").cast("double"), 6).alias("x"))


def model_embed(spark, sf):
    """The model hook: a batch model behind the registry, with vowel counts as its vectors."""

    def load(role):
        def vowels(texts):
            return [[float(t.count(v)) for v in "aeiou"] for t in texts]

        return vowels

    registry = dense.ModelRegistry().register("vowels", load)
    embedded = dense.embed(documents(spark, sf), registry.resolve("vowels"), "chunk")
    return embedded.select(
        "id", *[F.col("embedding")[i].cast("long").alias(v) for i, v in enumerate("aeiou")]
    )


def role_embed(spark, sf):
    """A model that reads documents and queries differently: its loader is given the role."""

    def load(role):
        letters = "aeiou" if role == dense.DOCUMENT else "nrst"

        def counted(texts):
            return [[float(t.count(v)) for v in letters] for t in texts]

        return counted

    loader = dense.ModelRegistry().register("letters", load).resolve("letters")
    docs = dense.embed(documents(spark, sf), loader, "chunk").select(F.lit("document").alias("role"), "id", "embedding")
    asked = benchmark(spark, sf).select(F.col("qid").alias("id"), F.col("text").alias("chunk"))
    queries = dense.embed(asked, loader, "chunk", dense.QUERY).select(F.lit("query").alias("role"), "id", "embedding")
    listed = F.array_join(F.transform("embedding", lambda x: x.cast("long").cast("string")), ",")
    return docs.unionByName(queries).select("role", "id", listed.alias("counts"))


def ann_topk(spark, sf):
    """Every vector as a query in a tenth of the cells, whose centroids are the means of the labels."""
    rows = vectors(spark, sf)
    means = label_means(spark, sf).select(
        F.lit(0).alias("parent"), F.col("dense").alias("parent_centroid"), F.col("qid").alias("cell"),
        F.col("dense").alias("centroid"),
    )
    centroids = stage(means, "centroids")
    path = scratch(spark, "cells")
    ann.write_cells(ann.assign_cells(rows, centroids), path)
    queries = rows.select(F.col("id").alias("qid"), F.col("embedding").alias("dense"))
    return ann.ann_topk(spark.read.parquet(path), centroids, queries, 10)


def index_ann_topk(spark, sf):
    """The same through an index: cells are given to it between two updates."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows.where("label < 5"), "one"), overwrite=True)
    means = label_means(spark, sf).select(
        F.lit(0).alias("parent"), F.col("dense").alias("parent_centroid"), F.col("qid").alias("cell"),
        F.col("dense").alias("centroid"),
    )
    catalog.set_cells("demo", means)
    catalog.update("demo", _points(rows.where("label >= 3"), "two"))
    queries = catalog.read("demo").select(F.col("id").alias("qid"), F.col("embedding").alias("dense"))
    found = catalog.search("demo", queries, 10)
    return found.select("qid", "rank", F.round("score", 4).alias("score"))


def ann_trained(spark, sf):
    """Cells are trained on two levels, and every vector is checked: none of its parent's cells is nearer than its own."""
    rows = vectors(spark, sf).select("id", "embedding")
    centroids = ann.train_cells(rows, leaf_size=50, limit=8192)
    assigned = stage(ann.assign_cells(rows, centroids, 8192), "assigned")
    gap = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    own = assigned.join(centroids.select("parent", "cell", F.col("centroid").alias("own")), "cell")
    near = own.join(centroids.select("parent", "centroid"), "parent")  # a parent has few cells
    closest = near.groupBy("id").agg(F.min(gap("embedding", "centroid")).alias("least"), F.first(gap("embedding", "own")).alias("own"))
    return closest.select("id", (F.col("own") <= F.col("least") + 1e-9).alias("nearest"))


def ann_quantised(spark, sf):
    """A shortlist that holds every vector is ranked exactly, whatever its codes."""
    rows = vectors(spark, sf).select("id", "embedding")
    centroids, codebooks = ann.train_cells(rows, leaf_size=100), quantise.train_codebooks(rows, part_dims=8)
    coded = stage(quantise.with_codes(ann.assign_cells(rows, centroids), codebooks), "coded")
    return quantise.quantised_topk(coded, centroids, codebooks, label_means(spark, sf), 10, probe_pct=100, shortlist=1_000_000)


def ann_all_cells(spark, sf):
    """With every cell searched, the approximate search is exact."""
    rows = vectors(spark, sf)
    centroids = stage(ann.train_cells(rows, leaf_size=50), "centroids")
    assigned = ann.assign_cells(rows, centroids)
    return ann.ann_topk(assigned, centroids, label_means(spark, sf), 10, probe_pct=100)


# --- fusion and results -------------------------------------------------------------------------


def _hybrid(spark, sf):
    terms = terms_of(spark, sf)
    model = model_of(terms)
    embedder = Embedder(dims=HASH_DIMS)
    index = embedder.apply(bm25.encode_documents(terms, model, drop_terms=False), "chunk")
    asked = embedder.apply(bm25.with_terms(benchmark(spark, sf), "text", PLAIN), "text", dense.QUERY)
    queries = stage(asked.select("qid", "text", F.col("embedding").alias("dense")), "queries")
    return flows.hybrid_topk(queries, index, model, SearchOptions(k=10, depth=25), PLAIN)


def hybrid_rrf(spark, sf):
    return _hybrid(spark, sf)


def result_shape(spark, sf):
    metadata = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.struct("lang", "source").alias("embedding_metadata")
    )
    shaped = search.shape_results(_hybrid(spark, sf), metadata)
    return shaped.select(
        "qid", "rank", "id", "distance", "sparse_distance", "metadata.lang", "metadata.source"
    )


# --- page intake --------------------------------------------------------------------------------

ALLOW = "/[a-z]"
DOMAINS = ("example.com", "example.net")
DENY = r"[.,]$"


def extract_links(spark, sf):
    return intake.extract_links(spread(pages(spark, sf), "page_id"))


def filter_links(spark, sf):
    return intake.filter_links(extract_links(spark, sf), ALLOW, DOMAINS, DENY)


def crawl_frontier(spark, sf):
    return intake.crawl_frontier(extract_links(spark, sf), pages(spark, sf))


def link_depth(spark, sf):
    """Links re-aimed at stored pages by a hash of their target; seeds are the first page per host."""
    known = pages(spark, sf).select("page_id", "url")
    total = known.agg(F.count("*").alias("n")).scalar()
    number = F.conv(F.substring(F.md5("dst_url"), 1, 8), 16, 10).cast("long")
    aimed = extract_links(spark, sf).select("src_url", F.pmod(number, total).alias("page_id"))
    links = stage(aimed.join(known, "page_id").select("src_url", F.col("url").alias("dst_url")), "links")
    hosts = known.groupBy(F.regexp_extract("url", r"\.example\.[a-z]+", 0).alias("h"))
    return intake.link_depth(links, hosts.agg(F.min("url").alias("url")), 2)


def page_key(spark, sf):
    keyed = intake.with_page_keys(pages(spark, sf), PREFIX, moment(STAMP))
    return keyed.drop("html")


def _stored(spark, sf):
    known = pages(spark, sf).where(~F.col("url").contains(".net"))
    keyed = intake.with_page_keys(known, PREFIX, moment(STAMP))
    return intake.last_per_key(keyed, "source_file", "page_id")


def _incoming(spark, sf):
    """Pages as scraped again: those of odd length have changed."""
    altered = F.when(F.length("html") % 2 == 1, F.concat("html", F.lit("<!-- new -->")))
    again = pages(spark, sf).withColumn("html", F.coalesce(altered, F.col("html")))
    return intake.with_page_keys(again, PREFIX, moment(LATER))


def changed_pages(spark, sf):
    return intake.changed_pages(_stored(spark, sf), _incoming(spark, sf), "page_id").drop("html")


def upsert_pages(spark, sf):
    return intake.upsert_pages(_stored(spark, sf), _incoming(spark, sf), "page_id").drop("html")


def page_store(spark, sf):
    """Two intakes into a stored page table."""
    store = KeyedTable(scratch(spark, "pages"), "source_file", 8)
    columns = ["source_file", "html", "original_url", "scrape_time", "fingerprint"]
    store.overwrite(_stored(spark, sf).select(*columns))
    fresh = intake.changed_pages(store.read(spark), _incoming(spark, sf), "page_id")
    store.upsert(fresh.select(*columns))
    return store.read(spark).drop("html", "bucket")


# --- cleaning and chunking ----------------------------------------------------------------------


def strip_script_style(spark, sf):
    rows = pages(spark, sf)
    stripped = cleaning.strip_script_style(F.col("html"))
    return rows.select("page_id", F.md5(stripped).alias("digest"), F.length(stripped).alias("length"))


def clean_pages(spark, sf):
    cleaned = cleaning.clean_pages(spread(pages(spark, sf).select("page_id", "html"), "page_id"))
    return cleaned.select("page_id", "markdown", "error")


def _markdown(spark, sf):
    """Documents with their lines turned into headers by first letter."""
    text = F.col("chunk")
    for letters, mark in (("[A-D]", "#"), ("[E-H]", "##"), ("[I-L]", "###"), ("[M-O]", "####")):
        text = F.regexp_replace(text, f"(?m)^({letters})", f"{mark} $1")
    return documents(spark, sf).select("id", text.alias("markdown"))


def header_sections(spark, sf):
    rows = chunking.header_sections(_markdown(spark, sf))
    return rows.select("id", "section", "h1", "h2", "h3", F.md5("text").alias("digest"))


def chunk_text(spark, sf):
    rows = chunking.chunk_text(documents(spark, sf), "chunk")
    return rows.select("id", "i", F.length("chunk").alias("length"), F.md5("chunk").alias("digest"))


def _records(spark, sf):
    cleaned = documents(spark, sf).select(
        F.concat(F.lit("docs/"), F.col("id").cast("string"), F.lit(".html")).alias("source_file"),
        F.lit("").alias("original_url"),
        F.lit("").alias("scrape_time"),
        F.col("chunk").alias("markdown"),
    )
    return chunking.chunk_records(cleaned, "v1")


def chunk_records(spark, sf):
    rows = _records(spark, sf).drop("i")
    return rows.withColumn("headers", F.size("headers")).withColumn("chunk", F.md5("chunk"))


def chunk_headers(spark, sf):
    """Records of texts with headers: each chunk has the headers that it stands under."""
    cleaned = _markdown(spark, sf).select(
        F.concat(F.lit("docs/"), F.col("id").cast("string"), F.lit(".html")).alias("source_file"),
        F.lit("").alias("original_url"), F.lit("").alias("scrape_time"), "markdown",
    )
    return chunking.chunk_records(cleaned).select("id", F.array_join("headers", " > ").alias("headers"), F.md5("chunk").alias("digest"))


def line_offsets(spark, sf):
    numbered = chunking.with_line_offsets(stage(_records(spark, sf), "records"), DATASET)
    return numbered.select("id", "chunk_gcs_uri", "chunk_line_offset")


def _saved_lines(spark, sf):
    """Documents as JSONL, with a broken line for each document of one source."""
    rows = table(spark, sf, "documents")
    body = F.to_json(
        F.struct(
            F.col("doc_id").cast("string").alias("id"),
            F.when(F.col("lang") == "en", F.col("text")).alias("chunk"),
            F.when(F.col("lang") != "en", F.col("text")).alias("text"),
            F.col("source").alias("source_file"),
            F.lit("old").alias("chunk_gcs_uri"),
            F.col("doc_id").alias("chunk_line_offset"),
        )
    )
    broken = F.when(F.col("source") == "src1", F.substring(body, 1, 20)).otherwise(body)
    path = scratch(spark, "lines")
    lines = rows.select("doc_id", broken.alias("value")).repartitionByRange("doc_id")
    lines.sortWithinPartitions("doc_id").select("value").write.text(path)
    return path


def read_jsonl_tolerant(spark, sf):
    good, _ = jsonl.read_tolerant(spark, _saved_lines(spark, sf), glob="*.txt")
    text = bm25.coalesce_text(good)
    return text.select("id", "source_file", F.md5("chunk").alias("digest"))


def quarantined_lines(spark, sf):
    _, bad = jsonl.read_tolerant(spark, _saved_lines(spark, sf), glob="*.txt")
    return bad.select("line")


def reuse_chunks(spark, sf):
    good, _ = jsonl.read_tolerant(spark, _saved_lines(spark, sf), glob="*.txt")
    again = flows.reuse_dataset(good, scratch(spark, "chunks"))
    return again.select("id", "chunk_line_offset")


# --- artifacts ----------------------------------------------------------------------------------


def _artifacts(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("display_name"),
        F.concat(F.lit("store/"), F.col("event_id").cast("string")).alias("uri"),
        F.col("ts").alias("create_time"),
        F.when(F.col("value") > 10, artifacts.LIVE).otherwise("DELETED").alias("state"),
    )


def latest_artifact(spark, sf):
    return artifacts.latest_artifacts(_artifacts(spark, sf)).select("display_name", "uri")


def live_artifact(spark, sf):
    return artifacts.live_artifacts(_artifacts(spark, sf)).select("display_name", "uri")


def versioned_name(spark, sf):
    rows = table(spark, sf, "part")
    return rows.select(
        "p_partkey",
        artifacts.versioned_path(F.concat(F.col("p_type"), F.lit("/")), F.col("p_brand")).alias("path"),
        artifacts.versioned_model_name(F.col("p_brand")).alias("model_name"),
        artifacts.versioned_index_name(
            F.col("p_type"), F.col("p_brand"), F.concat_ws("/", "p_name", F.col("p_retailprice"))
        ).alias("index_name"),
    )


def list_objects(spark, sf):
    """Objects under a folder: three text files for each language, with their sizes, and how many there are."""
    root = scratch(spark, "objects")
    rows = table(spark, sf, "documents").select("lang", (F.col("doc_id") % 3).alias("part"), F.coalesce("text", F.lit("")).alias("value"))
    rows.repartition("lang", "part").write.partitionBy("lang", "part").text(root)
    found = objects.list_objects(spark, root).where(F.col("path").endswith(".txt"))
    folder = lambda name: F.regexp_extract("path", rf"/{name}=(\w+)/", 1)
    own = found.select(folder("lang").alias("lang"), folder("part").cast("long").alias("part"), "length")
    return own.groupBy("lang", "part").agg(F.count("*").alias("objects"), F.sum("length").alias("length"))


def scan_pages(spark, sf):
    """Pages written as one object each, then scanned as whole texts."""
    root = scratch(spark, "html")
    objects.write_objects(pages(spark, sf), root, "page_id", "html")
    found = objects.scan_pages(spark, root, glob="*.txt")
    number = F.regexp_extract("source_file", r"page_id=(\d+)[./]", 1).cast("long")
    return found.select(number.alias("page_id"), F.md5("html").alias("digest"), "original_url")


def chunk_scanned(spark, sf):
    """Chunk only: pages written as objects, scanned and chunked into a table."""
    root = scratch(spark, "scan")
    objects.write_objects(pages(spark, sf), root + "/html", "page_id", "html")
    metadata = spark.createDataFrame([], "source_file string, original_url string, scrape_time string")
    found = objects.scan_pages(spark, root + "/html", metadata, glob="*.txt")
    chunks = flows.chunk_dataset(found, root + "/chunks")
    number = lambda pattern: F.regexp_extract("id", pattern, 1).cast("long")
    return chunks.select(number(r"page_id=(\d+)[./]").alias("page_id"), number(r"_chunk_(\d+)$").alias("i"), F.md5("chunk").alias("digest"), "original_url")


# --- merge and index ----------------------------------------------------------------------------


def _chunk_rows(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("chunk"), "lang", "source", "n_chars"
    )


def _dense_rows(spark, sf):
    """Every vector twice: a stale copy, then the current one; some current ones are empty."""
    rows = vectors(spark, sf)
    stale = rows.select("id", F.reverse("embedding").alias("embedding"), F.lit(0).alias("seq"))
    current = F.when(F.col("label") == 0, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    return stale.unionByName(rows.select("id", current.alias("embedding"), F.lit(1).alias("seq")))


def dedupe_last(spark, sf):
    last = merge.dedupe_last(_dense_rows(spark, sf), "seq")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    first = F.get("embedding", F.lit(0)).cast("double")
    return last.select("id", F.size("embedding").alias("dims"), F.round(total, 6).alias("total"),
                       F.round(first, 6).alias("first"))


def dedupe_null_order(spark, sf):
    """Pairs of documents under one id; an order that is missing loses."""
    rows = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 2).alias("id"), "doc_id", "source",
        F.when(F.col("doc_id") % 3 != 0, F.col("doc_id")).alias("seq"),
    )
    return intake.last_per_key(rows, "id", "seq")


def sparse_topk_repeated_ids(spark, sf):
    """Two documents per id, searched in one block and in many: the better one counts on both paths."""
    terms = terms_of(spark, sf)
    model = model_of(terms)
    index = bm25.encode_documents(terms, model).withColumn("id", F.floor(F.col("id") / 2))
    wanted = bm25.query_terms(benchmark(spark, sf), model, "text", PLAIN)
    paths = (("one", {}), ("many", {"limit": 4096}))
    found = [search.sparse_topk_rows(index, wanted, 10, **o).withColumn("path", F.lit(p)) for p, o in paths]
    return found[0].unionByName(found[1])


def merge_datapoints(spark, sf):
    terms = terms_of(spark, sf)
    encoded = bm25.encode_documents(terms, model_of(terms)).withColumn("seq", F.lit(0))
    points = merge.merge_embeddings(_chunk_rows(spark, sf), encoded, _dense_rows(spark, sf))
    weights = F.aggregate("sparse_embedding.values", F.lit(0.0), lambda a, x: a + x)
    return points.select(
        "id",
        F.size("restricts").alias("restricts"),
        F.size("numeric_restricts").alias("numeric_restricts"),
        "embedding_metadata.lang",
        "embedding_metadata.source",
        "embedding_metadata.n_chars",
        F.size("sparse_embedding.dimensions").alias("n_terms"),
        F.round(weights, 4).alias("weight"),
        F.coalesce(F.size("embedding"), F.lit(-1)).alias("dims"),
    )


def _points(rows: DataFrame, batch: str) -> DataFrame:
    return rows.select(
        F.col("id").cast("string").alias("id"),
        F.array().cast("array<string>").alias("restricts"),
        F.array().cast("array<string>").alias("numeric_restricts"),
        F.struct(
            F.concat(F.lit("f"), F.col("label").cast("string")).alias("source_file"),
            F.lit(batch).alias("batch"),
        ).alias("embedding_metadata"),
        F.struct(
            F.array(F.lit(1.0)).alias("values"), F.array(F.col("id")).alias("dimensions")
        ).alias("sparse_embedding"),
        "embedding",
    )


def _index(spark) -> IndexCatalog:
    catalog = IndexCatalog(spark, scratch(spark, "index"), buckets=8)
    catalog.create("demo", IndexSettings(dims=64))
    return catalog


def _index_rows(catalog: IndexCatalog) -> DataFrame:
    first = F.get("embedding", F.lit(0)).cast("double")
    return catalog.read("demo").select(
        "id", "embedding_metadata.source_file", "embedding_metadata.batch",
        F.round(first, 5).alias("first"),
    )


def index_overwrite(spark, sf):
    """A second overwrite leaves nothing of the first."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows.where("label >= 5"), "one"), overwrite=True)
    catalog.update("demo", _points(rows.where("label < 7"), "two"), overwrite=True)
    return _index_rows(catalog)


def index_upsert(spark, sf):
    """An upsert replaces what it brings and keeps the rest."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows.where("label < 7"), "one"), overwrite=True)
    catalog.update("demo", _points(rows.where("label >= 5"), "two"))
    return _index_rows(catalog)


def index_replace_files(spark, sf):
    """With file replacement, rows of a touched file that the batch lacks are gone."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows, "one"), overwrite=True)
    part = rows.where("label >= 5 and element_at(embedding, 1) > 0")
    catalog.update("demo", _points(part, "two"), replace_files=True)
    return _index_rows(catalog)


def index_overwrite_empty(spark, sf):
    """An overwrite by nothing leaves an empty index, which can be filled again."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows, "one"), overwrite=True)
    catalog.update("demo", _points(rows.where("label > 1000"), "none"), overwrite=True)
    left = _index_rows(catalog)
    catalog.update("demo", _points(rows.where("label >= 5"), "two"))
    return _index_rows(catalog).unionByName(left)


def datapoint_lines(spark, sf):
    """Datapoints written as JSONL and read back without a schema."""
    target = jsonl.write_datapoints(_points(vectors(spark, sf), "one"), scratch(spark, "points"))
    rows = jsonl.read_strict(spark, target, None, "*.json")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "id", "embedding_metadata.source_file", "embedding_metadata.batch", F.size("embedding").alias("dims"), F.round(total, 4).alias("total"),
        F.round(F.element_at("embedding", -1), 4).alias("last"), F.size("restricts").alias("restricts"),
        F.element_at("sparse_embedding.dimensions", 1).alias("term"), F.element_at("sparse_embedding.values", 1).alias("weight"),
    )


# --- replies, chunk lookup, context -------------------------------------------------------------


def _replies(spark, sf):
    """Saved replies, one per user: that user's first ten events as neighbours, in time order."""
    neighbor = F.struct(
        F.col("value").alias("distance"),
        (F.col("value") / 2).alias("sparse_distance"),
        F.struct(
            F.col("event_type").alias("datapointId"),
            F.struct(
                F.when(F.col("event_type") != "error", F.lit(DATASET)).alias("chunk_gcs_uri"),
                F.col("event_id").alias("chunk_line_offset"),
            ).alias("embeddingMetadata"),
        ).alias("datapoint"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("event_id", neighbor.alias("n"))))["n"]
    by_user = Window.partitionBy("user_id").orderBy("event_id")
    events = table(spark, sf, "events").withColumn("k", F.row_number().over(by_user)).where("k <= 10")
    grouped = events.groupBy(F.col("user_id").alias("qid")).agg(ordered.alias("n"))
    answer = F.struct(F.lit("query_0").alias("id"), F.col("n").alias("neighbors"))
    return grouped.select("qid", F.to_json(F.struct(F.array(answer).alias("nearestNeighbors"))).alias("body"))


def parse_neighbors(spark, sf):
    rows = context.parse_neighbors(_replies(spark, sf))
    return rows.select(
        "qid", "rank", "id", "distance", F.round("sparse_distance", 6).alias("sparse_distance"),
        "metadata.chunk_gcs_uri", "metadata.chunk_line_offset",
    )


def _fetched(spark, sf):
    """Pointers past the last document, without uri or to a German text find nothing."""
    chunks = table(spark, sf, "documents").select(
        F.lit(DATASET).alias("chunk_gcs_uri"),
        F.col("doc_id").alias("chunk_line_offset"),
        F.when(F.col("lang") != "de", F.col("text")).otherwise("").alias("chunk"),
    )
    return context.fetch_chunks(context.parse_neighbors(_replies(spark, sf)), chunks)


def fetch_chunks(spark, sf):
    return _fetched(spark, sf).select("qid", "rank", "id", F.md5("chunk").alias("digest"))


def build_context(spark, sf):
    built = context.build_context(_fetched(spark, sf))
    asked = built.select("qid", F.concat(F.lit("question "), F.col("qid").cast("string")).alias("text"))
    prompts = context.build_prompts(built, asked)
    return prompts.select("qid", F.md5("prompt").alias("digest"), F.length("prompt").alias("length"))


# --- flows --------------------------------------------------------------------------------------


def _page_rows(spark, sf):
    keyed = intake.with_page_keys(pages(spark, sf), PREFIX, moment(STAMP))
    return intake.last_per_key(keyed, "source_file", "page_id").drop("page_id")


def _setting(spark):
    root = scratch(spark, "flow")
    return root, IndexCatalog(spark, root + "/index", buckets=8), Embedder(dims=HASH_DIMS)


def _ids(catalog: IndexCatalog) -> DataFrame:
    return catalog.read("main").select(
        "id",
        F.size("sparse_embedding.values").alias("n_terms"),
        F.size("embedding").alias("dims"),
        F.col("embedding_metadata.chunk_line_offset").alias("line"),
    )


def full_rebuild(spark, sf):
    root, catalog, embedder = _setting(spark)
    flows.full_rebuild(
        catalog, "main", root + "/chunks", root + "/model", spread(_page_rows(spark, sf)),
        embedder=embedder, analyzer=PLAIN, registry=root + "/artifacts",
    )
    return _ids(catalog)


def _rebuilt_part(spark, sf):
    root, catalog, embedder = _setting(spark)
    rows = stage(_page_rows(spark, sf), "pages")
    first = rows.where(~F.col("original_url").contains(".net"))
    flows.full_rebuild(
        catalog, "main", root + "/chunks", root + "/model", spread(first),
        embedder=embedder, analyzer=PLAIN, registry=root + "/artifacts",
    )
    return root, catalog, embedder, rows


def incremental_update(spark, sf):
    root, catalog, embedder, rows = _rebuilt_part(spark, sf)
    new = rows.where(F.col("original_url").contains(".net"))
    flows.incremental_update(
        catalog, "main", spread(new), root + "/chunks2", root + "/artifacts", embedder=embedder,
        analyzer=PLAIN,
    )
    return _ids(catalog)


def streaming_update(spark, sf):
    root, catalog, embedder, rows = _rebuilt_part(spark, sf)
    rows.where(F.col("original_url").contains(".net")).write.parquet(root + "/arrivals")
    incremental.update_from_pages(
        catalog, "main", root + "/arrivals", root + "/batches", root + "/artifacts",
        root + "/progress", embedder=embedder, analyzer=PLAIN,
    )
    return _ids(catalog)


def _saved_chunks(spark, sf):
    """Documents as a dataset of chunk records."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("chunk"),
        F.col("source").alias("source_file"),
        F.lit(DATASET).alias("chunk_gcs_uri"),
        F.col("doc_id").alias("chunk_line_offset"),
    )


def ingest_chunks(spark, sf):
    """Chunks that exist as JSONL, encoded with a stored model and put into an index."""
    root, catalog, embedder = _setting(spark)
    jsonl.write_jsonl(_saved_chunks(spark, sf), root + "/lines")
    chunks = jsonl.read_strict(spark, root + "/lines", CHUNK, "*.json")
    termed = flows.termed_chunks(chunks, PLAIN)
    flows.fit_model(chunks, root + "/model", root + "/artifacts", analyzer=PLAIN, termed=termed)
    catalog.create("main", IndexSettings(dims=HASH_DIMS))
    flows.ingest_chunks(
        catalog, "main", chunks, root + "/artifacts", embedder=embedder, analyzer=PLAIN, termed=termed
    )
    return _ids(catalog)


def streaming_chunks(spark, sf):
    """Chunk files of two sets arrive one after the other; the last batch is repeated, as after a failure."""
    root, catalog, embedder = _setting(spark)
    chunks = stage(_saved_chunks(spark, sf), "chunks")
    flows.fit_model(chunks, root + "/model", root + "/artifacts", analyzer=PLAIN)
    catalog.create("main", IndexSettings(dims=HASH_DIMS))
    parts = (chunks.where("chunk_line_offset % 3 = 0"), chunks.where("chunk_line_offset % 3 <> 0"))
    for part in parts:
        jsonl.write_jsonl(part, root + "/arrivals", "append")
        incremental.update_from_chunks(
            catalog, "main", root + "/arrivals", root + "/artifacts", root + "/progress",
            embedder=embedder, analyzer=PLAIN, glob="*.json",
        )
    done = catalog.table("main").manifest(spark)
    again = incremental.chunk_batches(catalog, "main", root + "/artifacts", root + "/progress", embedder=embedder, analyzer=PLAIN)
    again(parts[0], 1)  # with other rows, to show that they are not taken
    if catalog.table("main").manifest(spark) != done:
        raise AssertionError("a repeated batch was committed")
    return _ids(catalog)


def rejected_rows(spark, sf):
    """What three flows leave out: broken lines, pages without content, chunks without terms, texts that a model fails on."""
    root, catalog, embedder = _setting(spark)
    log = RejectLog(root + "/rejects", "r1")
    # Lines: every tenth is cut, every ninth has stop words only.
    chunks = _saved_chunks(spark, sf).select("id", F.when(F.col("chunk_line_offset") % 9 == 0, "The of and").otherwise(F.col("chunk")).alias("chunk"), "source_file")
    line = F.to_json(F.struct("id", "chunk", "source_file"))
    broken = F.concat(F.lit('{"id": "'), F.col("id"))
    chunks.select(F.when(F.col("id").cast("long") % 10 == 0, broken).otherwise(line).alias("value")).write.text(root + "/lines")
    read = jsonl.read_reporting(spark, root + "/lines", log, CHUNK, "*.txt").drop("file_path")

    def load(role):
        def vowels(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise ValueError("length")
            return [[float(t.count(v)) for v in "aeiou"] for t in texts]

        return vowels

    model = flows.fit_model(read, root + "/model", root + "/artifacts", analyzer=PLAIN)
    registry = dense.ModelRegistry().register("vowels", load)
    catalog.create("main", IndexSettings(dims=5))
    flows.ingest_chunks(catalog, "main", read, root + "/artifacts", embedder=Embedder(registry.resolve("vowels"), 5), analyzer=PLAIN, rejects=log)
    # Pages: every seventh has no content.
    rows = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("source_file"), F.when(F.col("page_id") % 7 != 0, F.col("html")).alias("html"),
        F.col("url").alias("original_url"), F.lit(STAMP).alias("scrape_time"),
    )
    flows.chunk_dataset(spread(rows, "source_file"), root + "/chunks", rejects=log)
    found = log.read(spark)
    source = F.when(F.col("reason") == "broken line", F.lit("lines")).otherwise(F.col("source"))
    return found.select("reason", source.alias("source"), "detail", "run")


def index_compacted(spark, sf):
    """Updates as deltas, then compaction: as after one update with everything."""
    catalog, rows = _index(spark), vectors(spark, sf)
    catalog.update("demo", _points(rows.where("label < 7"), "one"), overwrite=True)
    for label in (7, 8, 9, 5, 6):
        catalog.update("demo", _points(rows.where(F.col("label") == label), "two"))
    catalog.table("demo").compact(spark)
    return _index_rows(catalog)


def ingest_without_offsets(spark, sf):
    """Chunk records that have no place in a dataset keep their ids."""
    root, catalog, embedder = _setting(spark)
    chunks = _saved_chunks(spark, sf).withColumn("chunk_line_offset", F.lit(None).cast("long"))
    flows.fit_model(chunks, root + "/model", root + "/artifacts", analyzer=PLAIN)
    catalog.create("main", IndexSettings(dims=HASH_DIMS))
    flows.ingest_chunks(
        catalog, "main", chunks, root + "/artifacts", embedder=embedder, analyzer=PLAIN
    )
    return _ids(catalog).drop("line")


def update_without_chunks(spark, sf):
    """A batch of pages without text changes nothing; the one after it counts."""
    root, catalog, embedder, rows = _rebuilt_part(spark, sf)
    new = rows.where(F.col("original_url").contains(".net"))
    for number, batch in enumerate((new.withColumn("html", F.lit("<html></html>")), new)):
        flows.incremental_update(
            catalog, "main", spread(batch), f"{root}/later{number}", root + "/artifacts",
            embedder=embedder, analyzer=PLAIN,
        )
    return _ids(catalog)


def answer_after_update(spark, sf):
    """Questions whose neighbours lie in the rebuilt data and in an update: both chunk tables are read."""
    root, catalog, embedder, rows = _rebuilt_part(spark, sf)
    new = rows.where(F.col("original_url").contains(".net"))
    flows.incremental_update(
        catalog, "main", spread(new), root + "/chunks2", root + "/artifacts", embedder=embedder,
        analyzer=PLAIN,
    )
    prompts = flows.answer_queries(
        catalog, "main", benchmark(spark, sf), None, root + "/artifacts", embedder=embedder, analyzer=PLAIN
    )
    return prompts.select("qid", (F.size(F.split("prompt", r"\nContext [0-9]+: ")) - 1).alias("contexts"))


def intake_pages(spark, sf):
    """The page flow on an empty store, then on changed pages."""
    store = KeyedTable(scratch(spark, "pages"), "source_file", 8)
    flows.intake_pages(pages(spark, sf), store, PREFIX, "page_id", moment(STAMP))
    html = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise("<p>new</p>")
    again = pages(spark, sf).withColumn("html", html)
    flows.intake_pages(again, store, PREFIX, "page_id", moment(LATER))
    return store.read(spark).select("source_file", "scrape_time", F.md5("html").alias("digest"))


def merged_datapoints(spark, sf):
    """Two documents per id: each keeps its row and gets the vectors of the later one."""
    half = F.floor(F.col("chunk_line_offset") / 2).cast("string")
    chunks = spread(_saved_chunks(spark, sf).withColumn("id", half))
    model = flows.fit_model(chunks, scratch(spark, "model"), analyzer=PLAIN)
    points = flows.merged_datapoints(chunks, model, Embedder(dims=HASH_DIMS), PLAIN)
    return points.select(
        "id",
        F.size("sparse_embedding.values").alias("n_terms"),
        F.size("embedding").alias("dims"),
        F.col("embedding_metadata.chunk_line_offset").alias("line"),
    )


def answer_queries(spark, sf, postings=False):
    """From pages to prompts: rebuild, then the whole query flow for the benchmark questions."""
    root, catalog, embedder = _setting(spark)
    flows.full_rebuild(
        catalog, "main", root + "/chunks", root + "/model", spread(_page_rows(spark, sf)),
        embedder=embedder, analyzer=PLAIN, registry=root + "/artifacts",
    )
    if postings:
        catalog.write_postings("main")
    prompts = flows.answer_queries(
        catalog, "main", benchmark(spark, sf), spark.read.parquet(root + "/chunks"),
        root + "/artifacts", embedder=embedder, analyzer=PLAIN,
    )
    return prompts


def answer_by_postings(spark, sf):
    """The same with an inverted index for the search by terms."""
    return answer_queries(spark, sf, postings=True)


QUERIES = {
    "term_frequency": term_frequency,
    "bm25_doc_freq": bm25_doc_freq,
    "bm25_stats": bm25_stats,
    "bm25_stats_stemmed": bm25_stats_stemmed,
    "bm25_encode_docs": bm25_encode_docs,
    "bm25_encode_queries": bm25_encode_queries,
    "stored_model": stored_model,
    "sparse_topk": sparse_topk,
    "sparse_topk_join": sparse_topk_join,
    "sparse_topk_blocks": sparse_topk_blocks,
    "posting_lists": posting_lists,
    "text_coalesce": text_coalesce,
    "doc_ids": doc_ids,
    "dense_topk_dot": _dense_topk("dot"),
    "dense_topk_cosine": _dense_topk("cosine"),
    "dense_topk_l2": _dense_topk("l2"),
    "l2_normalize": l2_normalize,
    "hash_embed": hash_embed,
    "model_embed": model_embed,
    "role_embed": role_embed,
    "ann_topk": ann_topk,
    "ann_trained": ann_trained,
    "ann_quantised": ann_quantised,
    "index_ann_topk": index_ann_topk,
    "ann_all_cells": ann_all_cells,
    "hybrid_rrf": hybrid_rrf,
    "result_shape": result_shape,
    "extract_links": extract_links,
    "filter_links": filter_links,
    "crawl_frontier": crawl_frontier,
    "link_depth": link_depth,
    "page_key": page_key,
    "changed_pages": changed_pages,
    "upsert_pages": upsert_pages,
    "page_store": page_store,
    "strip_script_style": strip_script_style,
    "clean_pages": clean_pages,
    "header_sections": header_sections,
    "chunk_text": chunk_text,
    "chunk_records": chunk_records,
    "chunk_headers": chunk_headers,
    "line_offsets": line_offsets,
    "read_jsonl_tolerant": read_jsonl_tolerant,
    "quarantined_lines": quarantined_lines,
    "reuse_chunks": reuse_chunks,
    "latest_artifact": latest_artifact,
    "live_artifact": live_artifact,
    "versioned_name": versioned_name,
    "list_objects": list_objects,
    "dedupe_last": dedupe_last,
    "dedupe_null_order": dedupe_null_order,
    "sparse_topk_repeated_ids": sparse_topk_repeated_ids,
    "merge_datapoints": merge_datapoints,
    "index_overwrite": index_overwrite,
    "index_upsert": index_upsert,
    "index_compacted": index_compacted,
    "rejected_rows": rejected_rows,
    "index_replace_files": index_replace_files,
    "index_overwrite_empty": index_overwrite_empty,
    "datapoint_lines": datapoint_lines,
    "parse_neighbors": parse_neighbors,
    "fetch_chunks": fetch_chunks,
    "build_context": build_context,
    "full_rebuild": full_rebuild,
    "incremental_update": incremental_update,
    "streaming_update": streaming_update,
    "ingest_chunks": ingest_chunks,
    "streaming_chunks": streaming_chunks,
    "ingest_without_offsets": ingest_without_offsets,
    "update_without_chunks": update_without_chunks,
    "answer_after_update": answer_after_update,
    "intake_pages": intake_pages,
    "merged_datapoints": merged_datapoints,
    "scan_pages": scan_pages,
    "chunk_scanned": chunk_scanned,
    "answer_queries": answer_queries,
    "answer_by_postings": answer_by_postings,
}
