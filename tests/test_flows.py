"""Whole flows: rebuild, update, stream, reuse, query."""

import pytest
from pyspark.sql import functions as F

from skeindex.operators import context
from skeindex.plans import flows
from skeindex.plans.flows import Embedder, SearchOptions
from skeindex.sources import jsonl, models
from skeindex.sources.indexes import IndexCatalog, IndexSettings
from skeindex.streaming import incremental

SMALL = Embedder(dims=32)
TOPICS = ["apple orchard", "boat harbor", "cloud mountain", "drum rhythm", "engine motor", "forest path"]


def pages(spark, topics, extra=""):
    rows = [
        (f"p/{t.split()[0]}.html", f"<h1>{t}</h1><p>{(t + ' notes ') * 60}</p><p>{extra}</p>", "http://e.example/" + t, "now")
        for t in topics
    ]
    return spark.createDataFrame(rows, "source_file string, html string, original_url string, scrape_time string")


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """One rebuild; tests that change an index work on a copy made from its chunks and model."""
    root = str(tmp_path_factory.mktemp("base"))
    catalog = IndexCatalog(spark, root + "/index", buckets=4)
    flows.full_rebuild(
        catalog, "main", root + "/chunks", root + "/model", pages(spark, TOPICS[:3]),
        embedder=SMALL, registry=root + "/artifacts",
    )
    return catalog, root


@pytest.fixture
def built(spark, base, scratch):
    catalog = IndexCatalog(spark, scratch + "/index", buckets=4)
    catalog.table("main").overwrite(base[0].table("main").read(spark).drop("bucket"))
    catalog.create("main", IndexSettings(dims=SMALL.dims))
    return catalog, scratch, base[1]


def ids(catalog):
    return sorted(r["id"] for r in catalog.read("main").select("id").collect())


def test_rebuild_points_every_datapoint_at_its_chunk(spark, base):
    catalog, root = base
    index = catalog.read("main").select("id", "embedding_metadata.*")
    chunks = spark.read.parquet(root + "/chunks")
    same = index.join(chunks, ["id", "chunk_gcs_uri", "chunk_line_offset", "source_file"])
    assert same.count() == index.count() == chunks.count() > 3
    offsets = sorted(r[0] for r in chunks.select("chunk_line_offset").collect())
    assert offsets == list(range(len(offsets)))


def test_update_twice_is_update_once_and_keeps_the_model(spark, built):
    catalog, scratch, root = built
    model = models.load_model(spark, root + "/model").stats.first()
    old = ids(catalog)
    run = lambda n: flows.incremental_update(
        catalog, "main", pages(spark, TOPICS[3:]), f"{scratch}/chunks{n}", root + "/artifacts", embedder=SMALL
    )
    run(1)
    once = ids(catalog)
    run(2)
    assert ids(catalog) == once and set(old) < set(once)
    assert models.load_model(spark, root + "/model").stats.first() == model
    whole = IndexCatalog(spark, scratch + "/whole", buckets=4)
    flows.full_rebuild(whole, "main", scratch + "/c", scratch + "/m", pages(spark, TOPICS), embedder=SMALL)
    assert ids(whole) == once


def test_shrinking_page_leaves_its_tail_unless_files_are_replaced(spark, built):
    catalog, scratch, root = built
    before = [i for i in ids(catalog) if "apple" in i]
    short = spark.createDataFrame([("p/apple.html", "<p>apple</p>", "", "")], pages(spark, []).schema)
    update = lambda n, **o: flows.incremental_update(
        catalog, "main", short, f"{scratch}/s{n}", root + "/artifacts", embedder=SMALL, **o
    )
    update(1)
    assert [i for i in ids(catalog) if "apple" in i] == before
    update(2, replace_files=True)
    assert [i for i in ids(catalog) if "apple" in i] == ["p/apple.html_chunk_0"]


def test_stream_takes_every_file_once(spark, built):
    catalog, scratch, root = built
    arrive = lambda topics: pages(spark, topics).write.mode("append").parquet(scratch + "/arrivals")
    run = lambda: incremental.update_from_pages(
        catalog, "main", scratch + "/arrivals", scratch + "/batches", root + "/artifacts", scratch + "/progress", embedder=SMALL
    )
    arrive(TOPICS[3:4])
    run()
    first = ids(catalog)
    assert any("drum" in i for i in first)
    version = catalog.table("main").manifest(spark)[0]
    run()
    assert catalog.table("main").manifest(spark)[0] == version
    arrive(TOPICS[4:])
    run()
    assert set(first) < set(ids(catalog)) and any("forest" in i for i in ids(catalog))


def test_a_batch_that_failed_or_is_repeated(spark, built, monkeypatch):
    """A batch that fails before its commit starts over; one that failed after it changes nothing when it is repeated."""
    catalog, scratch, root = built
    before, version = ids(catalog), catalog.table("main").manifest(spark).version
    handle = incremental.page_batches(catalog, "main", scratch + "/batches", root + "/artifacts", "s", embedder=SMALL)
    batch = pages(spark, TOPICS[3:4])
    with monkeypatch.context() as patch:
        patch.setattr(IndexCatalog, "update", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            handle(batch, 0)
    assert ids(catalog) == before
    handle(batch, 0)
    after = ids(catalog)
    assert set(before) < set(after) and catalog.table("main").manifest(spark).version == version + 1
    monkeypatch.setattr(flows, "chunk_dataset", lambda *_: 1 / 0)  # a repeated batch is not even chunked
    handle(batch, 0)
    assert catalog.table("main").manifest(spark).version == version + 1 and ids(catalog) == after


def test_reused_and_prechunked_datasets(spark, built):
    catalog, scratch, root = built
    jsonl.write_jsonl(spark.read.parquet(root + "/chunks").drop("offset_block"), scratch + "/lines")
    previous, bad = jsonl.read_tolerant(spark, scratch + "/lines", glob="*.json")
    assert bad.count() == 0
    again = IndexCatalog(spark, scratch + "/again", buckets=4)
    flows.full_rebuild(again, "main", scratch + "/chunks-again", scratch + "/model-again", previous=previous, embedder=SMALL)
    assert ids(again) == ids(catalog)
    uris = again.read("main").select("embedding_metadata.chunk_gcs_uri").distinct().collect()
    assert [r[0] for r in uris] == [scratch + "/chunks-again"]
    flows.ingest_chunks(catalog, "main", previous.drop("file_path"), root + "/artifacts", embedder=SMALL)
    assert ids(again) == ids(catalog)


def test_both_ways_to_datapoints_agree(spark, base):
    _, root = base
    chunks, model = spark.read.parquet(root + "/chunks"), models.load_model(spark, root + "/model")
    read = lambda df: sorted(
        (r["id"], tuple(r["sparse_embedding"]["values"]), tuple(r["embedding"])) for r in df.collect()
    )
    assert read(flows.build_datapoints(chunks, model, SMALL)) == read(flows.merged_datapoints(chunks, model, SMALL))


def test_without_model_nothing_enters_the_index(spark, built):
    catalog, scratch, root = built
    before = ids(catalog)
    flows.ingest_chunks(catalog, "main", spark.read.parquet(root + "/chunks"), root + "/artifacts", "missing", SMALL)
    assert ids(catalog) == before


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_questions_find_their_page(spark, base, alpha):
    catalog, root = base
    queries = spark.createDataFrame([(1, "harbor boats"), (2, "mountain")], "qid int, text string")
    prompts = flows.answer_queries(
        catalog, "main", queries, spark.read.parquet(root + "/chunks"), root + "/artifacts",
        embedder=SMALL, options=SearchOptions(k=2, alpha=alpha),
    )
    found = {r["qid"]: r["prompt"] for r in prompts.collect()}
    assert "Context 1: boat harbor" in found[1] and found[1].endswith("Question:\nharbor boats\n\nAnswer:\n")
    assert "cloud mountain" in found[2].split("Context 2")[0]


def test_chunks_of_a_thousand_tables_are_one_scan(spark, scratch):
    """Neighbours in 1,000 tables, in one of two blocks each; one table is gone."""
    rows = spark.range(4000).select(
        (F.col("id") % 1000).alias("t"), F.concat(F.lit(f"{scratch}/all/t="), F.col("id") % 1000).alias("chunk_gcs_uri"),
        F.when(F.col("id") < 2000, F.floor(F.col("id") / 1000)).otherwise(1_000_000 + F.floor(F.col("id") / 1000)).alias("chunk_line_offset"),
        F.concat(F.lit("chunk "), F.col("id")).alias("chunk"),
    )
    blocked = rows.withColumn("offset_block", context.offset_block(F.col("chunk_line_offset")))
    blocked.repartition(4, "t").write.partitionBy("t", "offset_block").parquet(f"{scratch}/all")
    found = rows.where("chunk_line_offset = 1 and t % 2 = 0 or chunk_line_offset = 1000002 and t % 2 = 1").select(
        F.lit(1).alias("qid"), F.col("t").alias("rank"), F.col("chunk").alias("id"), F.struct("chunk_gcs_uri", "chunk_line_offset").alias("metadata")
    )
    gone = spark.createDataFrame([(1, 5000, "x", (f"{scratch}/none", 3))], "qid int, rank long, id string, metadata struct<chunk_gcs_uri string, chunk_line_offset long>")
    found = found.unionByName(gone)
    tables = flows.chunk_tables(found)
    fetched = context.fetch_chunks(found, tables)
    assert sorted((r["id"], r["chunk"]) for r in fetched.collect()) == sorted((r["id"], r["id"]) for r in found.where("id <> 'x'").collect())
    plan = tables._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(tables.inputFiles()) == 1000
    assert flows.chunk_tables(found.where("id = 'x'")).count() == 0


def test_chunks_with_their_terms_are_not_tokenised_again(spark, scratch, monkeypatch):
    """Fit and encoding take the terms that were made once; the index is that of tokenising for each."""
    from skeindex.operators import bm25
    from skeindex.operators.bm25 import Analyzer
    from skeindex.sources.indexes import IndexSettings

    rows = [(f"c{i}", f"word{i % 5} common text", "f", i) for i in range(20)] + [("empty", "", "f", 20)]
    chunks = spark.createDataFrame(rows, "id string, chunk string, source_file string, chunk_line_offset long")
    plain, found = Analyzer(stem=False), []
    termed = flows.termed_chunks(chunks, plain)
    for given in (None, termed):
        if given is not None:
            monkeypatch.setattr(bm25, "with_terms", None)
        root = f"{scratch}/{given is None}"
        catalog = IndexCatalog(spark, root + "/index", buckets=2)
        flows.fit_model(chunks, root + "/model", root + "/artifacts", analyzer=plain, termed=given)
        catalog.create("main", IndexSettings(dims=8))
        flows.ingest_chunks(catalog, "main", chunks, root + "/artifacts", embedder=Embedder(dims=8), analyzer=plain, termed=given)
        found.append(sorted(map(str, catalog.read("main").select("id", "sparse_embedding", "embedding").collect())))
    assert found[0] == found[1] and len(found[0]) == 20


def test_a_search_is_run_once_for_its_result_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    fused = spark.createDataFrame([(1, 1, "a", 0.5, 0.4), (1, 2, "b", 0.4, None)], "qid int, rank int, id string, distance double, sparse_distance double")
    counted = fused.mapInArrow(read, fused.schema)
    index = spark.createDataFrame([("a", ("m",)), ("z", ("n",))], "id string, embedding_metadata struct<x string>")
    from skeindex.operators import search

    rows = search.shape_results(counted, index).orderBy("rank").collect()
    assert [(r["id"], r["metadata"]) for r in rows] == [("a", ("m",)), ("b", None)]
    assert seen.value == 2
