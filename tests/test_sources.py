"""Objects, JSONL, artifacts, merge, keyed tables and indexes."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.spark_queries import QUERIES
from skeindex.operators import ann, bm25, context, merge
from skeindex.plans import flows
from skeindex.schemas import CHUNK
from skeindex.session import shared_dir
from skeindex.sources import artifacts, commits, jsonl, models, objects
from skeindex.sources.commits import names, put_if_absent, read_text
from skeindex.sources.indexes import IndexCatalog, IndexSettings
from skeindex.sources.keyed import Conflict, KeyedTable


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_listing_and_page_scan(spark, tmp_path):
    write(tmp_path / "site/a.html", "<p>a</p>")
    write(tmp_path / "site/deep/Caf%C3%A9 +1.htm", "<p>b\nc</p>")
    write(tmp_path / "site/notes.txt", "no")
    root = f"{tmp_path}/site"
    names = [r["path"].rsplit("/", 1)[-1] for r in objects.list_objects(spark, root).collect()]
    assert len(names) == 3
    prefix = root.lstrip("/")
    known = spark.createDataFrame(
        [(f"{prefix}/a.html", "http://e.example/a", "now")],
        "source_file string, original_url string, scrape_time string",
    )
    pages = {r["source_file"]: r for r in objects.scan_pages(spark, root, known).collect()}
    assert set(pages) == {f"{prefix}/a.html", f"{prefix}/deep/Caf%C3%A9 +1.htm"}
    assert pages[f"{prefix}/a.html"]["original_url"] == "http://e.example/a"
    other = pages[f"{prefix}/deep/Caf%C3%A9 +1.htm"]
    assert (other["html"], other["original_url"], other["scrape_time"]) == ("<p>b\nc</p>", "", "")
    with pytest.raises(ValueError):
        objects.list_objects(spark, root, scheme="gs")


@pytest.mark.parametrize("local", [True, False])
def test_written_objects_are_scanned_whole(spark, scratch, monkeypatch, local):
    """Rows of one key share an object; on a local disk it is put without Spark's writer."""
    if not local:
        monkeypatch.setattr(objects, "local_path", lambda spark, path: None)
    rows = [("a", "<p>\nä"), ("b/ +%", None), ("a", "<p>"), ("c", "")] + [(f"n{i}", f"t{i}") for i in range(700)]
    root = f"{scratch}/objects"
    objects.write_objects(spark.createDataFrame(rows, "key string, html string").repartition(5), root, "key", "html")
    found = {}
    for row in objects.scan_pages(spark, root, glob="*.txt").collect():
        name = row["source_file"].split("key=")[1].removesuffix(".txt") if local else row["source_file"].split("key=")[1].split("/")[0]
        found[name] = row["html"]
    odd = next(n for n in found if n.startswith("b"))
    assert found.pop(odd) == "\n"
    want = {"a": "<p>\n<p>\nä\n", "c": "\n"} | {f"n{i}": f"t{i}\n" for i in range(700)}
    assert found == want


@pytest.mark.parametrize("name", ["scan_pages", "chunk_scanned"])
def test_pages_are_written_to_few_folders(spark, scratch, name):
    """One object a page, but not one folder: each of them has to be listed."""
    rows = [(i, f"http://e.example/{i}", f"<p>page {i}</p>") for i in range(600)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{scratch}/pages.parquet")
    root = f"{shared_dir(spark)}/scratch".removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    got = sorted(r["page_id"] for r in QUERIES[name](spark, scratch).collect())
    (own,) = set(os.listdir(root)) - before
    held = [(folder, sum(f.endswith(".txt") for f in files)) for folder, _, files in os.walk(f"{root}/{own}")]
    held = [n for _, n in held if n]
    assert got == list(range(600)) and sum(held) == 600 and len(held) <= 3


def test_tolerant_and_strict_lines(spark, tmp_path):
    lines = '{"id":"1","chunk":"one"}\n\n   \n{"id":"2","chu\n{"id":"3","chunk":"","text":"three"}\n{"id":"4"}\n'
    write(tmp_path / "d/x.jsonl", lines)
    write(tmp_path / "d/sub/y.jsonl", '{"id":"5","text":"five","extra":7}\n')
    write(tmp_path / "d/z.json", '{"id":"9","chunk":"ignored"}\n')
    good, bad = jsonl.read_tolerant(spark, f"{tmp_path}/d")
    texts = {r["id"]: r["chunk"] for r in bm25.coalesce_text(good).collect()}
    assert texts == {"1": "one", "3": "three", "5": "five"}
    assert [r["line"] for r in bad.collect()] == ['{"id":"2","chu']
    with pytest.raises(Exception):
        jsonl.read_strict(spark, f"{tmp_path}/d").collect()
    assert jsonl.read_strict(spark, f"{tmp_path}/d/sub", None).first()["extra"] == 7


def test_written_lines_leave_out_nulls(spark, tmp_path):
    row = [("1", None, None, ["h"], "c", None, "f", "v1", "u", 0)]
    jsonl.write_jsonl(spark.createDataFrame(row, CHUNK), f"{tmp_path}/out")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '"original_url"' not in text and '"headers":["h"]' in text
    assert jsonl.read_strict(spark, f"{tmp_path}/out", glob="*.json").first()["chunk_line_offset"] == 0
    assert jsonl.datapoint_path("a/b/") == "a/b/batch.json"
    assert jsonl.datapoint_path("a/c.jsonl") == "a/c.jsonl"


def test_artifacts(spark, scratch):
    root = scratch + "/artifacts"
    assert artifacts.latest_uri(artifacts.read_artifacts(spark, root), "m") is None
    for uri, day, state in (("a", 1, "LIVE"), ("b", 3, "DELETED"), ("c", 2, "LIVE")):
        artifacts.register_artifact(spark, root, "m", uri, datetime(2024, 1, day), state)
    rows = artifacts.read_artifacts(spark, root)
    assert artifacts.latest_uri(rows, "m") == "b"
    assert artifacts.live_uri(rows, "m") == "c"
    with pytest.raises(LookupError):
        artifacts.live_uri(rows, "other")


def test_merge(spark):
    chunks = spark.createDataFrame(
        [("a", "t1", "f"), ("a", "t2", "f"), ("b", "t", "f"), ("c", "t", "f"), ("d", "t", "f")],
        "id string, chunk string, source_file string",
    )
    vec = lambda ids, values: {"indices": ids, "values": values}
    sparse = spark.createDataFrame(
        [("a", vec([1], [0.1]), 0), ("a", vec([2, 3], [0.2, 0.3]), 1), ("b", vec([], []), 0),
         (None, vec([9], [0.9]), 0), ("c", vec([4], [0.4]), 0), ("d", None, 0)],
        "id string, sparse_embedding struct<indices array<bigint>, values array<double>>, seq int",
    )
    dense = spark.createDataFrame(
        [("a", [1.0], 1), ("a", [2.0], 0), ("", [5.0], 0)], "id string, embedding array<float>, seq int"
    )
    rows = merge.merge_embeddings(chunks, sparse, dense).collect()
    found = sorted((r["id"], r["sparse_embedding"]["dimensions"], r["embedding"]) for r in rows)
    assert found == [("a", [2, 3], [1.0]), ("a", [2, 3], [1.0]), ("c", [4], None)]
    assert rows[0]["embedding_metadata"].asDict() == {"source_file": "f"} and rows[0]["restricts"] == []


def test_hot_key_keeps_its_last_row(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.array(F.col("id").cast("float")).alias("embedding"),
        F.col("id").alias("seq"),
    )
    last = merge.dedupe_last(rows, "seq")
    assert last.count() == 20_001
    assert last.where("id = 'hot'").first()["embedding"] == [29_997.0]


def test_keyed_table_keeps_readers_on_a_finished_version(spark, scratch):
    store = KeyedTable(scratch + "/t", "id", 4)
    frame = lambda rows: spark.createDataFrame(rows, "id string, v int")
    with pytest.raises(LookupError):
        store.read(spark)
    store.overwrite(frame([(str(i), 0) for i in range(20)]))
    before = store.read(spark)
    assert store.upsert(frame([("3", 1), ("new", 1)])) == 2
    assert store.upsert(frame([])) == 2
    assert before.where("v = 1").count() == 0
    after = store.read(spark)
    assert after.count() == 21 and after.where("v = 1").count() == 2
    # Data of a write that never committed is not seen.
    store._write(frame([("lost", 9)]).withColumn("bucket", store._bucket()))
    assert store.read(spark).count() == 21


def points(spark, rows):
    return spark.createDataFrame(
        [(i, [], [], (f, n), ([1.0], [7]), v) for i, f, n, v in rows],
        "id string, restricts array<string>, numeric_restricts array<string>, "
        "embedding_metadata struct<source_file string, chunk_line_offset bigint>, "
        "sparse_embedding struct<values array<double>, dimensions array<bigint>>, embedding array<float>",
    )


def test_index_life(spark, scratch):
    catalog = IndexCatalog(spark, scratch, buckets=4)
    with pytest.raises(LookupError):
        catalog.update("i", points(spark, [("a", "f", 0, [3.0, 4.0])]))
    assert catalog.create("i", IndexSettings(dims=2))["dims"] == 2
    assert catalog.create("i", IndexSettings(dims=5))["dims"] == 2
    with pytest.raises(ValueError):
        catalog.create("j", IndexSettings(metric="OTHER"))
    catalog.update("i", points(spark, [("a", "f", 0, [9.0, 0.0]), ("a", "f", 1, [3.0, 4.0]), ("b", "f", 2, None)]))
    first = {r["id"]: r["embedding"] for r in catalog.read("i").collect()}
    assert first["a"] == pytest.approx([0.6, 0.8]) and first["b"] is None
    catalog.update("i", points(spark, [("a", "f", 0, [0.0, 2.0]), ("c", "g", 1, [])]))
    second = {r["id"]: r["embedding"] for r in catalog.read("i").collect()}
    assert second == {"a": [0.0, 1.0], "b": None, "c": []}
    with pytest.raises(Exception, match="2 dimensions"):
        catalog.update("i", points(spark, [("d", "g", 1, [1.0, 2.0, 3.0])]))
    catalog.update("i", points(spark, [("z", "f", 0, [1.0, 0.0])]), replace_files=True)
    assert sorted(r["id"] for r in catalog.read("i").collect()) == ["c", "z"]
    catalog.update("i", points(spark, [("q", "f", 0, [1.0, 0.0])]), overwrite=True)
    assert [r["id"] for r in catalog.read("i").collect()] == ["q"]


def test_neighbour_replies_and_lookup(spark):
    reply = (
        '{"nearestNeighbors":[{"id":"query_0","neighbors":['
        '{"distance":0.9,"sparse_distance":0.1,"datapoint":{"datapointId":"x","embeddingMetadata":{"chunk_gcs_uri":"u","chunk_line_offset":1}}},'
        '{"distance":0.8,"datapoint":{"datapointId":"y","embeddingMetadata":{"chunk_line_offset":0}}},'
        '{"distance":0.7,"datapoint":{"datapointId":"past","embeddingMetadata":{"chunk_gcs_uri":"u","chunk_line_offset":9}}},'
        '{"distance":0.6,"datapoint":{"datapointId":"empty","embeddingMetadata":{"chunk_gcs_uri":"u","chunk_line_offset":2}}},'
        '{"distance":0.5,"datapoint":{"datapointId":"z","embeddingMetadata":{"chunk_gcs_uri":"u","chunk_line_offset":0}}}]},'
        '{"id":"query_1","neighbors":[{"distance":1.0}]}]}'
    )
    replies = spark.createDataFrame([(1, reply), (2, '{"nearestNeighbors":[]}'), (3, "{}")], "qid int, body string")
    found = context.parse_neighbors(replies)
    assert [(r["rank"], r["id"]) for r in found.orderBy("rank").collect()] == [
        (1, "x"), (2, "y"), (3, "past"), (4, "empty"), (5, "z"),
    ]
    chunks = spark.createDataFrame(
        [("u", 0, "zero"), ("u", 1, "one"), ("u", 2, "")],
        "chunk_gcs_uri string, chunk_line_offset bigint, chunk string",
    )
    built = context.build_context(context.fetch_chunks(found, chunks))
    assert built.first()["context"] == "Context 1: one\nContext 2: zero"
    asked = spark.createDataFrame([(1, "why?")], "qid int, text string")
    prompt = context.build_prompts(built, asked).first()["prompt"]
    assert prompt.endswith("Context 1: one\nContext 2: zero\n\nQuestion:\nwhy?\n\nAnswer:\n")


def test_chunk_store_is_read_by_block(spark, scratch):
    chunks = spark.range(50).select(
        F.lit("u").alias("chunk_gcs_uri"), (F.col("id") * 300_000).alias("chunk_line_offset"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("chunk"),
    )
    jsonl.write_chunk_store(chunks, scratch + "/store")
    pointers = spark.createDataFrame(
        [(1, 1, "i", ("u", 300_000)), (1, 2, "j", ("u", 9_000_000))],
        "qid int, rank int, id string, metadata struct<chunk_gcs_uri string, chunk_line_offset bigint>",
    )
    fetched = context.fetch_chunks(pointers, spark.read.parquet(scratch + "/store"))
    assert sorted(r["chunk"] for r in fetched.collect()) == ["c1", "c30"]
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    assert "offset_block" in plan.split("PartitionFilters: [")[1].split("]")[0]


def keyed_rows(spark, ids, value):
    return spark.createDataFrame([(str(i), value, f"g{i % 3}") for i in ids], "id string, v string, g string")


def test_bucket_count_is_kept_with_the_table(spark, scratch):
    KeyedTable(scratch + "/t", "id", 4).overwrite(keyed_rows(spark, range(50), "a"))
    other = KeyedTable(scratch + "/t", "id", 16)
    other.upsert(keyed_rows(spark, range(0, 50, 5), "b"))
    rows = other.read(spark).collect()
    assert len(rows) == 50 and sum(r["v"] == "b" for r in rows) == 10 and {r["bucket"] for r in rows} <= set(range(4))


def test_dead_commits_do_not_block(spark, scratch):
    import os

    table = KeyedTable(scratch + "/t", "id", 4)
    table.overwrite(keyed_rows(spark, range(5), "a"))
    folder = scratch + "/t/commits/000000000"
    with open(f"{folder}/.half-written", "w") as dead:
        dead.write("{")
    os.makedirs(scratch + "/t/commits/000000001")  # of a writer that died before it named its version
    assert table.manifest(spark).version == 1
    assert table.upsert(keyed_rows(spark, [1], "b")) == 2
    assert sorted(r["v"] for r in table.read(spark).collect()) == ["a"] * 4 + ["b"]


@pytest.mark.parametrize("first", ["overwrite", "upsert"])
def test_of_two_writers_one_succeeds(spark, scratch, first):
    """Both have read version 1; in either order the first to commit wins, and what it wrote stays."""
    table = KeyedTable(scratch + "/t", "id", 4)
    table.overwrite(keyed_rows(spark, range(5), "a"))
    before = table.manifest(spark)
    writers = {
        "overwrite": lambda: table.overwrite(keyed_rows(spark, range(3), "o"), before=before),
        "upsert": lambda: table.upsert(keyed_rows(spark, [1], "u"), before=before),
    }
    second = next(w for w in writers if w != first)
    assert writers[first]() == 2
    finished = table.manifest(spark)
    rows = sorted(map(tuple, table.read(spark).collect()))
    with pytest.raises(Conflict):
        writers[second]()
    assert table.manifest(spark) == finished and sorted(map(tuple, table.read(spark).collect())) == rows
    assert {r[1] for r in rows} == ({"o"} if first == "overwrite" else {"a", "u"})


def test_many_writers_of_one_name(spark, scratch):
    """Threads that put the same name at once: exactly one is told that it did, and its text stays."""
    from concurrent.futures import ThreadPoolExecutor

    for turn in range(5):
        path = f"{scratch}/log/{turn}.json"
        with ThreadPoolExecutor(8) as pool:
            told = list(pool.map(lambda i: put_if_absent(spark, path, str(i)), range(8)))
        assert told.count(True) == 1 and read_text(spark, path) == str(told.index(True))
    assert sorted(names(spark, f"{scratch}/log")) == [f"{i}.json" for i in range(5)]


def test_the_log_goes_on_in_the_next_folder(spark, scratch, monkeypatch):
    monkeypatch.setattr(commits, "PER_FOLDER", 3)
    log = commits.CommitLog(spark, scratch + "/log")
    assert log.newest() == 0
    for version in range(1, 9):
        log.commit(version, {"n": version})
        assert log.newest() == version and log.read(version) == {"n": version}
    with pytest.raises(Conflict):
        log.commit(8, {"n": 0})


def folder_bytes(path):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_an_upsert_writes_its_batch_only(spark, scratch):
    table = KeyedTable(scratch + "/t", "id", 4)
    wide = lambda ids, v: keyed_rows(spark, ids, v).withColumn("pad", F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.md5(F.concat("id", i.cast("string"))))))
    table.overwrite(wide(range(2000), "a"))
    base, want = folder_bytes(scratch + "/t/data"), {str(i): "a" for i in range(2000)}
    rng = random.Random(3)
    for number in range(4):
        before = folder_bytes(scratch + "/t/data")
        ids = rng.sample(range(2100), 20)
        table.upsert(wide(ids, f"b{number}"))
        want |= {str(i): f"b{number}" for i in ids}
        assert folder_bytes(scratch + "/t/data") - before < 0.1 * base
        assert {r["id"]: r["v"] for r in table.read(spark).collect()} == want
    assert max(map(len, table.manifest(spark).layers.values())) == 5
    # Rows that an update removes, then bring back, across layers.
    table.upsert(wide([0], "c").withColumn("g", F.lit("g0")), "g")
    want = {k: v for k, v in want.items() if int(k) % 3} | {"0": "c"}
    assert {r["id"]: r["v"] for r in table.read(spark).collect()} == want
    table.upsert(wide([3], "d"))
    want["3"] = "d"
    rows = sorted(map(tuple, table.read(spark).collect()))
    assert {r[0]: r[1] for r in rows} == want
    version = table.compact(spark)
    assert set(map(len, table.manifest(spark).layers.values())) == {1}
    assert sorted(map(tuple, table.read(spark).collect())) == rows
    assert table.compact(spark) == version
    assert len(table.unused(spark, keep_versions=1)) == 7 and table.unused(spark, keep_versions=20) == []


def test_a_repeated_batch_commits_nothing(spark, scratch):
    table = KeyedTable(scratch + "/t", "id", 4)
    assert table.upsert(keyed_rows(spark, range(5), "a"), batch=("s", 0)) == 1
    assert table.upsert(keyed_rows(spark, range(2), "b"), batch=("s", 1)) == 2
    assert table.upsert(keyed_rows(spark, range(2), "again"), batch=("s", 1)) == 2
    assert table.applied(spark, ("s", 0)) and not table.applied(spark, ("s", 2)) and not table.applied(spark, ("other", 0))
    assert table.upsert(keyed_rows(spark, [4], "c"), batch=("other", 0)) == 3
    assert {r["id"]: r["v"] for r in table.read(spark).collect()} == {"0": "b", "1": "b", "2": "a", "3": "a", "4": "c"}


def test_readers_get_rows_with_their_own_cells(spark, scratch):
    """Cells are trained while a reader has a version open, and an update that has read older cells is refused."""
    catalog = IndexCatalog(spark, scratch, buckets=2)
    catalog.create("i", IndexSettings(dims=2))
    catalog.update("i", points(spark, [(str(k), "f", k, [1.0, float(k)]) for k in range(20)]))
    cells = lambda *ys: spark.createDataFrame([(0, [0.0, 0.0], i, [1.0, y]) for i, y in enumerate(ys)], ann.CELLS)
    catalog.set_cells("i", cells(0.0, 5.0))
    before = catalog.table("i").manifest(spark)
    catalog.set_cells("i", cells(0.1, 0.2, 9.0))
    after = catalog.table("i").manifest(spark)
    for version, n in ((before, 2), (after, 3)):
        centroids, rows = catalog.centroids("i", version), catalog.read_cells("i", version)
        assert centroids.count() == n
        own = ann.assign_cells(rows.select("id", "embedding", F.col("cell").alias("was")), centroids)
        assert own.where("not (was <=> cell)").count() == 0 and own.count() == 20
    with pytest.raises(Conflict):
        catalog.set_cells("i", cells(4.0), before)
    assert catalog.centroids("i").count() == 3
    catalog.update("i", points(spark, [("new", "f", 0, [0.0, 1.0])]))
    assert catalog.read_cells("i").where("id = 'new'").first()["cell"] == 1


def test_empty_tables_and_unused_folders(spark, scratch):
    table = KeyedTable(scratch + "/t", "id", 4)
    none = keyed_rows(spark, range(3), "a").limit(0)
    assert table.upsert(none) == 0 and not table.exists(spark)
    assert table.overwrite(none) == 1 and table.exists(spark)
    assert table.read(spark).count() == 0 and set(table.read(spark).columns) == {"id", "v", "g", "bucket"}
    table.overwrite(keyed_rows(spark, range(3), "a"))
    table.overwrite(none)
    assert table.unused(spark, keep_versions=2) == []
    assert len(table.unused(spark, keep_versions=1)) == 1
    assert table.read(spark).count() == 0


def test_groups_are_replaced_within_their_bucket(spark, scratch):
    table = KeyedTable(scratch + "/t", "id", 4, by="g")
    table.overwrite(keyed_rows(spark, range(30), "a"))
    table.upsert(keyed_rows(spark, [0, 3, 33], "b"), "g")
    rows = {r["id"]: r["v"] for r in table.read(spark).collect()}
    assert {k for k, v in rows.items() if v == "b"} == {"0", "3", "33"}
    assert {k for k, v in rows.items() if v == "a"} == {str(i) for i in range(30) if i % 3}


def test_of_two_models_the_greatest_name_counts(spark, scratch):
    for name, n in (("m1", 1), ("m2", 2)):
        docs = spark.createDataFrame([(str(i), f"w{i} common") for i in range(n)], "id string, chunk string")
        flows.fit_model(docs, f"{scratch}/{name}")
    model = models.load_model(spark, scratch)
    assert model.stats.count() == 1 and model.stats.first()["n_docs"] == 2
    assert model.df.count() == 3


def test_saved_lines_are_dealt_by_their_number(spark, tmp_path):
    """The files of lines grow with the rows; lines stay in the order of their ids over the files."""
    from checks import spark_queries

    rows = [(i, f"text {i}", "en", "src1" if i % 9 == 0 else "src2", 8) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = spark_queries._saved_lines(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    names = sorted(n for n in os.listdir(path.removeprefix("file:")) if n.startswith("part-"))
    assert len(names) > 4
    lines = [line for n in names for line in open(f"{path.removeprefix('file:')}/{n}")]
    assert [int(line.split('"id":"')[1].split('"')[0]) for line in lines if line.rstrip().endswith("}")] == [i for i in range(400) if i % 9]
