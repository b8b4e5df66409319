"""Dense search, approximate search, fusion."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeindex.operators import ann, dense, quantise, search
from skeindex.operators.bm25 import Analyzer

PLAIN = Analyzer(stem=False, stop_words=())


def random_vectors(spark, n=400, d=16, seed=3):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, d)).round(3)
    data[n // 2 : n // 2 + n // 3] = data[0]  # a third of all rows are copies
    rows = [(f"v{i:04}", [float(x) for x in data[i]]) for i in range(n)]
    rows += [("none", None), ("failed", [])]
    queries = [(q, [float(x) for x in rng.normal(size=d).round(3)]) for q in range(5)]
    queries.append((5, rows[0][1]))
    index = spark.createDataFrame(rows, "id string, embedding array<double>").repartition(5)
    return index, spark.createDataFrame(queries, "qid int, dense array<double>"), rows, queries


def brute(rows, queries, k, metric):
    out = []
    for qid, q in queries:
        q = np.array(q)
        scored = []
        for i, v in rows:
            if v:
                v = np.array(v)
                score = {
                    "dot": v @ q,
                    "cosine": v @ q / np.linalg.norm(v) / np.linalg.norm(q),
                    "l2": -np.linalg.norm(v - q),
                }[metric]
                scored.append((-round(float(score), 6), i))
        out += [(qid, rank + 1, i) for rank, (_, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 400])
def test_dense_topk_against_brute_force(spark, metric, limit):
    index, queries, rows, asked = random_vectors(spark)
    found = search.dense_topk(index, queries, 7, metric, limit).collect()
    assert sorted((r["qid"], r["rank"], r["id"]) for r in found) == brute(rows, asked, 7, metric)


@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 400])
def test_approximate_search_over_all_cells_is_exact(spark, limit):
    index, queries, rows, asked = random_vectors(spark)
    centroids = ann.train_cells(index, leaf_size=25)
    assigned = ann.assign_cells(index, centroids)
    found = ann.ann_topk(assigned, centroids, queries, 7, "dot", 100, limit).collect()
    assert sorted((r["qid"], r["rank"], r["id"]) for r in found) == brute(rows, asked, 7, "dot")


def clustered(spark, groups=20, each=40, d=12):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(groups, d)) * 4
    data = [[float(x) for x in c + rng.normal(size=d)] for c in centres for _ in range(each)]
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, embedding array<double>")


def recall(found, exact):
    return found.join(exact, ["qid", "id"], "left_semi").count() / exact.count()


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
def test_quantised_recall_on_clusters(spark, metric):
    """With the default share of cells and the default shortlist; codes alone would find far fewer."""
    index = clustered(spark, 100, 60, 32)
    queries = index.where("id % 11 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("dense"))
    centroids, codebooks = ann.train_cells(index, leaf_size=60), quantise.train_codebooks(index)
    coded = quantise.with_codes(ann.assign_cells(index, centroids), codebooks).cache()
    found = quantise.quantised_topk(coded, centroids, codebooks, queries, 10, metric)
    exact = search.dense_topk(index, queries, 10, metric)
    share = recall(found, exact)
    print(f"recall@10, {metric}, 10 percent of {centroids.count()} cells, shortlist of 150: {share:.3f}")
    assert share >= 0.9
    same = found.join(exact.withColumnRenamed("score", "exact"), ["qid", "id"]).where("abs(score - exact) > 2e-6")
    assert same.count() == 0


@pytest.mark.parametrize("probe_pct, least", [(10, 0.3), (75, 0.9)])
def test_recall_on_vectors_without_clusters(spark, probe_pct, least):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    index = rows.select(F.col("vec_id").alias("id"), "embedding")
    queries = rows.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("dense"))
    centroids, codebooks = ann.train_cells(index, leaf_size=50), quantise.train_codebooks(index)
    coded = quantise.with_codes(ann.assign_cells(index, centroids), codebooks).cache()
    exact = search.dense_topk(index, queries, 10).cache()
    plain = recall(ann.ann_topk(coded, centroids, queries, 10, probe_pct=probe_pct), exact)
    short = recall(quantise.quantised_topk(coded, centroids, codebooks, queries, 10, probe_pct=probe_pct), exact)
    print(f"recall@10 at {probe_pct} percent of {centroids.count()} cells: {plain:.3f}, with a shortlist of 150: {short:.3f}")
    assert plain > least and short > plain - 0.03


def test_codes_name_the_nearest_entries(spark):
    index = clustered(spark, 5, 30, 10)  # ten dimensions: parts of four, four and two
    books = quantise.load_codebooks(codebooks := quantise.train_codebooks(index))
    assert [b.shape[1] for b in books] == [4, 4, 2] and all(len(b) <= 256 for b in books)
    rows = index.unionByName(spark.createDataFrame([(-1, None), (-2, []), (-3, [float("nan")] * 10), (-4, [1.0])], index.schema))
    for r in quantise.with_codes(rows, codebooks).collect():
        if r["id"] < 0:
            assert r["codes"] is None and r["length"] is None
            continue
        v, at = np.array(r["embedding"]), 0
        assert r["length"] == pytest.approx(np.linalg.norm(v))
        for code, book in zip(r["codes"], books):
            gaps = ((book - v[at : at + book.shape[1]]) ** 2).sum(axis=1)
            assert gaps[code] == pytest.approx(gaps.min())
            at += book.shape[1]


def test_copies_are_one_entry_and_one_cell(spark):
    """A third of all rows is one vector; a part with few different values has as many entries."""
    rows = [(i, [1.0, 2.0, 0.0, 1.0]) for i in range(300)] + [(i, [float(i % 7), 0.0, float(i % 3), 5.0]) for i in range(300, 900)]
    index = spark.createDataFrame(rows, "id int, embedding array<double>")
    centroids, codebooks = ann.train_cells(index, leaf_size=20), quantise.train_codebooks(index)
    assert len(quantise.load_codebooks(codebooks)[0]) == 22 and centroids.count() <= 22
    coded = quantise.with_codes(ann.assign_cells(index, centroids), codebooks)
    assert coded.where("id < 300").select("cell", "codes").distinct().count() == 1


def test_training_takes_as_many_jobs_for_many_parents(spark):
    index, jobs = clustered(spark, 40, 30, 8), []
    for leaf, name in ((60, "few"), (5, "many")):
        spark.sparkContext.setJobGroup(name, name)
        centroids = ann.train_cells(index, leaf_size=leaf, iterations=3, limit=960)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
        parents = centroids.select("parent").distinct().count()
        print(name, parents, "parents", centroids.count(), "cells", jobs[-1], "jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert parents > 10 and jobs[1] <= jobs[0] * 1.2


@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 1000])
def test_recall_on_clusters_with_one_and_two_levels(spark, limit):
    index = clustered(spark)
    centroids = ann.train_cells(index, leaf_size=40, limit=limit).cache()
    assert centroids.count() >= 18
    assert (centroids.select("parent").distinct().count() > 1) == (limit == 1000)
    assigned = ann.assign_cells(index, centroids, limit).cache()
    assert assigned.where("cell is null").count() == 0 and assigned.count() == index.count()
    queries = index.select(F.col("id").alias("qid"), F.col("embedding").alias("dense"))
    found = ann.ann_topk(assigned, centroids, queries, 10, "l2", 20)
    exact = search.dense_topk(index, queries, 10, "l2")
    assert recall(found, exact) >= 0.9


def test_bad_vectors_hide_nothing(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.5, 0.0]), ("n", [float("nan"), 1.0]), ("i", [float("inf"), 1.0]), ("z", None)]
    index = spark.createDataFrame(rows, "id string, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, dense array<double>")
    assert [r["id"] for r in search.dense_topk(index, queries, 5).orderBy("rank").collect()] == ["a", "b"]
    mixed = queries.unionByName(spark.createDataFrame([(2, [1.0])], "qid int, dense array<double>"))
    with pytest.raises(ValueError):
        search.dense_topk(index, mixed, 5)
    with pytest.raises(ValueError):
        search.dense_topk(index, mixed, 5, limit=10)


@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 60])
def test_repeated_ids_compete(spark, limit):
    vector = "struct<indices array<bigint>, values array<double>>"
    rows = [("a", ([1], [0.4])), ("b", ([1], [0.6])), ("a", ([1], [0.5])), ("c", ([2], [9.0]))] + [("b", ([1], [0.3]))] * 20
    index = spark.createDataFrame(rows, f"id string, sparse_embedding {vector}")
    terms = spark.createDataFrame([(q, 1, 1.0) for q in range(5)] + [(9, 7, 1.0)], "qid int, term_id long, weight double")
    found = search.sparse_topk_rows(index, terms, 2, limit).where("qid = 3").orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in found] == [("b", 0.6), ("a", 0.5)]


def test_a_repeated_id_hides_no_other_in_a_later_slice():
    top = search.RunningTop(1, 2)
    for rows in ([("a", 0.2), ("b", 0.1)], [("c", 0.9), ("c", 0.8), ("d", 0.7)]):
        top.offer(np.array([[score for _, score in rows]]), pa.array([key for key, _ in rows]))
    assert (top.ids, top.scores) == ([["c", "d"]], [[0.9, 0.7]])


def test_hot_ids_over_many_slices_against_brute_force():
    rng = np.random.default_rng(5)
    scores = np.round(rng.normal(size=(6, 3000)), 2)
    ids = np.where(rng.random(3000) < 0.4, 7, rng.integers(0, 300, 3000))
    scores[:, ids == 7] += 2
    top = search.RunningTop(6, 10)
    for i in range(0, 3000, 250):
        top.offer(scores[:, i : i + 250], pa.array(ids[i : i + 250]))
    for q in range(6):
        best = {}
        for key, score in zip(ids.tolist(), scores[q].tolist()):
            best[key] = max(score, best.get(key, score))
        assert list(zip(top.ids[q], top.scores[q])) == sorted(best.items(), key=lambda x: (-x[1], x[0]))[:10]


def ranked(spark, rows):
    return spark.createDataFrame(rows, "qid int, rank int, id string, score double")


def test_fusion_weights(spark):
    left = ranked(spark, [(1, 1, "a", 0.9), (1, 2, "b", 0.8), (1, 3, "c", 0.7)])
    right = ranked(spark, [(1, 1, "c", 5.0), (1, 2, "d", 4.0)])
    order = lambda alpha, k=10: [
        r["id"]
        for r in search.reciprocal_rank_fusion(left, right, k, alpha).orderBy("rank").collect()
    ]
    assert order(1.0) == ["a", "b", "c"]
    assert order(0.0) == ["c", "d"]
    assert order(0.5) == ["c", "a", "b", "d"]
    first = search.reciprocal_rank_fusion(left, right, 1).first()
    assert first["rrf"] == pytest.approx(0.5 / 63 + 0.5 / 61, abs=1e-9)
    assert (first["distance"], first["sparse_distance"]) == (0.7, 5.0)


def test_model_registry_and_failures(spark):
    def load(role):
        def model(texts):
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return [[float(len(t)), 1.0 if role == dense.DOCUMENT else 2.0] for t in texts]

        return model

    registry = dense.ModelRegistry().register("hosted", load).register("tiny", load)
    assert registry.resolve("my-text-embedding-1") is load and registry.resolve("tiny") is load
    with pytest.raises(KeyError):
        registry.resolve("unknown")
    df = spark.createDataFrame([("a", "xy"), ("b", "bad"), ("c", "xyz")], "id string, chunk string")
    found = {r["id"]: (r["embedding"], r["embedding_error"]) for r in dense.embed(df, load).collect()}
    asked = dense.embed(df.where("id = 'a'"), load, "chunk", dense.QUERY).first()
    assert asked["embedding"] == [2.0, 2.0]
    assert found == {"a": ([2.0, 1.0], None), "b": ([], "no"), "c": ([3.0, 1.0], None)}


def test_hashed_embedder(spark):
    df = spark.createDataFrame([("a", "x y x"), ("b", ""), ("c", "y x x")], "id string, chunk string")
    found = {r["id"]: r["embedding"] for r in dense.hash_embed(df, "chunk", 32, PLAIN).collect()}
    assert all(len(v) == 32 for v in found.values())
    assert np.linalg.norm(found["a"]) == pytest.approx(1.0, abs=1e-6)
    assert found["a"] == found["c"] and set(found["b"]) == {0.0}


def test_unit_norm_leaves_zero_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0]), ("z", [0.0, 0.0])], "id string, embedding array<double>")
    found = {r["id"]: r["embedding"] for r in dense.l2_normalize(df).collect()}
    assert found == {"a": [0.6, 0.8], "z": [0.0, 0.0]}


def test_many_blocks_of_queries_read_the_index_once(spark):
    """Blocks read what the index holds of the terms asked for; a bitmap that is crowded only keeps more."""
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, ([i % 50, 1000 + i % 7, -5], [1.0 + i % 3, 0.5, float("nan") if i % 11 == 0 else 0.25])) for i in range(600)] + [(601, None), (602, ([], []))]
    plain = spark.createDataFrame(rows, "id long, sparse_embedding struct<indices array<bigint>, values array<double>>").repartition(3)
    index = plain.mapInArrow(read, plain.schema)
    asked = [(q, t, 1.0 + q) for q in range(40) for t in (q, 1000 + q % 9, 77, -5 if q % 2 else 5000)]
    terms = spark.createDataFrame(asked, "qid int, term_id long, weight double")
    whole = sorted(search.sparse_topk_rows(plain, terms, 5).collect())
    for limit in (1500,):
        seen.value = 0
        assert sorted(search.sparse_topk_rows(index, terms, 5, limit).collect()) == whole
        assert seen.value == 602


def test_crowded_cells_are_dealt_to_many_tasks(spark, monkeypatch):
    """Tasks grow with the pairs to score; slices of few queries give the same lists."""
    index, queries, rows, asked = random_vectors(spark)
    centroids = spark.createDataFrame([(0, [1.0] * 16, 0, [1.0] * 16)], ann.CELLS)
    assigned = ann.assign_cells(index, centroids)
    monkeypatch.setattr(ann, "TASK_PAIRS", 100)
    monkeypatch.setattr(search, "QUERY_ROWS", 2)
    pairs = queries.select("qid", F.lit(0).alias("cell"))
    schema = search.found_schema(queries, assigned)
    found = ann._search_cells(assigned, queries, pairs, 7, "dot", 16, schema)
    assert found.rdd.getNumPartitions() >= 400 * len(asked) // 100
    found = ann.ann_topk(assigned, centroids, queries, 7).collect()
    assert sorted((r["qid"], r["rank"], r["id"]) for r in found) == brute(rows, asked, 7, "dot")
