"""The inverted index against scoring every document, and how much of it a search reads."""

import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeindex.sources import postings
from skeindex.sources.postings import PostingStore

VECTOR = "struct<indices array<bigint>, values array<double>>"


def by_hand(rows, terms, k):
    queries = {}
    for qid, term, weight in terms:
        queries.setdefault(qid, []).append((term, weight))
    want = {}
    for qid, asked in queries.items():
        best = {}
        for key, vector in rows:
            if vector is None:
                continue
            own = dict(zip(*vector))
            shared = [own[t] * w for t, w in asked if t in own]
            if shared:
                score = round(sum(shared), 6)
                best[key] = max(score, best.get(key, score))
        want[qid] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return want


def searched(found):
    out = {}
    for r in found.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append((r["id"], r["score"]))
    return out


def same(got, want):
    assert set(got) == {q for q, of in want.items() if of}
    for q, of in got.items():
        assert [s for _, s in of] == pytest.approx([s for _, s in want[q]], abs=2e-6)
        assert [i for i, _ in of] == [i for i, _ in want[q]]


def random_rows(rng, n, ids, terms=60):
    rows = []
    for _ in range(n):
        own = sorted(set(rng.zipf(1.5, 12).tolist()) & set(range(terms)))
        rows.append((int(rng.integers(0, ids)), (own, np.round(rng.random(len(own)) * 4, 2).tolist())))
    return rows


@pytest.mark.parametrize("limit", [1 << 26, 200])
@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_scoring_all(spark, scratch, seed, limit):
    rng = np.random.default_rng(seed)
    rows = random_rows(rng, 400, 250) + [(7, None), (8, ([], [])), (9, ([3], [float("nan")]))]
    terms = [(q, int(t), float(np.round(rng.normal(0.5, 1), 2))) for q in range(12) for t in {*rng.integers(1, 20, 4).tolist()}]
    terms += [(50, 99_999, 1.0)]
    store = PostingStore(f"{scratch}/{uuid.uuid4().hex}", buckets=4)
    store.write(spark.createDataFrame(rows, f"id long, sparse_embedding {VECTOR}").repartition(3), slice_docs=16)
    asked = spark.createDataFrame(terms, "qid int, term_id long, weight double")
    clean = [(i, None if v is None else tuple(zip(*[(t, x) for t, x in zip(*v) if np.isfinite(x)])) or ((), ())) for i, v in rows]
    same(searched(store.search(asked, 5, limit, seeds=2)), by_hand(clean, terms, 5))


def test_blocks_that_cannot_matter_are_not_read(spark, scratch):
    """Documents come in order of weight, as from sources of different kinds: most slices stay closed."""
    rows = [(i, ([1, 2 + i % 5, 100 + i], [1.0 - i / 4000, 0.5, 0.1])) for i in range(3000)]
    index = spark.createDataFrame(rows, f"id long, sparse_embedding {VECTOR}").coalesce(1)
    store = PostingStore(f"{scratch}/postings", buckets=8)
    store.write(index, slice_docs=100)
    asked = spark.createDataFrame([(0, 1, 1.0), (0, 2, 0.1), (1, 2500, 1.0)], "qid int, term_id long, weight double")
    reads = store.reads(asked, 10).first()
    assert reads["postings"] == 9000 and reads["asked"] == 3000 + 600 + 1
    assert reads["read"] < 0.2 * reads["asked"] and reads["read"] < 0.1 * reads["postings"]
    same(searched(store.search(asked, 10)), by_hand(rows, [(0, 1, 1.0), (0, 2, 0.1), (1, 2500, 1.0)], 10))
    opened = {f.rsplit("bucket=", 1)[1].split("/")[0] for f in store.blocks(spark, asked).inputFiles()}
    plan = store.blocks(spark, asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan and len(opened) <= 8


def test_ties_go_to_the_smaller_id_across_slices(spark, scratch):
    rows = [(f"d{i:03}", ([1], [0.5])) for i in reversed(range(200))]
    store = PostingStore(f"{scratch}/ties", buckets=2)
    store.write(spark.createDataFrame(rows, f"id string, sparse_embedding {VECTOR}").coalesce(1), slice_docs=10)
    asked = spark.createDataFrame([("q", 1, 1.0)], "qid string, term_id long, weight double")
    assert [i for i, _ in searched(store.search(asked, 4))["q"]] == ["d000", "d001", "d002", "d003"]


def test_an_empty_index_finds_nothing(spark, scratch):
    store = PostingStore(f"{scratch}/none", buckets=2)
    store.write(spark.createDataFrame([], f"id long, sparse_embedding {VECTOR}"))
    asked = spark.createDataFrame([(1, 1, 1.0)], "qid int, term_id long, weight double")
    assert store.search(asked, 4).count() == 0
    assert store.search(asked.limit(0), 4).count() == 0


@pytest.mark.parametrize("entries", [7, 4_000_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_slice_meets_all_its_queries_at_once(monkeypatch, seed, entries):
    """Repeated ids, a missing one, terms that a query repeats or that the slice lacks, scores that are not finite."""
    monkeypatch.setattr(postings, "SCORE_ENTRIES", entries)
    rng = np.random.default_rng(seed)
    ids = [None if i == 3 else f"d{rng.integers(0, 12)}" for i in range(20)]
    lists = {int(t): sorted(rng.choice(20, rng.integers(1, 15), replace=False).tolist()) for t in rng.permutation(9)}
    weights = {t: np.round(rng.normal(1, 1, len(at)), 1) for t, at in lists.items()}
    weights[4][0] = np.inf
    asked = [(f"q{rng.integers(0, 8)}", int(rng.integers(0, 12)), float(np.round(rng.normal(1, 1), 1))) for _ in range(60)]
    asked += [("none", 11, 1.0), ("other", 1, 1.0)]
    blocks = pa.table({"term_id": pa.array(list(lists)), "at": pa.array(list(lists.values()), pa.list_(pa.int32())), "weights": pa.array(list(weights.values()))})
    terms = pa.table({"qid": [q for q, _, _ in asked], "term_id": [t for _, t, _ in asked], "weight": [w for _, _, w in asked]})
    qids = sorted({q for q, _, _ in asked} - {"other"}, reverse=True)
    got = postings._slice_top(blocks, pa.array(ids), pa.array(qids), postings._by_query(terms), 4).to_pylist()
    for qid in qids:
        scores = {}
        for q, term, factor in asked:
            for place, weight in zip(lists.get(term, []), weights.get(term, [])):
                if q == qid:
                    scores[place] = scores.get(place, 0.0) + factor * weight
        best = {}
        for place, score in scores.items():
            if np.isfinite(score):
                best[ids[place]] = max(round(score, 6), best.get(ids[place], -np.inf))
        want = sorted(((-s, i is not None, i or "", i) for i, s in best.items()))[:4]
        assert [r["id"] for r in got if r["qid"] == qid] == [x[-1] for x in want]
        assert [r["score"] for r in got if r["qid"] == qid] == pytest.approx([-x[0] for x in want], abs=2e-6)


def test_weights_are_computed_once_for_the_slices(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, None)], "id long, terms array<bigint>")
    vector = F.struct(F.col("terms").alias("indices"), F.transform("terms", lambda t: t / 2.0).alias("values"))
    made = postings.slice_blocks(rows.select("id", vector.alias("sparse_embedding")), 16)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("transform(") == 1
    (ids,) = made.where("term_id is null").collect()
    assert ids["ids"] == [1]
    assert {(r["term_id"], *r["weights"]) for r in made.where("term_id is not null").collect()} == {(1, 0.5), (2, 1.0)}
