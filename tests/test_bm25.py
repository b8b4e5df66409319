"""BM25: stems, counts, weights, storage."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skeindex.functions.stem import Stems, stem, stems, stems_of_lists
from skeindex.operators import bm25, search
from skeindex.operators.bm25 import Analyzer
from skeindex.sources import models

PLAIN = Analyzer(stem=False, stop_words=())
TEXTS = {
    "d1": "red fish, blue fish",
    "d2": "Red red boat; the boat",
    "d3": "...",
    "d4": "green",
}


def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id string, chunk string")


@pytest.mark.parametrize(
    "word, expected",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("gas", "gas"),
        ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"),
        ("hopping", "hop"), ("hoping", "hope"), ("falling", "fall"), ("happy", "happi"),
        ("say", "say"), ("relational", "relat"), ("rational", "ration"), ("digitizer", "digit"),
        ("generalization", "general"), ("hopefulness", "hope"), ("consignment", "consign"),
        ("adoption", "adopt"), ("controlling", "control"), ("rate", "rate"), ("knightly", "knight"),
        ("skies", "sky"), ("news", "news"), ("generously", "generous"), ("running", "run"),
    ],
)
def test_stems(word, expected):
    assert stem(word) == expected


def test_counts_and_statistics(spark):
    model = bm25.fit(docs(spark), PLAIN)
    stats = model.stats.first()
    assert (stats["n_docs"], stats["k1"], stats["b"]) == (3, 1.2, 0.75)
    assert stats["avgdl"] == pytest.approx(10 / 3)
    by_id = {r["id"]: r["df"] for r in model.df.select(F.col("term_id").alias("id"), "df").collect()}
    ids = {w: spark.sql("select 1").select(bm25.term_id(F.lit(w)).alias("t")).first()["t"]
           for w in ("red", "fish", "boat")}
    assert {w: by_id[i] for w, i in ids.items()} == {"red": 2, "fish": 1, "boat": 1}


def test_repeated_id_stays_two_documents(spark):
    rows = spark.createDataFrame([("x", "a a"), ("x", "a b")], "id string, chunk string")
    found = bm25.term_frequency(rows, "chunk", PLAIN).groupBy("id").agg(F.count("*").alias("n"))
    assert found.first()["n"] == 3
    assert bm25.fit(rows, PLAIN).stats.first()["n_docs"] == 2


def brute_scores(query):
    tokens = {i: "".join(c if c.isalnum() else " " for c in t.lower()).split() for i, t in TEXTS.items()}
    tokens = {i: t for i, t in tokens.items() if t}
    average = sum(map(len, tokens.values())) / len(tokens)
    df = Counter(w for t in tokens.values() for w in set(t))
    words = set(query.lower().split())
    idf = {w: math.log((len(tokens) + 1) / (df.get(w, 1) + 0.5)) for w in words}
    total = sum(idf.values())
    return {
        i: sum(idf[w] / total * t.count(w) / (1.2 * (0.25 + 0.75 * len(t) / average) + t.count(w))
               for w in words)
        for i, t in tokens.items() if words & set(t)
    }


@pytest.mark.parametrize("small", [True, False])
def test_sparse_topk_against_brute_force(spark, small):
    model = bm25.fit(docs(spark), PLAIN)
    encoded = bm25.encode_documents(bm25.with_terms(docs(spark), "chunk", PLAIN), model)
    queries = spark.createDataFrame([(1, "red boat missing"), (2, "fish")], "qid int, text string")
    terms = bm25.query_terms(queries, model, "text", PLAIN, small)
    rows = search.sparse_topk_rows(encoded, terms, 10, **({} if small else {"limit": 200})).collect()
    joined = search.sparse_topk(bm25.postings(encoded), terms, 10).collect()
    assert sorted(rows) == sorted(joined)
    for qid, text in ((1, "red boat missing"), (2, "fish")):
        found = {r["id"]: r["score"] for r in rows if r["qid"] == qid}
        assert found == pytest.approx(brute_scores(text), abs=1e-6)


def test_store_and_load(spark, scratch):
    model = bm25.fit(docs(spark), PLAIN)
    models.write_model(model, bm25.doc_ids(docs(spark)), scratch + "/deep/m")
    loaded = models.load_model(spark, scratch)
    assert loaded.stats.first() == model.stats.first()
    assert sorted(loaded.df.collect()) == sorted(model.df.collect())
    # A record of punctuation only has text, though no token.
    assert models.load_doc_ids(spark, scratch + "/deep/m").count() == 4
    assert models.load_model(spark, scratch + "/none") is None and models.load_model(spark, "") is None


def test_empty_corpus_writes_nothing(spark, scratch):
    nothing = spark.createDataFrame([("a", "")], "id string, chunk string")
    with pytest.raises(models.EmptyCorpus):
        models.write_model(bm25.fit(nothing, PLAIN), None, scratch + "/m")
    assert models.load_model(spark, scratch + "/m") is None


def test_without_model_the_sparse_vector_is_null(spark):
    encoded = bm25.encode_documents(bm25.with_terms(docs(spark), "chunk", PLAIN), None)
    assert encoded.where("sparse_embedding is not null").count() == 0


def test_filter_on_terms_does_not_repeat_the_counting(spark):
    plan = bm25.with_terms(docs(spark), "chunk", PLAIN).where(F.size("terms") > 1)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1


def test_stems_of_lists_equal_stems_of_words(spark):
    import pyarrow as pa

    words = "running runs ran easily fairly cats ponies generalization the a Ünïted nationalities".split()
    rows = [words, [], None, words[3:] * 3, ["running"] * 50, ["x"]]
    want = [None if r is None else [stem(w) for w in r] for r in rows]
    lists = pa.array(rows, pa.list_(pa.string()))
    assert stems_of_lists(lists).to_pylist() == want
    assert stems_of_lists(lists.slice(3, 2)).to_pylist() == want[3:5]
    assert stems_of_lists(lists.slice(0, 0)).to_pylist() == []
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, w array<string>").repartition(3)
    assert {r["i"]: r["s"] for r in frame.select("i", stems(F.col("w")).alias("s")).collect()} == dict(enumerate(want))


def test_each_word_is_stemmed_once_while_remembered(monkeypatch):
    from skeindex.functions import stem as module

    seen, plain = [], module.stem
    monkeypatch.setattr(module, "stem", lambda w: seen.append(w) or plain(w))
    memory = Stems(most=3)
    for _ in range(5):
        assert memory(["cats", "dogs", "cats", None]) == ["cat", "dog", "cat", None]
    assert seen == ["cats", "dogs"]
    memory([f"word{i}s" for i in range(5)])
    assert memory(["cats"]) == ["cat"] and seen.count("cats") == 1  # taken over from the older generation


def test_stemmed_terms_are_those_of_the_stems(spark):
    texts = [(1, "The cats were running and the cat runs"), (2, "ponies"), (3, "")]
    docs = spark.createDataFrame(texts, "id int, chunk string")
    found = bm25.term_frequency(docs, "chunk", Analyzer()).collect()
    plain = Analyzer(stem=False)
    stemmed = [(i, " ".join(stem(w) for w in t.lower().split() if w not in plain.stop_words)) for i, t in texts]
    same = bm25.term_frequency(spark.createDataFrame(stemmed, "id int, chunk string"), "chunk", Analyzer(stem=False, stop_words=())).collect()
    assert sorted(found) == sorted(same) and len(found) == 3
