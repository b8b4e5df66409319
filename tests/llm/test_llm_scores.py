"""WARC, toxicity, quality, top-k and fingerprint operators, and the pipeline."""

import base64
import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ROWS
from pyspark.sql import functions as F

import corpus_pipeline
from skeindex.llm.common import crc32_fold
from skeindex.llm import fingerprint, learn, lines, mixing, packing, quality, simhash, topk, toxicity, warc

# --- WARC ---------------------------------------------------------------------------------------


def parse(data: bytes) -> list[tuple[dict, bytes]]:
    records = []
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        lines_ = head.decode().replace("\r\n ", "\n").split("\r\n")
        assert lines_[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines_[1:])
        n = int(fields["Content-Length"])
        records.append((fields, data[:n]))
        assert data[n : n + 4] == b"\r\n\r\n"
        data = data[n + 4 :]
    return records


PAGES = [
    (1, "http://a/x", "<html><head><title>A &amp; B</title><script>var x='<p>'</script></head><body><p>One<br>two</p><!-- <a href='no'> --><A HREF='/l?a=1&amp;b=2'>go</A></body>", 9),
    (2, None, None, 9),
    (None, "http://b", "", 9),
    (4, "http://c", "plain é text", 9),
    (4, "http://c", "plain é text", 9),
    (5, "http://d", "<p>" * 20000 + "deep" + "</p>" * 20000, 9),
]


def test_warc_records_survive_writing_and_reading(spark, scratch):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, block int")
    found = warc.derive(warc.responses(pages))
    rows = found.collect()
    assert len(rows) == 2 * len(PAGES)
    by = {(r["page_id"], r["record_type"]): r for r in rows}
    assert by[1, "conversion"]["block"] == "A & B\nOne\ntwo\ngo"
    assert by[1, "metadata"]["block"] == "title: A & B\r\noutlinks: 1\r\noutlink: /l?a=1&b=2\r\n"
    assert by[1, "metadata"]["refers_to"] == by[1, "conversion"]["refers_to"] != by[1, "metadata"]["record_id"]
    assert by[2, "conversion"]["block"] == by[None, "conversion"]["block"] == "" and by[2, "conversion"]["target_uri"] == ""
    assert by[4, "conversion"]["block"] == "plain é text" and by[5, "conversion"]["block"] == "deep"
    for r in rows:
        html = next(p[2] for p in PAGES if p[0] == r["page_id"]) or ""
        assert r["source_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
    warc.write_records(found.coalesce(1), f"{scratch}/w")
    records = parse(spark.read.format("binaryFile").load(f"{scratch}/w/*.txt").first()["content"])
    assert Counter((f["WARC-Record-ID"], f["WARC-Refers-To"], b) for f, b in records) == Counter((r["record_id"], r["refers_to"], r["block"].encode()) for r in rows)
    assert all("Content-Type: text/html" in f["WARC-Source-Headers"] for f, _ in records)
    again = warc.read_records(spark, f"{scratch}/w").collect()
    assert Counter(r["block"] for r in again) == Counter(r["block"] for r in rows) and all(r["whole"] for r in again)
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_warc_links_in_all_forms_and_references(spark):
    html = """<title>It&#8217;s &#x27;x&#x27; &amp;#65; &eacute; &#146; &#0; &#99999999; &bogus; &#128512;</title><a href="/o'neil">1</a><a href=/x>2</a>
<AREA HREF = '/y"z'><a data-href="p" href="q?a=1&amp;b=2">3</a><a title="href=no > x" href=/w?it's>4</a><a name="n">5</a><a class=it's href="/v">6</a>
<a href="">7</a><a title="t"href="/u">8</a><abbr href="/no">"""
    pages = spark.createDataFrame([(1, "http://a/", html)], "page_id long, url string, html string")
    block = warc.derive(warc.responses(pages)).where("record_type = 'metadata'").first()["block"]
    title, count, *links = block.rstrip("\r\n").split("\r\n")
    assert title == "title: It\u2019s 'x' &#65; \u00e9 \u2019 \ufffd \ufffd &bogus; \U0001f600"
    assert count == "outlinks: 8"
    assert links == [f"outlink: {x}" for x in ("/o'neil", "/x", '/y"z', "q?a=1&b=2", "/w?it's", "/v", "", "/u")]


def test_warc_files_become_responses(spark, scratch):
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>Hi</p>"
    one = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a: b\r\nContent-Length: {len(http)}\r\n\r\n{http}\r\n\r\n"
    cut = one.replace("uuid:1", "uuid:2").replace(f"Length: {len(http)}", "Length: 9999")
    spark.createDataFrame([(one + cut,)], "value string").write.text(f"{scratch}/r")
    found = warc.responses_of(warc.read_records(spark, f"{scratch}/r")).collect()
    assert [(r["record_id"], r["target_uri"], r["body"]) for r in found] == [("<urn:uuid:1>", "http://a: b", "<p>Hi</p>")]
    assert found[0]["http_headers"] == "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"


# --- samples ------------------------------------------------------------------------------------


def test_a_sample_is_bounded_by_texts(spark):
    """One id delivered thousands of times is one row; ids with many texts do not exceed the bound either."""
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    hot = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    many = spark.range(20_000).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("other "), F.col("id").cast("string")).alias("text"))
    rows = learn.labelled(docs.unionByName(hot), labels, "quality", 1000).collect()
    held = {r["doc_id"] for r in labels.where(crc32_fold(F.col("doc_id")) == 0).collect()}
    assert Counter(r["text"] for r in rows if r["text"] == "the same text") in (Counter({"the same text": 1}), Counter())
    assert {r["text"] for r in rows if r["text"].startswith("text")} == {f"text {i}" for i in range(200) if i not in held}
    assert 0 < learn.labelled(docs.unionByName(many), labels, "quality", 300).count() < 1000


def test_long_documents_train_the_model(spark):
    """Long texts only: good and bad ones differ in all passages."""
    words = lambda i, bad: " ".join(("!! ## %%" if bad else f"word{(i + k) % 50}") for k in range(12_000))
    docs = spark.createDataFrame([(i, words(i, i % 2)) for i in range(24)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(24)], "doc_id long, quality int")
    rows = quality.quality(docs, labels).collect()
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 0) for r in rows)


# --- learned scores -----------------------------------------------------------------------------


@pytest.mark.parametrize("name, least_recall, least_precision", [("toxicity", 0.93, 0.93), ("quality", 0.97, 0.97)])
def test_held_out_labels_are_met(spark, name, least_recall, least_precision):
    """Of toxic documents, and of documents of quality, outside the rows that the models have learned from."""
    run, label = {"toxicity": (toxicity.toxicity, "toxic"), "quality": (quality.quality, "quality")}[name]
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = run(docs, labels)
    assert found.count() == docs.count()
    rows = Counter(map(tuple, found.join(labels, "doc_id").where("held_out").select("predicted", F.col(label).alias("y")).collect()))
    recall = rows[1, 1] / (rows[1, 1] + rows[0, 1])
    precision = rows[1, 1] / (rows[1, 1] + rows[1, 0])
    accuracy = (rows[1, 1] + rows[0, 0]) / sum(rows.values())
    print(f"{name}: {dict(rows)} recall {recall:.3f} precision {precision:.3f}")
    assert sum(rows.values()) > 500 and accuracy > 0.97
    assert recall >= least_recall and precision >= least_precision


def test_scores_of_messy_rows(spark, messy, no_docs):
    labels = spark.createDataFrame([(d, d % 2, d % 2, "x") for d in range(1, 12)] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 1, 1, "x")], "doc_id long, quality int, toxic int, score string")
    for run in (toxicity.toxicity, quality.quality):
        rows = run(messy, labels).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
        assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"] or "").encode()) % 5 == 0) for r in rows)
        assert run(no_docs, labels).count() == 0
        assert {round(r["score"], 6) for r in run(messy, labels.limit(0)).collect()} == {0.5}
    assert quality.accepted(messy, labels).columns == messy.columns
    assert quality.accepted(messy, labels.limit(0)).count() == len(ROWS)


def test_folding_exceptions_and_length():
    matcher = toxicity.Matcher({"idiot": 5.0, "trash": 4.0})
    plain = matcher.density("you idiot")
    for other in ("you 1d10t", "you IDІОT", "you i​diot", "you ｉdiot", "you idiots"):
        assert matcher.density(other) == pytest.approx(plain), other
    assert matcher.density("vidiot") == matcher.density("the trash can is full") == matcher.density("") == 0
    assert matcher.density("trash cannot") > 0
    assert matcher.density("idiot " + "word " * 5000) < 0.2 * plain
    assert toxicity.Matcher({}).density("idiot") == 0


def test_marks_and_shapes_fold():
    assert toxicity.fold("i\u0301d") == "íd"
    for other in ("i\u0338d\u0489i\u20d2o\u0336t", "ɪᴅɪᴏᴛ", "іԁіοт", "ⓘⓓⓘⓞⓣ", "idiøt"):
        assert toxicity.fold(other) == "idiot", other


def test_spared_spans_against_all_pairs():
    rng = np.random.default_rng(4)
    lexicon, phrases = {"aaaa": 1.0, "bbbb": 2.0, "cccc": 4.0}, ("aaaa bbbb", "bbbb cccc aaaa", "x cccc")
    matcher, plain = toxicity.Matcher(lexicon, phrases), toxicity.Matcher(lexicon, ())
    for _ in range(200):
        words = rng.choice(["aaaa", "bbbb", "cccc", "x", "y"], int(rng.integers(1, 15))).tolist()
        text, places = " ".join(words), np.cumsum([0, *(len(w) + 1 for w in words)])
        spared = [(m.start(), m.start() + len(p)) for p in phrases for m in re.finditer(f"(?={p}( |$))", text) if m.start() in places]
        left = sum(lexicon.get(w, 0) for w, at in zip(words, places) if not any(a <= at and at + len(w) <= b for a, b in spared))
        assert matcher.density(text) == pytest.approx(np.log1p(100 * left / (len(words) + 100)))
    start = time.time()
    assert matcher.density("aaaa bbbb " * 100_000) == 0 and time.time() - start < 5
    assert plain.density("aaaa bbbb") > 0


def test_exceptions_are_learned_with(spark):
    """With a phrase of its own spared, the word's other uses tell more."""
    texts = [("the grubby word here", 1), ("grubby indeed", 1), ("so grubby", 1), ("grubby you", 1)] * 8 + [("a plain text", 0), ("grubby hands washed", 0)] * 16
    docs = spark.createDataFrame([(i, f"{t} {'ab cd ef gh'[i % 4 :]} number{i}") for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    options = {"least_odds": 0.1, "least_bound": 0.0}
    with_own = toxicity.fit(docs, labels, ("grubby hands",), **options)
    without = toxicity.fit(docs, labels, (), **options)
    assert with_own[0] == without[0] and with_own[1] != without[1]


def test_lexicon_keeps_one_of_implied_terms():
    terms = [("idio", 50, 3.0), ("idiot", 50, 5.0), ("idiots", 9, 5.0), ("lowe", 30, 4.0), ("lowei", 29, 4.0), ("loweia", 9, 4.0), ("scum", 7, 4.0)]
    assert set(toxicity.choose(terms)) == {"idiot", "lowei", "scum"}


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 4, 2)]
    model = quality.train(bags, np.array([0.0, 1.0, 1.0]), hidden=5, epochs=1)
    x, starts, y = np.concatenate(bags), np.array([0, 1, 5]), np.array([0.0, 1.0, 1.0])
    loss = lambda: -np.mean(np.log(np.where(y == 1, s := model.forward(x, starts)["y"], 1 - s)))
    for name, grad in model.gradient(x, starts, y).items():
        at = tuple(rng.integers(0, n) for n in grad.shape)
        model.p[name][at] += 1e-6
        up = loss()
        model.p[name][at] -= 2e-6
        slope = (up - loss()) / 2e-6
        model.p[name][at] += 1e-6
        assert slope == pytest.approx(grad[at], abs=1e-6), name


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(5)
    bags, y = [], rng.integers(0, 2, 600).astype(float)
    for label in y:
        bag = rng.normal(size=(rng.integers(1, 12), quality.N_FEATURES))
        if label:
            bag[rng.integers(0, len(bag)), 0] += 6
        bags.append(bag)
    model = quality.train(bags[:400], y[:400])
    x = (np.concatenate(bags[400:]) - model.mean) / model.scale
    starts = np.cumsum([0, *map(len, bags[400:-1])])
    assert np.mean((model.forward(x, starts)["y"] > 0.5) == y[400:]) > 0.9


# --- top-k --------------------------------------------------------------------------------------


def slow_top(rows, queries, k):
    usable = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in usable if queries(i)}):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], start=1)]
    return sorted(out)


def test_threshold_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 256)
    monkeypatch.setattr(topk, "QUERY_BYTES", 700)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8) / 4]) for i in range(300)]  # many ties
    rows += [(300, None), (301, [float("nan")] * 8), (302, [None] * 8), (303, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (10, [0.5] * 8)]
    rows += [(350, [0.0] * 8), (400, [0.5, 0.5]), (401, [0.25, -0.5]), (450, []), (451, []), (500, [1e15] * 8), (501, [-1e15] * 8)]
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<double>, query int, score string").repartition(3)
    vectors = topk.scaled(df, "vec_id", "embedding")
    found = sorted(map(tuple, topk.top_k(vectors, vectors.where("id % 10 = 0"), 5).collect()))
    clipped = [(q, r, i, max(-(1 << 63), min((1 << 63) - 1, s))) for q, r, i, s in slow_top(rows, lambda i: i % 10 == 0, 5)]
    assert [f for f in found if f[0] != 500] == [c for c in clipped if c[0] != 500]
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_search_stops_early():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-50, 50, (5000, 4))
    vectors[7] = [1000, 900, 800, 700]
    block, seen = topk.Lists(np.arange(5000), vectors), []
    block.scores = lambda rows, q: seen.append(len(rows)) or vectors[rows] @ q
    best = block.search(-1, np.array([3, 2, 1, 1]), 1, [])
    assert best == [(-(3000 + 1800 + 800 + 700), 7)] and sum(seen) < 2500


def test_queries_are_taken_piece_by_piece(spark, monkeypatch):
    """The results of a piece are written before the next one is read."""
    events, real = [], topk._search_piece
    monkeypatch.setattr(topk, "QUERY_BYTES", 400)
    monkeypatch.setattr(topk, "_search_piece", lambda vectors, asked, k, piece: events.append((piece, asked.num_rows)) or real(vectors, asked, k, piece))
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(120)]
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = sorted(map(tuple, topk.top_k(vectors, vectors.where("id % 4 = 0"), 3).collect()))
    assert found == slow_top(rows, lambda i: i % 4 == 0, 3)
    assert len(events) > 3 and sum(n for _, n in events) == 30


# --- fingerprints -------------------------------------------------------------------------------


def paragraphs(text):
    return {p for p in re.split(r"(?<=[.!?])\s+|\n", text, flags=re.A) if p}


def dice(a, b):
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def test_fingerprints_against_sets(spark):
    rng = np.random.default_rng(6)
    sentences = [f"Sentence {i} é." for i in range(400)]
    texts = [(i, " ".join(rng.choice(sentences, int(rng.integers(0, 40)))) if i % 9 else None) for i in range(120)]
    texts += [(200, "\n".join(f"line {i}" for i in range(3000))), (201, "\n".join(f"line {i}" for i in range(0, 3000, 2))), (202, texts[1][1]), (7, texts[7][1]), (None, "last")]
    found = fingerprint.fingerprints(spark.createDataFrame([(d, t, "x", 1) for d, t in texts], "doc_id long, text string, next_text string, block int")).collect()
    ordered = sorted(((d, t or "") for d, t in texts), key=lambda x: (x[0] is None, x[0] or 0))
    want, prints = Counter(), {}
    for i, (d, t) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        near = [round(dice(paragraphs(t), paragraphs(o)), 9) for o in (edited, after)]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *near)] += 1
        prints[d] = t
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found) == want
    by_text = {}
    for r in found:
        assert by_text.setdefault(prints[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert len(base64.b64decode(r["fingerprint"])) == 20 * fingerprint.PARTS * fingerprint.WIDTH
    assert len(set(by_text.values())) == len({frozenset(paragraphs(t)) for t in by_text})
    assert fingerprint.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    alone = fingerprint.fingerprints(spark.createDataFrame([(1, "A. B.")], "doc_id long, text string")).first()
    assert (alone["near_next"], alone["n_chars"]) == (1.0, 5)


def test_peeling_names_the_differing_digests(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5]), ([], []), ([7], [7]), (list(range(50)), [])], "a array<bigint>, b array<bigint>")
    diff = fingerprint.subtract(fingerprint.table(F.col("a"), 8), fingerprint.table(F.col("b"), 8))
    got = [r["d"] for r in rows.select(fingerprint.peel(diff, 8).alias("d")).collect()]
    assert {(x["d"], x["n"]) for x in got[0]} == {(1, 1), (2, 1), (5, -1)}
    assert got[1] == got[2] == [] and got[3] is None
    whole = [r["d"] for r in rows.select(fingerprint.differing(F.col("a"), F.col("b")).alias("d")).collect()]
    assert {(x["d"], x["n"]) for x in whole[3]} == {(i, 1) for i in range(50)}


def test_fingerprints_run_without_python(spark, sf):
    plan = fingerprint.fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages_follow_their_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mix_sources", "pack_powers"]
    bad = {r["doc_id"] for r in quality.quality(docs, labels).collect() if r["score"] < 0.3}
    key = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)
    kept = [r for r in docs.collect() if r["doc_id"] not in bad]
    stages = [f for _, f in corpus_pipeline.STAGES]
    one = stages[0](spark, docs, sf).checkpoint()
    assert key(one.collect()) == key(kept) and one.columns == docs.columns
    two = stages[1](spark, one, sf).checkpoint()
    gone = {r["doc"]["doc_id"]: r["gone"] or [] for r in lines.without_windows(one).collect()}
    cut = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone[r["doc_id"]]) for r in kept}
    assert {r["doc_id"]: r["text"] for r in two.collect()} == cut and two.columns == docs.columns
    three = stages[2](spark, two, sf).checkpoint()
    classes = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(two).collect()}
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(set(classes.values()))
    four = stages[3](spark, three, sf).checkpoint()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(three).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in four.collect()) == copies and four.columns == docs.columns
    five = stages[4](spark, four, sf)
    assert five.select("doc_id").distinct().count() == len(copies)
    assert five.agg(F.sum("length")).first()[0] == packing.pack(four, packing_path()).agg(F.sum("length")).first()[0]


def packing_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_stages_take_messy_rows(spark, messy, no_docs, sf):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, messy, sf).count() > 0, name
        assert stage(spark, no_docs, sf).count() == 0, name


def test_rare_terms_enter_the_lexicon_by_evidence_and_near_copies_do_not(spark):
    rng = np.random.default_rng(8)
    text = lambda *own: " ".join([*own, *(f"plain{w}" for w in rng.integers(0, 5000, 30))])
    copied = [f"plain{w}" for w in rng.integers(0, 5000, 400)]
    texts = [text("vileword") for _ in range(392)] + [text("rareword") for _ in range(8)] + [text() for _ in range(1500)]
    texts += [" ".join([*copied[:200], "copyword", *copied[200:], f"end{i}"]) for i in range(8)]
    toxic = [1] * 400 + [0] * 1500 + [1] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    lexicon, _, _ = toxicity.fit(docs, labels)
    assert any("rareword".startswith(t) for t in lexicon) and any("vileword".startswith(t) for t in lexicon)
    assert not any("copyword".startswith(t) for t in lexicon)
