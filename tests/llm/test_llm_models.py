"""The hashed language model: exact base scores, probabilities that sum to one, gradients, and gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ROWS
from pyspark.sql import functions as F

from skeindex.llm import lm


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def test_base_scores_are_exact(spark, messy):
    counts = Counter(w for r in ROWS if fold(r[0]) != 2 for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in ROWS:
        own = words(r[1])
        base = sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in own)
        want[r[0], fold(r[0]) == 2, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    got = lm.scores(messy).collect()
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_nothing_to_score_or_to_learn(spark, no_docs):
    assert lm.scores(no_docs).count() == 0
    held = next(i for i in range(100) if fold(i) == 2)
    row = lm.scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert row["held_out"] and row["n_known"] == 0 and row["train_tokens"] == 0
    assert row["score"] == pytest.approx(3 * math.log10(1 / (lm.CLASSES * lm.GROUPS)), rel=1e-4)


def test_counts_meet_by_word_and_go_back_by_block(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_ENTRIES", 20)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 200)
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.4, 20) if x < 60)) for i in range(60)]
    blocks = lm.text_blocks(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).cache()
    counts = Counter(w for i, t in texts if fold(i) != 2 for w in words(t))
    got = {r["block"]: r["counts"] for r in lm.word_counts(blocks).collect()}
    own = {r["block"]: [bytes(w) for w in r["words"]] for r in blocks.collect()}
    assert set(got) == set(own) and len(own) > 5
    firsts = Counter()
    for block, coded in got.items():
        n, cell = lm._decoded(np.array(coded))
        classes, groups = lm.class_and_group(lm.hashes(own[block]))
        assert n.tolist() == [counts[w] for w in own[block]] and cell.tolist() == (classes * lm.GROUPS + groups).tolist()
        firsts.update(w for w, c in zip(own[block], coded) if c & 1)
    assert set(firsts.values()) == {1} and set(firsts) == {w for of in own.values() for w in of}
    shares, n, v = lm.corpus_counts(lm.word_counts(blocks))
    assert (n, v) == (sum(counts.values()), len(counts)) and shares.sum() == n + v + lm.CLASSES * lm.GROUPS


def trained(seed=5, size=400, tokens=30_000):
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}".encode() for i in range(size)]
    text = [0]
    for _ in range(tokens):  # the next word depends on the last
        text.append(int((7 * text[-1] + rng.integers(0, 3)) % size))
    hashed = lm.hashes(vocabulary)[np.array(text)]
    counts = np.bincount(text, minlength=size)
    shares = np.ones((lm.CLASSES, lm.GROUPS))
    np.add.at(shares, lm.class_and_group(lm.hashes(vocabulary)), counts + 1)
    return vocabulary, np.array(text), hashed, counts, shares


def test_probabilities_sum_to_one():
    vocabulary, text, hashed, counts, shares = trained()
    model = lm.Model.of_shares(shares)
    model.learn(hashed[:5000], np.arange(5000))
    own = lm.hashes(vocabulary)
    classes, groups = lm.class_and_group(own)
    context = list(hashed[100:103])
    seen = sum(math.exp(model.score(np.array([*context, h], dtype=np.uint64), np.arange(4))[-1]) * (n + 1) / shares[c, g] for h, n, c, g in zip(own, counts, classes, groups))
    # Every group keeps one share for what is unseen: a word's hash of any class and group stands for it.
    unseen = 0.0
    for c in range(lm.CLASSES):
        for g in range(lm.GROUPS):
            unseen += math.exp(model.score(np.array([*context, c | g << 32], dtype=np.uint64), np.arange(4))[-1]) / shares[c, g]
    assert seen + unseen == pytest.approx(1.0, abs=1e-4)


def test_steps_follow_the_gradient(monkeypatch):
    _, _, hashed, _, shares = trained()
    hashed, place = hashed[:300], np.arange(300)
    model = lm.Model.of_shares(shares)
    rng = np.random.default_rng(0)
    model.classes += rng.normal(scale=0.1, size=model.classes.shape).astype(np.float32)
    classes, _ = lm.class_and_group(hashed)
    rows = lm.class_rows(lm.before(hashed, place))

    def loss():
        return -model.log_shares(model.classes, rows, model.class_bias, classes).astype(np.float64).sum()

    def softmax(rows):
        x = np.exp(model.sums(model.classes, rows, model.class_bias).astype(np.float64))
        return x / x.sum(axis=1, keepdims=True)

    row = int(rows[0][200])
    slope = np.zeros(lm.CLASSES)
    for c in range(lm.CLASSES):
        was = model.classes[row, c]
        model.classes[row, c] = was + 0.02
        up = loss()
        model.classes[row, c] = was - 0.02
        slope[c] = (up - loss()) / 0.04
        model.classes[row, c] = was
    # The same row in one feature only: its step is the gradient over the root of its hits.
    before, table = model.classes[row].copy(), model.classes.copy()
    model._step(table, np.zeros(lm.ROWS, dtype=np.float32), [rows[0]], model.class_bias, classes)
    direct = softmax([rows[0]])
    direct[np.arange(300), classes] -= 1
    met = rows[0] == row
    np.testing.assert_allclose(before - table[row], direct[met].sum(axis=0) * lm.RATE / np.sqrt(1 + met.sum()), atol=1e-5)
    whole = softmax(rows)
    whole[np.arange(300), classes] -= 1
    times = sum((r == row).astype(int) for r in rows)
    np.testing.assert_allclose(slope, (whole * times[:, None]).sum(axis=0), atol=0.05)


def test_tasks_are_averaged_by_hits(spark):
    """One task gives the weights of plain steps; equal tasks give their common change."""
    texts = [(i, " ".join(f"w{(i + 3 * k) % 40}" for k in range(200))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    blocks = lm.text_blocks(docs, rounds=1)
    row = blocks.first()
    hashed = lm.hashes([bytes(w) for w in row["words"]])[np.array(row["tokens"])]
    learned = np.repeat(~np.array(row["held_out"]), row["sizes"])
    plain = lm.Model.of_shares(np.ones((lm.CLASSES, lm.GROUPS)))
    plain.learn(hashed[learned], lm._places(np.array(row["sizes"]))[learned])
    for copies in (1, 3):
        many = spark.createDataFrame(spark.sparkContext.parallelize([row] * copies, copies), blocks.schema)
        model = lm.train(many, lm.Model.of_shares(np.ones((lm.CLASSES, lm.GROUPS))), 1)
        np.testing.assert_allclose(model.classes, plain.classes, atol=2e-3)
        np.testing.assert_allclose(model.group_hits, copies * plain.group_hits)


def test_held_out_texts_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = lm.scores(docs).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert (sums[1] - sums[0]) / sums[2] > 0.05
