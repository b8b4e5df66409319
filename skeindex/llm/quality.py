"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and has one label. Every passage is encoded (features of its characters and words, then
a learned layer), a gated attention learned from the document labels says how much each passage counts, and the
weighted sum of the encodings is scored. Training runs on a bounded sample of labelled documents; scoring reads whole
documents and keeps one batch of them in memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeindex.llm.learn import labelled, scored, sigmoid

PASSAGE_WORDS = 128
_KINDS = np.zeros(256, dtype=np.int64)  # 0: other bytes
for _kind, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"!?", b"|<>{}[]=/\\_", b"#$%&*@^~+`", bytes(range(128, 256))),
    start=1,
):
    _KINDS[list(_bytes)] = _kind
N_KINDS = 9
N_FEATURES = N_KINDS + 6


def features(words: list[bytes]) -> np.ndarray:
    """Shares of kinds of bytes, word lengths, and how much words and byte strings repeat."""
    out = np.zeros(N_FEATURES)
    if not words:
        return out
    text = b" ".join(words)
    n = len(words)
    letters = len(text) - n + 1
    kinds = np.bincount(_KINDS[np.frombuffer(text, dtype=np.uint8)], minlength=N_KINDS)
    kinds[0] -= n - 1  # the joining spaces
    out[:N_KINDS] = kinds / letters
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    out[N_KINDS:] = (
        np.log1p(n),
        lengths.mean() / 10,
        min(lengths.max(), 100) / 100,
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        min(1.5, len(zlib.compress(text, 1)) / len(text)),
    )
    return out


def passages(text: str | None) -> np.ndarray:
    """One row of features for every passage of a text; an empty text is one empty passage."""
    words = (text or "").encode("utf-8", "replace").split()
    return np.array([features(words[i : i + PASSAGE_WORDS]) for i in range(0, max(1, len(words)), PASSAGE_WORDS)])


@dataclass
class AttentionModel:
    """h = tanh(x W + b); attention softmax(w (tanh(h V) * sigmoid(h U))); score sigmoid(z c + d) of z = sum of a h."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``starts``: the first passage of each document; all documents have one at least."""
        p, s = self.p, {"x": x}
        s["h"] = np.tanh(x @ p["W"] + p["b"])
        s["t"], s["g"] = np.tanh(s["h"] @ p["V"]), sigmoid(s["h"] @ p["U"])
        e = (s["t"] * s["g"]) @ p["w"]
        s["of"] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
        e = np.exp(e - np.maximum.reduceat(e, starts)[s["of"]])
        s["a"] = e / np.add.reduceat(e, starts)[s["of"]]
        s["z"] = np.add.reduceat(s["a"][:, None] * s["h"], starts, axis=0)
        s["y"] = sigmoid(s["z"] @ p["c"] + p["d"])
        return s

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.p, self.forward(x, starts)
        dy = (s["y"] - y) / len(y)
        dz = dy[:, None] * p["c"]
        out = {"c": s["z"].T @ dy, "d": dy.sum(keepdims=True)}
        own = dz[s["of"]]
        da = (own * s["h"]).sum(axis=1)
        de = s["a"] * (da - np.add.reduceat(s["a"] * da, starts)[s["of"]])
        gated = s["t"] * s["g"]
        out["w"] = gated.T @ de
        dgate = de[:, None] * p["w"]
        dt, dg = dgate * s["g"] * (1 - s["t"] ** 2), dgate * s["t"] * s["g"] * (1 - s["g"])
        out["V"], out["U"] = s["h"].T @ dt, s["h"].T @ dg
        dh = s["a"][:, None] * own + dt @ p["V"].T + dg @ p["U"].T
        dh *= 1 - s["h"] ** 2
        out["W"], out["b"] = x.T @ dh, dh.sum(axis=0)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        bags = [passages(t) for t in texts]
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, starts)["y"]


def train(bags: list[np.ndarray], y: np.ndarray, hidden: int = 16, epochs: int = 60, batch: int = 128, rate: float = 0.01, penalty: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Fit the model by Adam; the same bags in the same order give the same model. No bags: every score is 0.5."""
    rng = np.random.default_rng(seed)
    rows = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES))
    mean, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 0.02)
    p = {"W": rng.normal(0, N_FEATURES**-0.5, (N_FEATURES, hidden)), "b": np.zeros(hidden)}
    p |= {k: rng.normal(0, hidden**-0.5, (hidden, hidden)) for k in ("V", "U")}
    p |= {"w": rng.normal(0, hidden**-0.5, hidden), "c": np.zeros(hidden), "d": np.zeros(1)}
    model = AttentionModel(mean, scale, p)
    if not bags:
        return model
    share = np.clip(y.mean(), 0.01, 0.99)
    p["d"][:] = np.log(share / (1 - share))
    bags = [(b - mean) / scale for b in bags]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            x = [bags[j] for j in own]
            grad = model.gradient(np.concatenate(x), np.cumsum([0, *map(len, x[:-1])]), y[own])
            step += 1
            for k, g in grad.items():
                g = g + penalty * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                now = rate * (1 - epoch / epochs)
                p[k] -= now * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4_000, max_passages: int = 64, **options) -> AttentionModel:
    """Train on at most about ``max_rows`` labelled documents, by at most ``max_passages`` passages of each.

    Of a longer document these are spread evenly from its first to its last; scoring reads all passages.
    """

    def spread(bag: np.ndarray) -> np.ndarray:
        return bag if len(bag) <= max_passages else bag[np.linspace(0, len(bag) - 1, max_passages).round().astype(int)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [(spread(passages(t)), y) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            bags = [(b.ravel().tolist(), float(y > 0)) for b, y in bags]
            yield pa.record_batch([pa.array([b for b, _ in bags], pa.list_(pa.float64())), pa.array([y for _, y in bags], pa.float64())], names=["bag", "label"])

    found = labelled(docs, labels, "quality", max_rows).mapInArrow(encode, "bag array<double>, label double")
    rows = found.orderBy(F.xxhash64("bag"), "label").collect()
    bags = [np.array(r["bag"]).reshape(-1, N_FEATURES) for r in rows]
    return train(bags, np.array([r["label"] for r in rows]), **options)


def quality(docs: DataFrame, labels: DataFrame, at_least: float = 0.3, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; labels are learned outside the held-out fold.

    Null and empty texts are one empty passage. Repeated rows are scored alike; without labels all scores are 0.5; an
    empty table gives an empty result.
    """
    model = fit(docs, labels, **options)
    return scored(docs, model.score, at_least)


def accepted(docs: DataFrame, labels: DataFrame, at_least: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``at_least``, with their columns; texts are scored where they are read."""
    model = fit(docs, labels, **options)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        parts = [model.score([t or "" for t in text[i : i + 256]]) for i in range(0, len(text), 256)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.where(score(F.col("text")) >= at_least)
