"""Alignment of two tokenizers, against plain tokenizers and a merge in plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from conftest_llm import ROWS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skeindex.llm import align, bytelevel

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = bytelevel.byte_alphabet()
VOCABULARY = {i: entry for entry, i in A.get_vocab().items()}


def a_tokens(text):
    ids = A.encode(" " + text, add_special_tokens=False).ids
    return ids, [bytes(LETTERS[c] for c in VOCABULARY[i]) for i in ids]


def b_tokens(text):
    ids = B.encode(text)
    return ids, [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in ids]


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def by_hand(texts):
    """Per text: n_a, n_b, n_groups, links as id pairs, groups as text."""
    out = []
    for text in texts:
        (a, a_bytes), (b, b_bytes) = a_tokens(text or ""), b_tokens(text or "")
        want = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            out.append((0, 0, 0, [], ""))
            continue
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        links, j = [], 0
        for i, (s, e) in enumerate(a_spans):
            while b_spans[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and b_spans[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, low = [], 0
        ia = ib = 0
        for cut in cuts:
            own_a, own_b = [], []
            while ia < len(a) and a_spans[ia][1] <= cut:
                own_a.append(str(a[ia]))
                ia += 1
            while ib < len(b) and b_spans[ib][1] <= cut:
                own_b.append(str(b[ib]))
                ib += 1
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
        out.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    return out


def expected(rows):
    found = by_hand([r[1] for r in rows])
    counts = Counter(p for f in found for p in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = Counter()
    for r, (n_a, n_b, n_groups, links, groups) in zip(rows, found):
        best = sum(counts[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if links else ""
        want[r[0], n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest] += 1
    return want


TRICKY = ["<|endoftext|>", "a <|endoftext|> b</s><s><unk>", "▁", "a▁b", "  two  spaces ", "\n\n\n", " \n x\n y\n", "\t\r\n", "x" * 700, "\x00\x1f", "  z", "é̈", "<0x41>", "日本語のテキスト", "😀👍🏽", "12345,678.90", "it's we'll", "A​B", "ǆ ﬁ ½"]


def test_rows_equal_the_merge_by_hand(spark, messy):
    rows = [r for r in ROWS] + [(100 + i, t, *ROWS[0][2:]) for i, t in enumerate(TRICKY)]
    docs = spark.createDataFrame(rows, messy.schema).repartition(3)
    got = Counter(tuple(r) for r in align.align(docs, A_PATH, B_PATH).collect())
    assert got == expected(rows)


def test_documents_equal_the_merge_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter(tuple(r) for r in align.align(docs, A_PATH, B_PATH).collect())
    assert got == expected(rows)


def test_nothing_to_align(no_docs):
    assert align.align(no_docs, A_PATH, B_PATH).count() == 0


def test_lanes_do_not_change_the_links():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 700, 3, 5000]
    a = [rng.integers(0, 50, n).astype(np.int32) for n in sizes]
    a_bytes, b_bytes = np.arange(1, 51), np.arange(1, 31)
    b = []
    for ids in a:  # pieces of B that fill the same bytes
        left, own = int(a_bytes[ids].sum()), []
        while left:
            own.append(min(left, int(rng.integers(1, 31))) - 1)
            left -= own[-1] + 1
        b.append(np.array(own, dtype=np.int32))
    found = align.Aligned(a, b, a_bytes, b_bytes)
    assert found.n_links.tolist() == (found.n_a + found.n_b - found.n_groups).tolist()
    for i, (x, y) in enumerate(zip(a, b)):
        alone = align.Aligned([x], [y], a_bytes, b_bytes)
        a_ends, b_ends = np.cumsum(a_bytes[x]), np.cumsum(b_bytes[y])
        assert alone.n_groups[0] == found.n_groups[i] == len(np.intersect1d(a_ends, b_ends))
        assert alone.digests()[0] == found.digests()[i]
        whole = align.lockstep(a_ends, b_ends, np.array([0][: len(x)], dtype=int), np.array([len(x)][: len(x)], dtype=int))
        pairs = Counter(zip(x[whole[0]].tolist(), y[whole[1]].tolist()))
        first = found.n_pairs[:i].sum()
        own = slice(first, first + found.n_pairs[i])
        assert {divmod(int(p), len(b_bytes)): int(n) for p, n in zip(found.pairs[found.pair_at[own]], found.times[own])} == pairs


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "the", "The ", "naïve", "x1y2", ",", "...", "'s", "日本", "▁", "́", "<s>", "<|endoftext|>", "\r\n", "0", "é", "😀", " ", "_", "http://a.b/c?d=e", "x².", "²", "word.", "(end).", "a,b"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=12))
def test_segments_join_to_whole_texts(parts):
    text = "".join(parts)
    (a_ids, a_bytes), (b_ids, b_bytes) = a_tokens(text), b_tokens(text)
    raw = (" " + text).encode()
    found = [x.tolist() for x in align.loaded(A_PATH, B_PATH).encode([text])[0]]
    assert b"".join(a_bytes) == raw
    assert found == ([a_ids, b_ids] if b"".join(b_bytes) == raw else [[], []])


def test_long_text_is_linear(spark):
    random.seed(1)
    text = " ".join("".join(random.choices("abcdefgh", k=5)) for _ in range(300_000))
    row = align.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A_PATH, B_PATH).first()
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] > 500_000


def test_texts_without_tokens_only(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (None, "a▁b")], "doc_id long, text string")
    got = sorted(map(tuple, align.align(docs, A_PATH, B_PATH).collect()), key=str)
    assert got == sorted([(1, *[0] * 6, ""), (2, *[0] * 6, ""), (None, *[0] * 6, "")], key=str)


def test_blocks_of_a_task_are_small(spark):
    """A block of 1.2 million characters made the arrays of a worker twice as large."""
    docs = spark.createDataFrame([(i, "plain words " * 25_000) for i in range(4)], "doc_id long, text string").coalesce(1)
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    assert align.aligned_blocks(docs, *paths).count() == 2
