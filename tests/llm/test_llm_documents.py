"""Line, mixing, packing and SimHash operators on small and messy tables, against plain Python."""

import re
import time
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest_llm import ROWS, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skeindex.llm import bytelevel, lines, mixing, packing, simhash
from skeindex.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")


def normal(line):
    return " ".join(line.lower().split())


def later_windows(rows, size=3):
    """(doc_id, text) -> line numbers to remove; rows equal in both are one occurrence."""
    places = defaultdict(list)
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        own = [(i, normal(x)) for i, x in enumerate((text or "").split("\n")) if normal(x)]
        for k in range(len(own) - size + 1):
            window = "\n".join(x for _, x in own[k : k + size])
            places[window].append(((doc_id is None, doc_id or 0), text, k, own[k][0], own[k + size - 1][0], doc_id))
    gone = defaultdict(set)
    for of in places.values():
        first = min(of, key=lambda p: (p[0], p[2]))
        for p in of:
            if (p[0], p[1], p[2]) != (first[0], first[1], first[2]):
                gone[p[5], p[1]] |= set(range(p[3], p[4] + 1))
    return gone


def test_windows_and_texts(messy):
    # Of texts that share an id, ties go by hash; the fixture has no tie that the hash decides.
    gone = later_windows(ROWS)
    want = Counter()
    for r in ROWS:
        cut = gone.get((r[0], r[1]), set())
        text = r[1] if not cut else "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in cut)
        want[(r[0], text, r[3], r[5])] += 1
    found = lines.deduplicated(messy)
    assert found.columns == messy.columns
    rows = found.collect()
    got = Counter((r["doc_id"], r["text"], r["source"], r["h"]) for r in rows)
    same = {k: v for k, v in want.items() if k[0] != 10}
    assert {k: v for k, v in got.items() if k[0] != 10} == same
    assert sum(got.values()) == len(ROWS)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_windows_overlap_within_a_text(spark):
    docs = spark.createDataFrame([(1, "a\na\na\na\nb")], "doc_id long, text string")
    row = lines.without_windows(docs).first()
    assert (row["gone"], row["text"], row["n_lines"]) == ([1, 2, 3], "a\nb", 5)


def later_passages(rows, at_least=lines.PASSAGE_WORDS):
    """(doc_id, text) -> {unit: (start, end, words)} of the units to remove, by the rules in plain Python."""
    places, own = defaultdict(list), {}
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        pieces, at = [], 0
        for piece in re.findall(r"[^.!?\n]+[.!?]*|[.!?]+|\n", text or ""):
            pieces.append((at, at + len(piece), normal(piece)))
            at += len(piece)
        assert at == len(text or "")
        own[doc_id, text] = [p for p in pieces if p[2]]
        for unit, (_, _, plain) in enumerate(own[doc_id, text]):
            places[plain].append(((doc_id is None, doc_id or 0), unit, doc_id, text))
    gone = {}
    for (doc_id, text), units in own.items():
        repeats = []
        for unit, (_, _, plain) in enumerate(units):
            first = min(places[plain], key=lambda p: p[:2])
            repeats.append((first[1], first[2], first[3]) != (unit, doc_id, text))
        run = []
        for unit, again in [*enumerate(repeats), (None, False)]:
            if again:
                run.append(unit)
                continue
            if sum(len(units[u][2].split()) for u in run) >= at_least:
                gone.setdefault((doc_id, text), {}).update({u: units[u][:2] for u in run})
            run = []
    return gone


PASSAGE = "Of the many birds that nest there, the smallest is seen by few. It comes in spring and leaves before the first frost of the year! Nobody knows where it goes; some say south."
SENTENCES = [
    (1, f"An opening of its own. {PASSAGE} An end of its own."),
    (2, f"Another line that starts here {1}, goes on. {PASSAGE.upper()} And it goes on in the same line.\nRead more.\nLe."),
    (3, "Le.\nRead more.\nAll rights reserved.\nWords that no other document has."),
    (4, "Le. of. Le. Read more. Something else. All rights reserved. Le."),
    (5, f"{PASSAGE[:60]} and then it changes."),
    (6, "A line that comes again and again in the same text, long enough to count as a passage of its own with these words.\nnew\n" * 2),
    (7, PASSAGE.replace(" ", "  \t ")),
    (8, None),
    (8, ""),
    (None, PASSAGE),
]


def test_passages_equal_the_rules_by_hand(spark, messy):
    for docs, rows in ((messy, ROWS), (spark.createDataFrame(SENTENCES, "doc_id long, text string"), SENTENCES)):
        gone = later_passages(rows)
        assert gone
        # Of texts that share an id ties go by hash; the fixtures have none that the hash decides, but for id 10.
        want = {(doc_id, unit, *span) for (doc_id, _), units in gone.items() for unit, span in units.items() if doc_id != 10}
        later = lines.repeated_passages(docs)
        got = [(r["doc_id"], r["unit"], r["start"], r["end"]) for r in later.collect() if r["doc_id"] != 10]
        assert len(got) == len(set(got)) and set(got) == want
        left = lines.without_passages(docs, later)
        assert left.columns == docs.columns
        texts = Counter()
        for r in rows:
            cut, text = sorted(gone.get((r[0], r[1]), {}).values()), r[1]
            for start, end in reversed(cut):
                text = text[:start] + text[end:]
            texts[r[0], text] += 1
        found = Counter((r["doc_id"], r["text"]) for r in left.collect())
        assert sum(found.values()) == len(rows)
        assert {k: n for k, n in found.items() if k[0] != 10} == {k: n for k, n in texts.items() if k[0] != 10}


def test_embedded_passages_go_and_stock_lines_stay(spark):
    docs = spark.createDataFrame(SENTENCES, "doc_id long, text string")
    later = lines.repeated_passages(docs)
    assert {r["doc_id"] for r in later.collect()} == {2, 6, 7, None}
    assert {r["kept_doc_id"] for r in later.where("doc_id <> 6").collect()} == {1}
    left = {r["doc_id"]: r["text"] for r in lines.without_passages(docs, later).where("doc_id in (1, 2, 3)").collect()}
    assert left[1] == SENTENCES[0][1] and left[3] == SENTENCES[2][1]
    assert "NOBODY" not in left[2] and "Another line" in left[2] and "Read more." in left[2]


def test_many_lines_are_cut_in_linear_time(spark):
    """Two texts of 100,000 lines that share every other block of lines."""
    one = [f"line {i} of the first" for i in range(100_000)]
    two = [x if i % 8 < 4 else f"other {i}" for i, x in enumerate(one)]
    docs = spark.createDataFrame([(1, "\n".join(one)), (2, "\n".join(two))], "doc_id long, text string")
    start = time.time()
    rows = {r["doc_id"]: r["text"] for r in lines.deduplicated(docs).collect()}
    assert rows[1] == "\n".join(one)
    assert rows[2] == "\n".join(x for x in two if x.startswith("other"))
    assert time.time() - start < 60


def test_lines_of_nothing(no_docs):
    assert lines.deduplicated(no_docs).count() == 0
    assert lines.repeated_passages(no_docs).count() == 0
    assert lines.without_passages(no_docs, lines.repeated_passages(no_docs)).count() == 0


def mixed_by_hand(rows, weights=(1, 2, 3)):
    sizes, hashes = defaultdict(int), []
    for r in rows:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if level * weight[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    return {s: min(3 * sizes[s], level * weight[s]) for s in order}, sizes


def test_mix_comes_near_its_targets(spark, messy):
    many = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('w ', cast(id % 37 + 1 as int)) as text", "case when id % 3 = 0 then 'big' when id % 50 = 1 then 'tiny' when id % 7 = 2 then null else 'mid' end as source", "id as h"
    )
    rows = mixing.mix(many).collect()
    targets, sizes = mixed_by_hand(rows)
    taken, most = Counter(), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert all(abs(taken[s] - targets[s]) <= most[s] / 2 for s in targets)
    assert sorted(rows) == sorted(mixing.mix(many.repartition(5)).collect())
    documents = mixing.mixed_documents(many).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in documents} == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}


def test_mix_of_messy_rows(messy, no_docs):
    rows = mixing.mix(messy).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for r in rows for t in [next(x[1] for x in ROWS if x[0] == r["doc_id"])] if r["doc_id"] not in (None, 10))
    assert mixing.mixed_documents(messy).columns == messy.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    blank = messy.where("text is null or text = ''")
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_nested_budgets_are_nested(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('w ', cast(id % 9 + 1 as int)) as text", "'a' as source")
    sizes = mixing.keyed(mixing.sized(docs))
    found = []
    for budget in (1, 100, 700, 2400):
        limit = mixing.thresholds(sizes, spark.createDataFrame([(True, "a", float(budget))], "has_source boolean, source string, budget double")).first()["threshold"]
        kept = {r["doc_id"]: r["size"] for r in sizes.where(sizes["h"] <= limit).collect()}
        assert abs(sum(kept.values()) - budget) <= 5
        found.append(set(kept))
    assert all(a <= b for a, b in zip(found, found[1:]))


def test_pack_round_trip(messy, no_docs):
    tokenizer = Tokenizer.from_file(PATH)  # as its file has it
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in ROWS)
    rows = packing.pack(messy, PATH, with_ids=True).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    by_doc = defaultdict(list)
    for r in rows:
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())))
    for (doc_id, n), own in by_doc.items():
        copies = want[next(k for k in want if k[0] == doc_id and len(k[1]) == n)]
        starts = sorted(own)[::copies]
        assert sum((p for _, p in starts), ()) == next(k[1] for k in want if k[0] == doc_id and len(k[1]) == n)
    assert sum(len(k[1]) * n for k, n in want.items()) == sum(r["length"] for r in rows)
    by_bucket = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_bucket] == sorted(r["length"] for r in rows)
    assert packing.pack(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(messy, PATH, longest=1000)


def test_words_join_to_the_text():
    rng = np.random.default_rng(1)
    bits = ["a", "the", " ", "  ", "\n", "\t", ".", "é", " ", "日", "'s", "12", "<|endoftext|>", "\x1c", " don't", "!!", " .x", "#)", " "]
    texts = ["".join(rng.choice(bits, rng.integers(0, 20))) for _ in range(3000)]
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in whole]
    assert sum(b"\x50\xc4\x00\x00" in x for x in want) > 500  # the added token, 50256
    encoder = packing.TextTokenizer(PATH)
    assert list(encoder.encode(texts)) == want
    assert 200 < sum(map(encoder.by_ranks, texts)) < 2800
    assert list(encoder.encode(["x" * 50_000, " " * 50_000])) == [np.array(Tokenizer.from_file(PATH).encode(t).ids, dtype="<u4").tobytes() for t in ("x" * 50_000, " " * 50_000)]


@pytest.mark.parametrize("lang", ["en", "de", "es", "fr"])
def test_ranks_give_the_ids_of_documents(spark, lang):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("lang") == lang).collect()]
    encoder, plain = packing.TextTokenizer(PATH), Tokenizer.from_file(PATH)
    assert sum(map(encoder.by_ranks, texts)) > 0.9 * len(texts)
    assert list(encoder.encode(texts)) == [np.array(e.ids, dtype="<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]


COMMON = st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \t\n.,'\"$%0123456789aestx\u2019\u201c\u2014\u20ac")), max_size=60)


@settings(max_examples=500, deadline=None)
@given(COMMON)
def test_ranks_give_the_ids_of_common_characters(text):
    encoder = tokenizer_of_tests()
    assert encoder.by_ranks(text)
    assert list(encoder.encode([text])) == [np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()]


@lru_cache
def tokenizer_of_tests():
    return packing.TextTokenizer(PATH)


def test_runs_of_white_space_are_linear():
    text = " a\t  " * 400_000
    start = time.time()
    assert "".join(bytelevel.words_of(text)) == text
    assert time.time() - start < 5


def slow_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_classes(prints, k=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= k:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_of_messy_rows(messy, no_docs):
    prints = [slow_print(r[1]) for r in ROWS]
    roots = slow_classes(prints)
    least = {}
    for r, root in zip(ROWS, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = Counter((r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(ROWS, prints, roots))
    assert Counter(map(tuple, simhash.near_duplicates(messy).collect())) == want
    kept = simhash.one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("k", [1, 3, 4])
def test_trie_join_of_dense_and_sparse_prints(spark, k):
    rng = np.random.default_rng(k)
    centres = [int(x) for x in rng.integers(0, 1 << 63, 12)] + [0, (1 << 64) - 1]
    prints = {c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centres for _ in range(40)}
    prints = sorted(prints | {int(x) for x in rng.integers(0, 1 << 63, 300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), k, per_node=4)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    roots = slow_classes(prints, k)
    groups, want = defaultdict(set), defaultdict(set)
    for p, root in zip(signed, roots):
        groups[found.get(p, p)].add(p)
        want[root].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_crowded_nodes_are_cut_deeper(spark, monkeypatch):
    """Variants of one template: they share their first bits, and each is near a few others only."""
    rng = np.random.default_rng(9)
    template = int(rng.integers(0, 1 << 62))
    prints = {template ^ sum(1 << int(b) for b in rng.choice(56, rng.integers(3, 9), replace=False)) for _ in range(900)}
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    prints |= {p ^ 1 << int(b) for p, b in zip(sorted(prints)[:80], rng.integers(0, 64, 80))}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    sizes = []
    rows = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = defaultdict(set)
    for p, root in zip(signed, slow_classes(prints)):
        want[root].add(p)
    depths = []
    real = simhash._links_at
    monkeypatch.setattr(simhash, "_links_at", lambda both, depth, *args: depths.append(depth) or real(both, depth, *args))
    for crowd in (40, 10_000):
        links = simhash.near_links(rows, 4, per_node=64, crowd=crowd)
        found = {r["node"]: r["root"] for r in components(links).collect()}
        groups = defaultdict(set)
        for p in signed:
            groups[found.get(p, p)].add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
        sizes.append(list(depths))
        depths.clear()
    assert sizes[1] == [6] and len(sizes[0]) >= 3 and sizes[0] == sorted(set(sizes[0]))


def test_components_of_a_long_chain_and_odd_links(spark):
    chain = [(i, i + 1) for i in range(200)] + [(5, 5), (None, 3), (1000, 999), (999, 1000), (7, 8)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_words_are_whole(spark):
    text = words(0, 50_000)
    row = simhash.near_duplicates(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["fingerprint"] == f"{slow_print(text):016x}"
