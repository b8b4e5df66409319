"""The Merkle manifest against trees built in plain Python, and the van Emde Boas layout."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import ROWS, SCHEMA

from skeindex.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row[:5]
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i : i + 3])) for i in range(0, len(now), 3)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append((at % 3, [x for i, x in enumerate(level[first : first + 3]) if first + i != at]))
        at //= 3
    return out


def by_hand(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in sources[s]])
    top = tree([trees[s][-1][0] for s in order])
    want = Counter()
    for k, s in enumerate(order):
        for i, r in enumerate(sources[s]):
            steps = path(trees[s], i) + path(top, k)
            digest = own = leaf(r, r[1])
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                digest = leaf(r, r[1].replace("\n", ""))
            for at, siblings in steps:
                digest = sha("".join([*siblings[:at], digest, *siblings[at:]]))
            root = top[-1][0]
            want[r[0], own, trees[s][-1][0], root, sha("".join(x for _, of in steps for x in of)), digest, digest == root] += 1
    return want


def rows_of(found):
    return Counter(tuple(r) for r in found.collect())


def test_messy_rows(spark, messy, no_docs):
    assert rows_of(merkle.verified(messy)) == by_hand(ROWS)
    assert merkle.verified(no_docs).count() == 0
    one = spark.createDataFrame(ROWS[2:3], SCHEMA)
    assert rows_of(merkle.verified(one)) == by_hand(ROWS[2:3])


@pytest.mark.parametrize("height", [1, 2, 6])
def test_many_levels_of_blocks(spark, monkeypatch, height):
    """Blocks of few leaves, so that trees have several levels of them; one source holds most rows, many hold one."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = [(i, f"text {i}\nof a row" * (i % 3), "x", f"s{i:04}" if i % 4 == 0 else ("hot" if i % 5 else None), i, *ROWS[0][5:]) for i in range(1, 260)]
    rows += rows[:3] + [(7, "another text", None, "hot", None, *ROWS[0][5:])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rows_of(merkle.verified(docs))
    assert got == by_hand(rows)
    assert {r[-1] for r in got} == {True, False}


def test_layout_is_recursive():
    for levels in range(1, 8):
        places = np.concatenate([merkle.address(levels, d, np.arange(3**d)) for d in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle.nodes_of(levels)))
    # Four levels: the upper two first, then each subtree of two levels from left to right.
    assert merkle.address(4, 0, np.arange(1)).tolist() == [0]
    assert merkle.address(4, 1, np.arange(3)).tolist() == [1, 2, 3]
    assert merkle.address(4, 2, np.arange(9)).tolist() == [4 + 4 * i for i in range(9)]
    assert merkle.address(4, 3, np.arange(9)).tolist() == [5, 6, 7, 9, 10, 11, 13, 14, 15]
    # Any aligned subtree of the lower half is contiguous.
    depth, root = 3, 5
    own = [int(merkle.address(6, depth + d, np.arange(root * 3**d, (root + 1) * 3**d))[i]) for d in range(3) for i in range(3**d)]
    assert sorted(own) == list(range(min(own), min(own) + len(own)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 80])
def test_block_paths_fold_to_the_root(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    height = next(h for h in range(9) if 3**h >= n)
    block = merkle.Block.built(height, leaves)
    want = tree([x.hex() for x in leaves])
    assert block.node(0, 0).hex() == want[-1][0]
    for i, p in enumerate(block.paths()):
        assert merkle.folded(leaves[i], p) == block.node(0, 0)
        assert [(at, [s.hex() for s in of]) for at, of in merkle.steps(p)] == path(want, i)
        assert merkle.folded(hashlib.sha256(b"other").digest(), p) != block.node(0, 0)
