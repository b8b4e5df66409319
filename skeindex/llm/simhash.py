"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints of 64 bits are the leaves of a binary trie. Pairs of nodes are walked down together, adding up the bits in
which their paths differ; a pair is dropped once it has more differing bits than allowed. Two fingerprints within ``k``
bits agree up to ``k // 2`` bits in their first or in their last half, so two tries are walked, one of them of the
fingerprints with their halves exchanged, and each has the smaller budget for the first half.

The top of the trie is spread out by Spark: a fingerprint goes to the node of its first bits and to the nodes within
the budget, each pair of nodes meeting in one of the two. The depth of the cut follows the number of fingerprints.
Where one node is crowded, as with the variants of one template, its pairs are cut six bits deeper, and again, up to the
first half of the bits; only what agrees in all of these can still share a crowded node, whose other half the other trie
takes first. Below a node only a spanning set of links is written, never all pairs of a dense group, and pairs of
subtrees that are already one component are skipped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skeindex.llm.common import small, staged
from skeindex.llm.components import components

SEED = 42
HALF = 32
# Rows of a frontier, and product of subtree sizes from which pairs are compared directly.
FRONTIER, DIRECT = 1 << 18, 32
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


# --- fingerprints -------------------------------------------------------------------------------


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half of the shingles' hashes."""
    words = _WORDS.findall((text or "").encode("utf-8", "replace").lower())  # bytes.lower changes A-Z only
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` of every row, the 64 bits as a signed long. Null and empty texts have fingerprint 0."""
    rows = docs.select("text", *keep)
    schema = StructType([*(rows.schema[c] for c in keep), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint_of(t.as_py(), shingle) for t in batch.column(0)), dtype=np.uint64, count=batch.num_rows)
            yield pa.record_batch([*batch.columns[1:], pa.array(found.view(np.int64))], names=[*keep, "fp"])

    return rows.mapInArrow(run, schema)


# --- the trie below one node --------------------------------------------------------------------


class _Forest:
    """Component labels of positions: the smallest position linked so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j = i[open_], j[open_]
            a, b = a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:  # follow labels to their roots
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def spanning_links(values: np.ndarray, depth: int, node: int, k: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between values within ``k`` bits, at most ``lead`` of them in the first half, that touch ``node``.

    ``values``: sorted distinct unsigned 64-bit integers; ``node``: the first ``depth`` bits of the node joined with
    itself and all others. Returns positions (i, j) that connect what these links connect.
    """
    n = len(values)
    forest = _Forest(n)
    tops = values >> np.uint64(64 - depth) if depth else np.zeros(n, dtype=np.uint64)
    cuts = np.flatnonzero(np.r_[True, tops[1:] != tops[:-1]]) if n else np.zeros(0, dtype=np.int64)
    ends = np.r_[cuts[1:], n] if n else cuts
    own = np.flatnonzero(tops[cuts] == np.uint64(node)) if n else cuts
    if not len(own):
        return cuts[:0], cuts[:0]
    far = np.bitwise_count(tops[cuts] ^ np.uint64(node)).astype(np.int64)
    for budget in sorted({1, k // 2, k}):  # near pairs first: later passes skip what they have joined
        if not 0 < budget <= k:
            continue
        first = min(lead, budget)
        near = np.flatnonzero(far <= first)
        start = np.column_stack([np.repeat(cuts[own], len(near)), np.repeat(ends[own], len(near)), cuts[near], ends[near], far[near]])
        _walk(values, start, depth, budget, first, forest)
    moved = np.flatnonzero(forest.label != np.arange(n))
    return moved, forest.label[moved]


def _walk(values: np.ndarray, start: np.ndarray, depth: int, budget: int, first: int, forest: _Forest) -> None:
    """Walk pairs of nodes (from, to, from, to, differing bits) down the trie and link the leaves that are near."""
    stack = [(depth, start)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack += [(depth, pairs[i : i + FRONTIER]) for i in range(0, len(pairs), FRONTIER)]
            continue
        label = forest.label
        change = np.r_[0, np.cumsum(label[1:] != label[:-1])]
        a, a_end, b, b_end = pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3]
        joined = (change[a] == change[a_end - 1]) & (change[b] == change[b_end - 1]) & (label[a] == label[b])
        pairs = pairs[~joined]
        size = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        direct = (size <= DIRECT) | (depth == 64)
        _compare(values, pairs[direct], budget, first, forest)
        pairs = pairs[~direct]
        if not len(pairs):
            continue
        bit = np.uint64(63 - depth)
        split = [np.searchsorted(values, ((values[lo] >> bit) | np.uint64(1)) << bit) for lo in (pairs[:, 0], pairs[:, 2])]
        mid_a, mid_b = (np.minimum(np.maximum(s, lo), hi) for s, lo, hi in zip(split, (pairs[:, 0], pairs[:, 2]), (pairs[:, 1], pairs[:, 3])))
        below = []
        itself = pairs[:, 0] == pairs[:, 2]
        for x, y in itertools.product((0, 1), (0, 1)):
            keep = slice(None) if (x, y) != (1, 0) else ~itself  # a node's two children meet once
            lo_a, hi_a = (pairs[:, 0], mid_a) if x == 0 else (mid_a, pairs[:, 1])
            lo_b, hi_b = (pairs[:, 2], mid_b) if y == 0 else (mid_b, pairs[:, 3])
            below.append(np.column_stack([lo_a, hi_a, lo_b, hi_b, pairs[:, 4] + (x != y)])[keep])
        below = np.concatenate(below)
        allowed = first if depth < HALF else budget
        stack.append((depth + 1, below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= allowed)]))


def _compare(values: np.ndarray, pairs: np.ndarray, budget: int, first: int, forest: _Forest) -> None:
    """Compare all leaves of small pairs of subtrees."""
    for block in (pairs[i : i + FRONTIER] for i in range(0, len(pairs), FRONTIER)):
        wide = block[:, 3] - block[:, 2]
        size = (block[:, 1] - block[:, 0]) * wide
        row = np.repeat(np.arange(len(block)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        i, j = block[row, 0] + at // wide[row], block[row, 2] + at % wide[row]
        differ = values[i] ^ values[j]
        near = (np.bitwise_count(differ) <= budget) & (np.bitwise_count(differ >> np.uint64(HALF)) <= first) & (i != j)
        forest.link(i[near], j[near])


# --- the join as a Spark job --------------------------------------------------------------------


def near_links(fps: DataFrame, k: int = 4, per_node: int = 1024, crowd: int = 32_768) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints ``fp`` of ``fps`` (distinct) within ``k`` bits of each other.

    A node with more than ``crowd`` fingerprints is cut deeper.
    """
    fps = staged(fps.select("fp"), "fps")
    lead = k // 2
    depth = min(HALF, max(6, int(np.ceil(np.log2(max(2, fps.count()) / per_node)))))
    swapped = F.shiftleft("fp", HALF).bitwiseOR(F.shiftrightunsigned("fp", HALF))
    both = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("turn"), "fp"), F.struct(F.lit(1).alias("turn"), swapped.alias("fp")))).alias("x"))
    both = both.select("x.turn", "x.fp")
    within, found = None, []
    while True:
        crowded = _crowded(both, depth, crowd) if depth < HALF else None
        found.append(_links_at(both, depth, k, lead, within, crowded))
        if crowded is None:
            break
        within, depth = (crowded, depth), min(HALF, depth + 6)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _crowded(both: DataFrame, depth: int, crowd: int) -> DataFrame | None:
    """``turn, prefix`` of the nodes at ``depth`` that hold more than ``crowd`` fingerprints; None without any."""
    prefix = F.shiftrightunsigned("fp", 64 - depth).alias("prefix")
    found = both.groupBy("turn", prefix).count().where(F.col("count") > crowd).select("turn", "prefix")
    found = staged(found, "crowded")  # as many rows as crowds fit into all fingerprints
    return found if found.limit(1).count() else None


def _touching(rows: DataFrame, crowded: DataFrame, shift: int, name: str) -> DataFrame:
    """Mark the rows one of whose nodes ``own`` and ``other``, cut by ``shift`` bits, is crowded."""
    for side in ("own", "other"):
        marks = crowded.select("turn", F.col("prefix").alias("__p"), F.lit(True).alias(f"__{side}"))
        rows = rows.withColumn("__p", F.shiftrightunsigned(side, shift)).join(F.broadcast(marks), ["turn", "__p"], "left").drop("__p")
    return rows.withColumn(name, F.col("__own").isNotNull() | F.col("__other").isNotNull()).drop("__own", "__other")


def _links_at(both: DataFrame, depth: int, k: int, lead: int, within: tuple[DataFrame, int] | None, crowded: DataFrame | None) -> DataFrame:
    """Links of the pairs of nodes at ``depth``, without those that are cut deeper.

    ``within``: crowded nodes of a smaller depth, of which one takes part in each of these pairs.
    """
    masks = [sum(1 << b for b in bits) for n in range(lead + 1) for bits in itertools.combinations(range(depth), n)]
    if within is not None:  # first what is near a crowded node at all, by the few masks of its depth
        near = [sum(1 << b for b in bits) for n in range(lead + 1) for bits in itertools.combinations(range(within[1]), n)]
        around = within[0].select("turn", F.explode(F.array(*[F.lit(m).cast("long") for m in near])).alias("m"), "prefix")
        around = staged(around.select("turn", F.col("prefix").bitwiseXOR(F.col("m")).alias("__p")).distinct(), "around")
        both = both.withColumn("__p", F.shiftrightunsigned("fp", 64 - within[1])).join(small(around, 16), ["turn", "__p"], "left_semi").drop("__p")
    rows = both.select("turn", "fp", F.shiftrightunsigned("fp", 64 - depth).alias("own"))
    rows = rows.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    rows = rows.withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
    if within is not None:
        # Fingerprints stay in their own node, which may be host to a crowded one.
        rows = _touching(rows, within[0], depth - within[1], "__in").where("__in or mask = 0").drop("__in")
    if crowded is not None:
        rows = _touching(rows, crowded, 0, "__deep").where("not __deep").drop("__deep")
    # Of two nodes that meet, a hash of both says which one is host, so that hosts get equal loads.
    low = F.xxhash64(F.least("own", "other"), F.greatest("own", "other")) % 2 == 0
    host = F.when(low, F.least("own", "other")).otherwise(F.greatest("own", "other"))
    rows = rows.where((F.col("mask") == 0) | (host == F.col("other"))).select("turn", F.col("other").alias("node"), "fp")

    def links(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(group["fp"].to_numpy(dtype=np.int64).view(np.uint64))
        i, j = spanning_links(values, depth, int(key[1]), k, lead)
        if key[0]:
            values = (values << np.uint64(HALF)) | (values >> np.uint64(HALF))
        values = values.view(np.int64)
        return pd.DataFrame({"a": values[i], "b": values[j]})

    return rows.groupBy("turn", "node").applyInPandas(links, "a long, b long")


def classes(prints: DataFrame, k: int = 4) -> DataFrame:
    """``fp, component_id`` of every distinct fingerprint of ``prints(doc_id, fp)``.

    ``component_id`` is the smallest doc_id that can be reached over links of at most ``k`` differing bits. Ids of null
    count only where a component has no other: its id is then null.
    """
    least = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "least")
    linked = staged(components(near_links(least, k)), "components")
    roots = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return roots.select("fp", "root").join(first, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, k: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs(doc_id, text, ...)``.

    Texts are lower-cased (A-Z), cut into words and shingles, repeats included; fewer words make one shingle, none
    fingerprint 0, which links like any other. Repeated rows give repeated rows; an empty table an empty result.
    """
    prints = staged(fingerprints(docs, shingle), "prints")
    found = prints.join(classes(prints, k), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, k: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each component of :func:`near_duplicates`: the one with the smallest doc_id.

    Ids of null rank last. Of different texts under one id the one with the smaller hash is kept, of rows equal in id
    and text one.
    """
    key = {"no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)), "h": F.xxhash64("text")}
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text").withColumns(key)
    prints = staged(fingerprints(rows, shingle, tuple(key)), "prints")
    least = staged(prints.groupBy("fp").agg(F.min(F.struct(*key)).alias("rank")), "least")
    linked = staged(components(near_links(least, k)), "components")
    roots = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    kept = roots.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("rank").alias("rank")).select("rank.*")
    rows = rows.drop("doc_id", "text").join(kept, list(key), "left_semi")
    return rows.dropDuplicates(list(key)).select("doc.*")
