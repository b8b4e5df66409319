"""A Merkle manifest of documents, its trees stored in van Emde Boas layout.

Leaves are digests of rows, in a tree of three children for each source; the sources' roots are the leaves of one more
tree. A tree is cut into aligned subtrees ("blocks") of at most ``HEIGHT`` levels above their leaves. Within a block
the nodes lie in van Emde Boas order: the block is split at half its height, the upper part is stored first and the
lower subtrees after it from left to right, each laid out the same way. Address arithmetic over depth and index finds
any node, for construction as for the retrieval of siblings, so both touch few cache lines whatever their size. The
roots of the blocks are the leaves of the next blocks, until one block holds the root.

Texts are only read to make leaves. What is shuffled has a digest, an id and a position; a block has at most
``3 ** HEIGHT`` leaves, so a source that holds a third of all rows is many blocks.

Rows are ordered by ``doc_id`` within their source (null last), rows that share an id by their leaf; equal rows are
leaves of their own. A source of null is the first one. Columns of null are written as ``-``. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.llm.common import small, staged

ARITY, HEIGHT = 3, 6
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- leaves -------------------------------------------------------------------------------------


def leaf(*fields: Column) -> Column:
    """sha256 (as bytes) of the fields: byte count, colon and value, or a hyphen for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hashed(digests: bytes) -> bytes:
    """The digest of digests: sha256 of their hexadecimal text."""
    return hashlib.sha256(digests.hex().encode()).digest()


# --- van Emde Boas layout -----------------------------------------------------------------------


def nodes_of(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` (from the left) at ``depth`` below the root, in a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    lower, width = levels - upper, ARITY ** (depth - upper)
    subtree, within = index // width, index % width
    return nodes_of(upper) + subtree * nodes_of(lower) + address(lower, depth - upper, within)


@lru_cache(maxsize=64)
def addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(ARITY**depth))


class Block:
    """An aligned subtree in van Emde Boas order; places right of its last leaf are empty."""

    def __init__(self, height: int, n: int, cells: bytearray | bytes):
        self.height, self.n, self.cells = height, n, cells

    @classmethod
    def built(cls, height: int, leaves: list[bytes]) -> Block:
        block = cls(height, len(leaves), bytearray(DIGEST * nodes_of(height + 1)))
        block._put(height, leaves)
        for depth in range(height - 1, -1, -1):
            block._put(depth, [hashed(b"".join(block.run(depth + 1, ARITY * i))) for i in range(block.width(depth))])
        return block

    def width(self, depth: int) -> int:
        """Nodes at a depth that stand over a leaf."""
        return -(-self.n // ARITY ** (self.height - depth))

    def _put(self, depth: int, digests: list[bytes]) -> None:
        for at, digest in zip(addresses(self.height + 1, depth), digests):
            self.cells[DIGEST * at : DIGEST * (at + 1)] = digest

    def node(self, depth: int, index: int) -> bytes:
        at = DIGEST * int(addresses(self.height + 1, depth)[index])
        return bytes(self.cells[at : at + DIGEST])

    def run(self, depth: int, index: int) -> list[bytes]:
        """The nodes with the same parent as ``index``."""
        first = index - index % ARITY
        return [self.node(depth, i) for i in range(first, min(first + ARITY, self.width(depth)))]

    def paths(self) -> list[bytes]:
        """Of every leaf: for each level up to the root of the block its place in its run and its siblings."""
        above = [b""]
        for depth in range(1, self.height + 1):
            own = []
            for i in range(self.width(depth)):
                run, at = self.run(depth, i), i % ARITY
                own.append(bytes([at, len(run) - 1]) + b"".join(run[:at] + run[at + 1 :]) + above[i // ARITY])
            above = own
        return above


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The levels of a path, from the leaf up: the place in the run, and the siblings."""
    i = 0
    while i < len(path):
        at, n = path[i], path[i + 1]
        i += 2
        yield at, [path[i + DIGEST * k : i + DIGEST * (k + 1)] for k in range(n)]
        i += DIGEST * n


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its path."""
    for at, siblings in steps(path):
        digest = hashed(b"".join([*siblings[:at], digest, *siblings[at:]]))
    return digest


def proof(path: bytes) -> bytes:
    """The digest of all siblings of a path."""
    return hashed(b"".join(s for _, siblings in steps(path) for s in siblings))


# --- trees as Spark jobs ------------------------------------------------------------------------


_KINDS = {"int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _mapped(rows: DataFrame, schema: str, names: list[str], make: Callable[..., list]) -> DataFrame:
    """A value of each row, computed from the columns ``names`` in Arrow batches, beside the other columns."""
    kept = [c for c in rows.columns if c not in names]
    kinds = [_KINDS[x.split()[1]] for x in schema.split(", ")]
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [make(*row) for row in zip(*(batch.column(c).to_pylist() for c in names))]
            made = [pa.array(x, kind) for x, kind in zip(zip(*found), kinds)]
            if found:
                yield pa.record_batch([*(batch.column(c) for c in kept), *made], names=[*kept, *(x.split()[0] for x in schema.split(", "))])

    return rows.mapInArrow(run, ", ".join(x for x in (fields, schema) if x))


def positioned(rows: DataFrame, tree: list[Column], order: list[Column]) -> DataFrame:
    """Add ``tree``, ``position`` (0, 1, ... in the order) and ``n`` (rows of the tree) to every row, and write it.

    A range-partitioned sort, then one offset for each tree and partition: the rows of one tree may fill many partitions.
    """
    key, part, seq = F.struct(*tree).alias("tree"), "__part", "__seq"
    rows = rows.withColumn("tree", key).withColumn("__tie", F.rand(11))
    rows = staged(rows, "unsorted")  # so that a task that runs again has the same tie-breakers
    by = ["tree", *order, "__tie"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    rows = staged(rows.withColumns({part: F.spark_partition_id(), seq: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "sorted")
    counts = rows.groupBy("tree", part).agg(F.count("*").alias("__n"), F.min(seq).alias("__first"))
    earlier = Window.partitionBy("tree").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")
    starts = counts.select("tree", part, start.alias("__start"), F.sum("__n").over(Window.partitionBy("tree")).alias("n"))
    starts = staged(starts, "starts")
    found = rows.join(small(starts, 64), ["tree", part])
    return found.withColumn("position", F.col("__start") + F.col(seq)).drop("__start", part, seq)


def _height(n: Column) -> Column:
    """Levels of a block over a tree that has ``n`` nodes left at this level."""
    height = F.lit(HEIGHT)
    for h in range(HEIGHT - 1, -1, -1):
        height = F.when(n <= ARITY**h, h).otherwise(height)
    return height


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``tree, block, n, height, leaves, cells`` of ``nodes(tree, position, n, digest, ...)``: blocks built from their leaves.

    Further columns of the nodes become lists in the order of the leaves.
    """
    wide, extra = ARITY**HEIGHT, [c for c in nodes.columns if c not in ("tree", "position", "n", "digest")]
    place = F.struct("position", "digest", *extra)
    rows = nodes.groupBy("tree", F.floor(F.col("position") / wide).alias("block"), "n").agg(F.sort_array(F.collect_list(place)).alias("x"))
    lists = [F.col(f"x.{c}").alias(c) for c in extra]
    rows = rows.select("tree", "block", "n", _height(F.col("n")).alias("height"), F.col("x.digest").alias("digests"), *lists)

    def make(height: int, digests: list[bytes]) -> list:
        return [len(digests), bytes(Block.built(height, digests).cells)]

    return _mapped(rows.withColumn("levels", F.col("height")), "leaves int, cells binary", ["levels", "digests"], make)


def manifest(nodes: DataFrame) -> list[DataFrame]:
    """The levels of blocks of all trees, from the leaves up; in the last one every tree is one block.

    Trees that are done take part in the next level as a block of one leaf and no height, whose root is that leaf.
    """
    levels, wide = [], ARITY**HEIGHT
    while True:
        blocks = staged(blocks_of(nodes), "blocks")
        levels.append(blocks)
        if not blocks.where(F.col("n") > wide).limit(1).count():
            return levels
        left = F.ceil(F.col("n") / wide)
        nodes = blocks.select("tree", F.col("block").alias("position"), left.alias("n"), F.substring("cells", 1, DIGEST).alias("digest"))


def roots(levels: list[DataFrame]) -> DataFrame:
    """``tree, root``: the first cell of each tree's last block."""
    return levels[-1].select("tree", F.substring("cells", 1, DIGEST).alias("root"))


def with_paths(levels: list[DataFrame]) -> DataFrame:
    """The lowest blocks with ``up``: the path from their root to the tree's, read level by level from the blocks above."""
    rows = levels[-1].withColumn("up", F.lit(b""))
    for below in reversed(levels[:-1]):
        found = _mapped(rows.select("tree", "block", "height", "leaves", "cells", "up"), "paths array<binary>", ["height", "leaves", "cells", "up"], _paths)
        up = found.select("tree", "block", F.posexplode("paths").alias("at", "up"))
        up = up.select("tree", (F.col("block") * ARITY**HEIGHT + F.col("at")).alias("block"), "up")
        rows = below.join(up, ["tree", "block"])
    return rows


def _paths(height: int, leaves: int, cells: bytes, up: bytes) -> list:
    return [[path + up for path in Block(height, leaves, cells).paths()]]


# --- documents ----------------------------------------------------------------------------------


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, changed`` of every row; ``changed`` is the leaf after tampering, null where it is the same.

    Rows whose id has an even crc32 lose the line breaks of their text; an id of null is not tampered with.
    """
    fields = [F.col(c) for c in FIELDS]
    cut = F.col("text").contains("\n") & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    changed = F.when(cut, leaf(*fields[:-1], F.replace("text", F.lit("\n"), F.lit(""))))
    return docs.select("doc_id", "source", leaf(*fields).alias("leaf"), changed.alias("changed"))


def verified(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    The first columns are of the documents as they are; ``folded_root`` is recomputed from the leaf after tampering and
    the stored siblings.
    """
    of_id = docs.schema["doc_id"].dataType
    found = positioned(leaves(docs), [F.col("source")], [F.col("doc_id").asc_nulls_last(), F.col("leaf")])
    own = manifest(found.select("tree", "position", "n", F.col("leaf").alias("digest"), "doc_id", "changed"))
    subroots = roots(own).select(F.col("tree.source").alias("source"), F.col("root").alias("subroot"))
    top = positioned(subroots, [F.lit(0).alias("all")], [F.col("source")])
    whole = manifest(top.select("tree", "position", "n", F.col("subroot").alias("digest"), "source"))
    blocks = with_paths(whole).crossJoin(F.broadcast(roots(whole).select("root")))  # one row: the root of all sources
    blocks = _mapped(blocks.select("source", "root", "height", "leaves", "cells", "up"), "paths array<binary>", ["height", "leaves", "cells", "up"], _paths)
    up = blocks.select("root", F.explode(F.arrays_zip("source", "paths")).alias("x"))
    up = staged(up.select(F.struct("x.source").alias("tree"), "root", F.col("x.paths").alias("top")), "top-paths")
    rows = with_paths(own).join(small(up, F.octet_length("top") + 128), "tree")
    rows = rows.join(small(roots(own).withColumnRenamed("root", "subroot"), 128), "tree")
    rows = rows.select("height", "leaves", "cells", "up", "top", "subroot", "root", "doc_id", "changed")
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = T.StructType([T.StructField("doc_id", of_id), *(T.StructField(c, T.StringType()) for c in names), T.StructField("verified", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            others = (batch.column(c).to_pylist() for c in batch.schema.names if c != "doc_id")
            for i, (height, n, cells, up, top, subroot, root, changed) in enumerate(zip(*others)):
                block, out = Block(height, n, cells), []
                for k, (path, other) in enumerate(zip(block.paths(), changed)):
                    path, digest = path + up + top, block.node(height, k)
                    got = folded(other or digest, path)
                    out.append((digest.hex(), subroot.hex(), root.hex(), proof(path).hex(), got.hex(), got == root))
                yield pa.record_batch([ids.slice(i, 1).flatten(), *map(pa.array, zip(*out))], names=schema.names)

    return rows.mapInArrow(run, schema)
