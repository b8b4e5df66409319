"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are read in blocks of bounded size. A block holds one list of its rows for each dimension, sorted by value.
A query walks all lists from the side that its component favours, scores the rows it meets, and stops as soon as the
sum of what the lists can still offer cannot beat its kth score. A task carries the k best of each query from block to
block, so later blocks stop sooner. Queries are written first and sent to the tasks in pieces of bounded size, one
after the other: the results of a piece are written before the next one is read, so the driver never holds more than one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeindex.llm.common import staged
from skeindex.session import shared_dir

# Numbers in a block of candidates, and bytes of queries sent at a time.
BLOCK_NUMBERS, QUERY_BYTES = 1 << 20, 32 << 20


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def scaled(df: DataFrame, id_col: str, vector: str, scale: int = 256) -> DataFrame:
    """``id, v``: each component x as floor(scale * x) with x as double; rows without id or usable vector are left out."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * float(scale)))
    return df.where(F.col(id_col).isNotNull() & F.coalesce(usable(F.col(vector)), F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


class Lists:
    """A block of vectors of one length with its sorted lists, one row of ``order`` and ``sorted`` for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(vectors.T, self.order, axis=1)
        self.most = int(np.abs(vectors).max(initial=0))
        self.floats = {t: vectors.astype(t) for t in (np.float32, np.float64)}

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores: in floating point while all sums are whole numbers in it, else in long or Python integers."""
        bound = self.most * int(np.abs(query).max(initial=0)) * max(1, len(query))
        for kind, digits in ((np.float32, 24), (np.float64, 53)):
            if bound < 1 << digits:
                return (self.floats[kind].take(rows, axis=0) @ query.astype(kind)).astype(np.int64)
        if bound < 1 << 63:
            return self.vectors[rows] @ query
        exact = self.vectors[rows].astype(object) @ query.astype(object)
        return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in exact], dtype=np.int64)

    def search(self, query_id: int, query: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of ``best`` and this block as (-score, id), the query's own id left out."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        if not n or not len(up) + len(down):
            return self._merge(np.arange(n), query_id, query, k, best)
        wide = self.most * int(np.abs(query).max()) * len(query) >= 1 << 62
        weights = [query[d].astype(object) if wide else query[d] for d in (up, down)]

        def bound(depth: int) -> int:
            """What a row that the first ``depth`` entries of the lists do not hold can score at most."""
            return int(weights[0] @ self.sorted[up, n - depth]) + int(weights[1] @ self.sorted[down, depth - 1])

        seen = np.zeros(n, dtype=bool)
        done, depth, n_seen = 0, min(n, 8), 0
        while True:
            new = np.zeros(n, dtype=bool)
            new[self.order[up, n - depth : n - done]] = True
            new[self.order[down, done:depth]] = True
            new &= ~seen
            seen |= new
            rows = np.flatnonzero(new)
            n_seen += len(rows)
            best = self._merge(rows, query_id, query, k, best)
            done = depth
            if n_seen == n or done == n:
                return best
            depth = min(n, 4 * done)
            if len(best) == k:  # a row that ties with the kth may have a smaller id, so it has to be met too
                if -best[-1][0] > bound(done):
                    return best
                low = done  # no deeper than where the present kth score already suffices
                while depth - low > max(1, low // 8) and -best[-1][0] > bound(depth):
                    middle = (low + depth) // 2
                    if -best[-1][0] > bound(middle):
                        depth = middle
                    else:
                        low = middle

    def _merge(self, rows: np.ndarray, query_id: int, query: np.ndarray, k: int, best: list) -> list:
        rows = rows[self.ids[rows] != query_id]
        if not len(rows):
            return best
        scores = self.scores(rows, query)
        if len(best) == k:
            close = scores >= -best[-1][0]
            rows, scores = rows[close], scores[close]
        if len(rows) > 4 * k:  # only ties of the kth can still matter
            close = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[close], scores[close]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return sorted([*best, *((-int(scores[i]), int(self.ids[rows[i]])) for i in order)])[:k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of each query, ties to the smaller id.

    ``vectors`` and ``queries``: ``id, v`` from :func:`scaled`. Rows with the query's own id are no candidates of it, and
    vectors of another length do not meet it. A query with fewer candidates gets all of them. Repeated rows of a query
    are one query; repeated candidate rows are separate candidates.
    """
    spark = queries.sparkSession
    queries = queries.select("id", "v").distinct().withColumn("bytes", 8 * (F.size("v") + 2))
    size = queries.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    pieces = max(1, -(-size // QUERY_BYTES))
    queries = staged(queries.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(pieces)).cast("int").alias("piece")), "queries")
    path = f"{shared_dir(spark)}/llm/found-{uuid.uuid4().hex}"
    for piece in range(pieces):
        rows = queries.where(F.col("piece") == piece).orderBy("id", "v").select("id", "v").toArrow()
        found = _search_piece(vectors, rows, k, piece)
        found.write.mode("append").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    best = Window.partitionBy("piece", "query").orderBy(F.desc("score"), "vec_id", "copy")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_piece(vectors: DataFrame, asked: pa.Table, k: int, piece: int) -> DataFrame:
    """The k best candidates of each task for every query ``(id, v)`` of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = asked["v"].combine_chunks() if asked.num_rows else []
        queries = [(q, vectors[i].values.to_numpy(zero_copy_only=False).astype(np.int64)) for i, q in enumerate(asked["id"].to_pylist())]
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        waiting: dict[int, list] = {}

        def search(dims: int) -> None:
            ids, found = zip(*waiting.pop(dims))
            block = Lists(np.concatenate(ids), np.concatenate(found))
            for i, (query_id, query) in enumerate(queries):
                if len(query) == dims:
                    best[i] = block.search(query_id, query, k, best[i])

        for batch in batches:
            ids, v = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            ends = v.offsets.to_numpy()
            flat, sizes = v.values.to_numpy(zero_copy_only=False), np.diff(ends)
            for dims in np.unique(sizes):
                for at in np.array_split(np.flatnonzero(sizes == dims), max(1, -(-len(ids) * int(dims) // BLOCK_NUMBERS))):
                    if not len(at):
                        continue
                    own = flat[ends[at][:, None] + np.arange(dims)] if dims else np.zeros((len(at), 0), dtype=np.int64)
                    waiting.setdefault(int(dims), []).append((ids[at], own))
                    if sum(x.size for _, x in waiting[int(dims)]) >= BLOCK_NUMBERS:
                        search(int(dims))
        for dims in list(waiting):
            search(dims)
        rows = [(i, queries[i][0], vec_id, -score, c) for i, of in enumerate(best) for c, (score, vec_id) in enumerate(of)]
        columns = list(zip(*rows)) if rows else [()] * 5
        names = ["query", "query_id", "vec_id", "score", "copy"]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    found = vectors.select("id", "v").mapInArrow(run, "query long, query_id long, vec_id long, score long, copy long")
    return found.withColumn("piece", F.lit(piece))
