"""Batch search: exact dense and sparse top-k, rank fusion, result rows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from skeindex.session import BROADCAST_BYTES, fits_broadcast, stage

# List length, fusion weight, and the constant of reciprocal-rank fusion.
NEIGHBOR_COUNT = 10
RRF_ALPHA = 0.5
RRF_CONSTANT = 60
# Scores are compared after rounding, so that summation order cannot change a rank.
SCORE_PLACES = 6
# Scores computed at a time inside a task (32 MB).
SCORE_ENTRIES = 4_000_000
# Queries scored at a time against a slice of vectors: with few, slices are long and top lists are seldom taken up.
QUERY_ROWS = 400
# Largest bitmap of the terms that many blocks of queries ask for.
BITMAP_BYTES = 8 * 1024 * 1024


def top_k(scored: DataFrame, k: int, score: Column, ascending: bool = False) -> DataFrame:
    """The best ``k`` rows of every ``qid`` with a 1-based ``rank``; ties go to the smaller id.

    Spark keeps only ``k`` rows per query and task before the shuffle.
    """
    order = score.asc() if ascending else score.desc()
    window = W.partitionBy("qid").orderBy(order, F.col("id").asc())
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def query_blocks(queries: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """``queries`` in parts whose measured size may be sent to every task; whole queries stay together."""
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = queries.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    if total <= limit:
        return [queries]
    queries = stage(queries, "queries")
    parts = -(-3 * total // (2 * limit))  # hashing does not fill all parts alike
    return [queries.where(F.pmod(F.xxhash64("qid"), F.lit(parts)) == i) for i in range(parts)]


def value_bytes(df: DataFrame, column: str) -> Column:
    """Bytes that an id of ``df`` takes once collected."""
    text = F.octet_length(F.col(column).cast("string"))
    return F.coalesce(text, F.lit(0)) + 16


def best_per_id(found: DataFrame, largest: bool = True) -> DataFrame:
    """``(qid, id, score)`` with the best score of every id: rows that repeat an id compete, none is added up."""
    pick = F.max if largest else F.min
    return found.groupBy("qid", "id").agg(pick("score").alias("score"))


def sparse_scores(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Dot products over shared terms: ``(qid, id, score)`` of ``postings(id, term_id, weight)``.

    For postings that come one by one; documents with all their terms on the row are searched by
    ``sparse_topk_rows`` without a shuffle of pairs. Adaptive execution splits frequent terms.
    """
    wanted = terms.select("qid", "term_id", F.col("weight").alias("__qw"))
    if fits_broadcast(wanted, value_bytes(wanted, "qid") + 24):
        wanted = F.broadcast(wanted)
    total = F.sum(F.col("weight") * F.col("__qw"))
    joined = postings.join(wanted, "term_id")
    return joined.groupBy("qid", "id").agg(F.round(total, SCORE_PLACES).alias("score"))


def sparse_topk(postings: DataFrame, terms: DataFrame, k: int = NEIGHBOR_COUNT) -> DataFrame:
    """``(qid, rank, id, score)`` by sparse dot product."""
    ranked = top_k(sparse_scores(postings, terms), k, F.col("score"))
    return ranked.select("qid", "rank", "id", "score")


def sparse_topk_rows(
    index: DataFrame, terms: DataFrame, k: int = NEIGHBOR_COUNT, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(qid, rank, id, score)`` over ``index(id, sparse_embedding)``, one row per document.

    Documents are scored where they are read, against all queries or, if these are too many to send
    to the tasks at once, against one block of queries after the other: the index is then read and encoded once, and
    the blocks read what it holds of the terms asked for. At most k rows per query leave a task. Of rows that repeat an
    id the best one counts.
    """
    names = index.schema["sparse_embedding"].dataType.fieldNames()
    ids = F.col("sparse_embedding." + ("dimensions" if "dimensions" in names else "indices"))
    vectors = index.select("id", ids.alias("terms"), F.col("sparse_embedding.values").alias("weights"))
    schema = found_schema(terms, index)
    parts = query_blocks(terms.select("qid", "term_id", "weight"), value_bytes(terms, "qid") + 24, limit)
    bitmap = np.zeros(min(limit, BITMAP_BYTES), dtype="uint8") if len(parts) > 1 else None
    asked = [shared for shared in (_shared_terms(part, bitmap) for part in parts) if shared is not None]
    if len(asked) > 1:
        vectors = stage(_asked_only(vectors, bitmap), "asked")
    found = [_sparse_block(vectors, shared, k, schema) for shared in asked]
    found = found or [index.sparkSession.createDataFrame([], schema)]
    ranked = top_k(best_per_id(union_all(found)), k, F.col("score"))
    return ranked.select("qid", "rank", "id", "score")


def found_schema(queries: DataFrame, index: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("id", index.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _shared_terms(terms: DataFrame, bitmap: np.ndarray | None):
    """One block of queries, sent to the tasks; None without any. Its term ids are marked in the bitmap by their remainder."""
    asked = terms.toArrow()
    if not asked.num_rows:
        return None
    if bitmap is not None:
        place = asked["term_id"].drop_null().to_numpy() % (8 * len(bitmap))
        np.bitwise_or.at(bitmap, place >> 3, np.left_shift(1, place & 7).astype("uint8"))
    return terms.sparkSession.sparkContext.broadcast(asked)


def _asked_only(vectors: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Documents with those of their terms that the bitmap may hold; documents without any can have no score."""
    shared = vectors.sparkSession.sparkContext.broadcast(bitmap)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = shared.value
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy()
            terms, weights = (batch.column(c).flatten() for c in ("terms", "weights"))
            place = pc.fill_null(terms, 0).to_numpy() % (8 * len(hit))
            kept = (hit[place >> 3] >> (place & 7)) & 1 == 1
            left = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[kept], minlength=len(lengths))
            rows = left > 0
            offsets = pa.array(np.r_[0, np.cumsum(left[rows])].astype("int32"))
            lists = [pa.ListArray.from_arrays(offsets, x.filter(pa.array(kept))) for x in (terms, weights)]
            yield pa.record_batch([batch.column("id").filter(pa.array(rows)), *lists], names=["id", "terms", "weights"])

    return vectors.mapInArrow(cut, vectors.schema)


def _sparse_block(vectors: DataFrame, shared, k: int, schema: T.StructType) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, id_type = SparseTop(shared.value, k), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            top.add(batch)
        if id_type is not None:
            yield from top.result(top.qids, id_type).to_batches()

    return vectors.mapInArrow(scan, schema)


def _scores(vectors: np.ndarray, block: np.ndarray, metric: str) -> np.ndarray:
    """Scores of ``block`` rows (queries) against ``vectors`` rows; larger is better."""
    products = block @ vectors.T
    if metric == "cosine":
        sizes = np.linalg.norm(block, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
        products = np.divide(products, sizes, out=np.zeros_like(products), where=sizes > 0)
    elif metric == "l2":
        squares = (block**2).sum(1)[:, None] + (vectors**2).sum(1)[None, :] - 2 * products
        products = -np.sqrt(np.maximum(squares, 0))
    return np.round(products, SCORE_PLACES)


def vector_rows(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(mask, matrix)`` of an Arrow list column: rows of ``width`` values, without Python objects."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    keep = pc.equal(pc.fill_null(pc.list_value_length(column), -1), width)
    values = column.filter(keep).flatten().to_numpy(zero_copy_only=False)
    return keep.to_numpy(zero_copy_only=False), values.astype("float64").reshape(-1, width)


def query_block(queries: pa.Table, width: int) -> tuple[pa.ChunkedArray, np.ndarray]:
    """Query ids and their matrix of ``width`` columns."""
    keep, matrix = vector_rows(queries["dense"], width)
    return queries["qid"].filter(pa.array(keep)), matrix


def query_width(queries: DataFrame) -> int:
    """The length of all query vectors, 0 without queries; queries of different lengths are refused."""
    sizes = queries.agg(F.min(F.size("dense")).alias("low"), F.max(F.size("dense")).alias("high")).first()
    if sizes["low"] != sizes["high"]:
        raise ValueError(f"query vectors have {sizes['low']} to {sizes['high']} dimensions")
    return sizes["low"] or 0


class RunningTop:
    """The best ``k`` ids of every query over the batches that one task reads."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.ids: list[list] = [[] for _ in range(queries)]
        self.scores: list[list] = [[] for _ in range(queries)]
        self.floors = np.full(queries, -np.inf)

    def offer(self, scores: np.ndarray, ids, first: int = 0) -> None:
        """Scores of one slice of ids, a row per query from ``first`` on; what is not finite stands for no score."""
        scores = np.where(np.isfinite(scores), scores, -np.inf)
        most = scores.max(axis=1)
        # Once the lists are full, few queries find anything in a slice.
        for q in np.flatnonzero((most >= self.floors[first : first + len(scores)]) & (most > -np.inf)):
            self.merge(first + q, scores[q], ids)

    def offer_one(self, q: int, scores: np.ndarray, ids) -> None:
        """Scores of one query over a slice of ids."""
        if np.isfinite(scores).any():
            self.merge(q, np.where(np.isfinite(scores), scores, -np.inf), ids)

    def merge(self, q: int, scores: np.ndarray, ids) -> None:
        """Take up scores of one query; an id that comes again keeps its best score."""
        size, best = self.k, dict(zip(self.ids[q], self.scores[q]))
        within = np.flatnonzero((scores >= self.floors[q]) & (scores > -np.inf))
        values = scores[within]
        while True:
            at = within
            if len(values) > size:
                at = within[values >= np.partition(values, -size)[-size]]
            found: dict = {}
            for score, key in zip(scores[at].tolist(), ids.take(pa.array(at)).to_pylist()):
                found[key] = max(score, found.get(key, -np.inf))
            # Ids kept from earlier slices do not count here: these rows are not offered again.
            if len(found) >= self.k or len(at) == len(within):
                break
            size *= 4  # repeated ids took the places of others
        for key, score in found.items():
            best[key] = max(score, best.get(key, -np.inf))
        kept = heapq.nsmallest(self.k, ((-s, i) for i, s in best.items()))
        self.scores[q], self.ids[q] = [-s for s, _ in kept], [i for _, i in kept]
        if len(kept) == self.k:
            self.floors[q] = self.scores[q][-1]

    def result(self, qids, id_type: pa.DataType) -> pa.Table:
        owner = [q for q, ids in enumerate(self.ids) for _ in ids]
        scores = np.array([s for kept in self.scores for s in kept], dtype="float64")
        ids = pa.array([i for ids in self.ids for i in ids], type=id_type)
        return pa.table(
            {"qid": qids.take(pa.array(owner, pa.int64())), "id": ids, "score": pa.array(scores + 0.0)}
        )


class DenseTop(RunningTop):
    """Top lists by a dense metric, over batches of ``(id, embedding)``."""

    def __init__(self, block: np.ndarray, k: int, metric: str) -> None:
        super().__init__(len(block), k)
        self.block, self.metric = block, metric

    def add(self, batch) -> None:
        keep, vectors = vector_rows(batch.column("embedding"), self.block.shape[1])
        ids = batch.column("id").filter(pa.array(keep))
        wide = min(len(self.block), QUERY_ROWS)
        rows = max(1, SCORE_ENTRIES // wide)
        for start in range(0, len(vectors), rows):
            part = vectors[start : start + rows]
            for first in range(0, len(self.block), wide):
                asked = self.block[first : first + wide]
                self.offer(_scores(part, asked, self.metric), ids.slice(start, rows), first)

    def result(self, qids, id_type: pa.DataType) -> pa.Table:
        found = super().result(qids, id_type)
        if self.metric != "l2":
            return found
        return found.set_column(2, "score", pc.abs(found["score"]))


class SparseTop(RunningTop):
    """Top lists by dot product over shared terms, over batches of ``(id, terms, weights)``.

    All terms of a document are on its row, so its score is final inside the task.
    """

    def __init__(self, terms: pa.Table, k: int) -> None:
        ordered = terms.sort_by("term_id")
        ids = ordered["term_id"].to_numpy()
        coded = ordered["qid"].combine_chunks().dictionary_encode()
        self.qids = coded.dictionary
        self.owner = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
        self.weight = ordered["weight"].to_numpy()
        self.vocabulary, self.starts = np.unique(ids, return_index=True)
        self.counts = np.diff(np.append(self.starts, len(ids)))
        super().__init__(len(self.qids), k)

    def add(self, batch) -> None:
        lengths = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy()
        terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
        weights = batch.column("weights").flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        asked = self.vocabulary[at] == terms
        rows = np.repeat(np.arange(len(lengths)), lengths)[asked]
        at, weights = at[asked], weights[asked]
        # Slices of whole documents with a bounded number of (posting, query) pairs.
        pairs = np.cumsum(self.counts[at])
        low = 0
        while low < len(rows):
            reached = np.searchsorted(pairs, (pairs[low - 1] if low else 0) + SCORE_ENTRIES, "right")
            high = np.searchsorted(rows, rows[min(reached, len(rows) - 1)], "left") if reached < len(rows) else len(rows)
            if high <= low:  # one document alone
                high = np.searchsorted(rows, rows[low], "right")
            self._slice(rows[low:high], at[low:high], weights[low:high], batch.column("id"))
            low = high

    def _slice(self, rows, at, weights, ids) -> None:
        """Each posting meets the queries that ask for its term; only pairs that share a term are summed."""
        repeats = self.counts[at]
        first = np.repeat(self.starts[at] - (np.cumsum(repeats) - repeats), repeats)
        entry = first + np.arange(len(first))
        width = int(rows[-1]) + 1
        cell = self.owner[entry] * width + np.repeat(rows, repeats)
        products, cells = np.repeat(weights, repeats) * self.weight[entry], len(self.qids) * width
        if cells <= 4 * len(cell):  # many pairs for the room: counted in place, without a sort
            hit = np.flatnonzero(np.bincount(cell, minlength=cells))
            sums = np.bincount(cell, products, cells)[hit]
        else:
            hit, place = np.unique(cell, return_inverse=True)
            sums = np.bincount(place, products, len(hit))
        scores, query, row = np.round(sums, SCORE_PLACES), hit // width, hit % width
        near = np.isfinite(scores) & (scores >= self.floors[query])
        scores, query, row = scores[near], query[near], row[near]
        cuts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else []
        for start, end in zip(cuts, [*cuts[1:], len(query)]):
            self.merge(query[start], scores[start:end], ids.take(pa.array(row[start:end])))


def dense_topk(
    index: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOR_COUNT,
    metric: str = "dot",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, rank, id, score)`` of ``queries(qid, dense)`` over ``index(id, embedding)``; exact.

    Queries without a vector are left out, the others have one length. Vectors of another length
    (failed embeddings are empty) and scores that are not finite do not count; of rows that repeat an
    id the best one does. ``metric`` is dot, cosine (both: larger first) or l2 (smaller first).
    Queries too many to send to the tasks are taken block by block; the index is never moved.
    """
    if metric not in ("dot", "cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    index = index.select("id", "embedding")
    queries = queries.select("qid", "dense").where(F.size("dense") > 0)
    width, schema = query_width(queries), found_schema(queries, index)
    parts = query_blocks(queries, F.size("dense") * 8 + value_bytes(queries, "qid"), limit)
    found = [_dense_block(index, part, k, metric, width, schema) for part in parts]
    best = best_per_id(union_all(found), metric != "l2")
    ranked = top_k(best, k, F.col("score"), ascending=metric == "l2")
    return ranked.select("qid", "rank", "id", "score")


def _dense_block(index, queries, k: int, metric: str, width: int, schema) -> DataFrame:
    spark = index.sparkSession
    asked = queries.toArrow()
    if not asked.num_rows:
        return spark.createDataFrame([], schema)
    block = spark.sparkContext.broadcast(query_block(asked, width))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix = block.value
        top, id_type = DenseTop(matrix, k, metric), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            top.add(batch)
        if id_type is not None:
            yield from top.result(qids, id_type).to_batches()

    return index.mapInArrow(scan, schema)


def reciprocal_rank_fusion(
    dense: DataFrame,
    sparse: DataFrame,
    k: int = NEIGHBOR_COUNT,
    alpha: float = RRF_ALPHA,
    constant: int = RRF_CONSTANT,
) -> DataFrame:
    """``(qid, rank, id, rrf, distance, sparse_distance)`` from two ranked lists.

    ``alpha`` weighs the dense list. A side with weight zero contributes no candidates.
    """
    left = dense.select(
        "qid", "id", F.col("rank").alias("__dr"), F.col("score").alias("distance")
    ).where(F.lit(alpha > 0))
    right = sparse.select(
        "qid", "id", F.col("rank").alias("__sr"), F.col("score").alias("sparse_distance")
    ).where(F.lit(alpha < 1))
    share = lambda weight, rank: F.coalesce(
        F.lit(float(weight)) / (F.lit(constant) + F.col(rank)), F.lit(0.0)
    )
    fused = left.join(right, ["qid", "id"], "full").withColumn(
        "rrf", F.round(share(alpha, "__dr") + share(1 - alpha, "__sr"), 9)
    )
    ranked = top_k(fused, k, F.col("rrf"))
    return ranked.select("qid", "rank", "id", "rrf", "distance", "sparse_distance")


def shape_results(fused: DataFrame, index: DataFrame) -> DataFrame:
    """``(qid, rank, id, distance, sparse_distance, metadata)`` from ``index(id, metadata)``.

    The neighbours are few next to the index, so the index side is first reduced by a semi join,
    where it is read if the neighbours' ids fit a broadcast. They are used three times, so the search is run once and
    written.
    """
    fused = stage(fused, "fused")
    ids = fused.select("id").distinct()
    if fits_broadcast(ids, value_bytes(ids, "id")):
        ids = F.broadcast(ids)
    known = index.select("id", F.col("embedding_metadata").alias("metadata"))
    matched = known.join(ids, "id", "left_semi")
    return fused.join(matched, "id", "left").select(
        "qid", "rank", "id", "distance", "sparse_distance", "metadata"
    )
